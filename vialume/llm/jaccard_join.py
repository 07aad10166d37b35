"""Similar documents: shingle sets with a Jaccard similarity of 0.8 or more, found exactly.

Method. The hashes of a set fall into ``GROUPS`` groups; the counts by group are a point. The overlap of
two sets is at most the sum of the smaller coordinates of their points, so pairs whose bound lies below the
overlap that the similarity needs are never compared. Points are packed into an R-tree, whose
nodes bound all pairs below two of them at once: two trees are walked down together, and surviving pairs are verified on the sets.

Spread over executors. One tree over all points compares ever more leaves as the corpus grows, as the boxes of
unrelated texts overlap. So there is a tree for each shingle that can lead to a link: two sets that
are similar enough share one of the first ``n - ceil(0.8 n) + 1`` shingles of each, in any order that is the same for
all. The order here is by hash, with frequent shingles (found by lossy counting over every batch of all
rows) moved to the end; it decides the work, never the result. A tree is cut by size of set, as sizes of
similar sets are within a factor of 1.25, and a large tree into tiles that are paired up. Trees with one smallest
set become one where that makes no more pairs, so a family of texts sends its points a few times, not once for each shingle.

Groups of copies. Equal sets are one class from the start. Of the sets under a shingle the most
central one (most of its shingles shared) is compared with all others; whole groups of near copies become
one component by that, and the trees only look at pairs of different components. Links within a
tile stop at a spanning forest. So work grows with the members of a group, not with its pairs.

Result: for every document its set size and the smallest id reachable by links. Links between
different texts are not lost; those between equal sets are implied by the class.

Defined results: null and empty texts have no shingles and link with nothing, their component is their own id.
Texts of 1 to 4 words are one shingle. Repeated rows give one row each. Rows with a null id take part; their
component is the smallest id reached, or null.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vialume.llm.common import Round, keep_only, stored, table
from vialume.llm.components import components
from vialume.llm.textkernel import mix, text_windows

QUERY = "op3_jaccard_join"
GROUPS = 128
#: Sets from FINE_FROM shingles on have FINE_GROUPS groups, a multiple; groups with equal rest are summed to compare both kinds.
FINE_GROUPS = 1024
FINE_FROM = 1000
#: Shingles moved to the end of the order: at most so many, each in so many rows at least.
FREQUENT = 1 << 17
FREQUENT_ROWS = 24
LEAF = 32
FAN = 8
#: Bytes of text that are read into sets at a time.
READ_BYTES = 1 << 24
#: Words of 64 bits in a sieve of documents: one for four wanted documents, at most so many.
SIEVE_WORDS = 1 << 20
_SECOND = 0x5851F42D4C957F2D
TILE = 512


def set_names(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, its size included."""
    with np.errstate(over="ignore"):
        once = mix(shingles)
        totals = np.array([once.sum(dtype=np.uint64), mix(once ^ np.uint64(_SECOND)).sum(dtype=np.uint64)]) + np.uint64(len(shingles))
    return tuple(mix(totals).view(np.int64).tolist())


def set_id(shingles: np.ndarray, shared: frozenset = frozenset()) -> int:
    """Name of a set: the first half of the 128 bits, or the second where different sets share the first (``shared``)."""
    first, second = set_names(shingles)
    return second if first in shared else first


def needed(a, b):
    """Overlap from which two sets of these sizes link: 100 * i >= 80 * (a + b - i)."""
    return -(-4 * (a + b) // 9)


def prefix_length(n: int) -> int:
    return n - -(-4 * n // 5) + 1


def point_of(shingles: np.ndarray) -> np.ndarray:
    groups = GROUPS if len(shingles) < FINE_FROM else FINE_GROUPS
    return np.bincount((shingles % np.uint64(groups)).astype(np.int64), minlength=groups).astype(np.int32)


def read_sets(docs: DataFrame) -> DataFrame:
    """Rows of two kinds: (doc_id, set, also, n, point) of each document; and (null, shingle, null, -count, null) of shingles that are frequent in a batch.

    ``also`` is the second half of the set's name. Of equal sets in a batch only the first has its point.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        for batch in by_bytes(batches, 1):
            ids, also, sizes, every, points = *(np.zeros(batch.num_rows, np.int64) for _ in range(3)), [], []
            seen = set()
            for i, s in text_windows(batch.column(1)):
                sizes[i] = len(s)
                ids[i], also[i] = set_names(s) if len(s) else (0, 0)
                points.append(point_of(s) if len(s) and ids[i] not in seen else None)
                seen.add(ids[i])
                every.append(s)
            values, counts = np.unique(np.concatenate(every), return_counts=True) if every else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            often = counts >= max(3, int(batch.num_rows / 2000))
            n = int(often.sum())
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([batch.column(0), pa.nulls(n, pa.int64())]),
                pa.array(np.concatenate((ids, values[often].view(np.int64)))), pa.concat_arrays([pa.array(also), pa.nulls(n, pa.int64())]),
                pa.array(np.concatenate((sizes, -counts[often]))),
                pa.array([*points, *[None] * n], pa.list_(pa.int32()))], names=["doc_id", "set", "also", "n", "point"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(read, "doc_id long, set long, also long, n long, point array<int>")


def by_bytes(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each has about ``READ_BYTES`` of text, one row at least."""
    for batch in batches:
        size = np.array([0 if n is None else n for n in pc.binary_length(batch.column(text)).to_pylist()], dtype=np.int64)
        part = np.concatenate(([0], np.cumsum(size)[:-1] // READ_BYTES)) if len(size) else size
        cuts = [*np.flatnonzero(np.diff(part, prepend=-1)).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)


def shared_names(sets: DataFrame) -> frozenset:
    """First halves of names that different sets share. Even for 10**12 sets some ten thousand are expected."""
    rows = sets.where("n > 0").groupBy("set").agg(F.min("also").alias("a"), F.max("also").alias("b")).where("a <> b")
    return frozenset(r["set"] for r in rows.select("set").collect())


def frequent_shingles(sets: DataFrame) -> np.ndarray:
    rows = sets.where("n < 0").groupBy("set").agg(F.sum(-F.col("n")).alias("c")).where(F.col("c") >= FREQUENT_ROWS)
    found = rows.orderBy(F.desc("c"), "set").limit(FREQUENT).select("set").toArrow()
    return np.sort(found.column("set").to_numpy().view(np.uint64)) if found.num_rows else np.zeros(0, np.uint64)


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(ordered, values)
    return ordered[np.minimum(at, len(ordered) - 1)] == values


def prefixes(docs: DataFrame, frequent: np.ndarray, named: frozenset = frozenset()) -> DataFrame:
    """Rows (shingle, set): the first shingles of each set; of equal sets in a batch only one is read."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        for batch in by_bytes(batches, 0):
            shingles, ids, seen = [], [], set()
            for _, s in text_windows(batch.column(0)):
                if len(s) and (name := set_id(s, named)) not in seen:
                    seen.add(name)
                    often, n = _among(s, frequent), prefix_length(len(s))
                    rare = s[~often][:n]
                    head = rare if len(rare) == n else np.concatenate((rare, s[often][:n - len(rare)]))
                    shingles.append(head.view(np.int64))
                    ids.append(np.full(len(head), name))
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(shingles)), pa.array(np.concatenate(ids))], names=["shingle", "set"])

    return docs.select("text").mapInArrow(first, "shingle long, set long")


def sieved(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Those of ``docs`` whose id may be among ``ids`` (_named), by one bit of its hash: the texts of most others are never shuffled.

    The bits are sent to every executor. Beyond ``SIEVE_WORDS`` words of them more documents pass, none is lost.
    """
    words = max(1, min(SIEVE_WORDS, -(-ids.count() // 4)))

    def placed(df: DataFrame, name: str) -> DataFrame:
        hashed = F.xxhash64(F.col(name).cast("long"))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(hashed, 58).cast("int"))
        return df.withColumn("_word", F.pmod(hashed, F.lit(words))).withColumn("_bit", bit)

    sieve = placed(ids, "_named").groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    passed = placed(docs, "doc_id").join(F.broadcast(sieve), "_word").where(F.col("_bits").bitwiseAND(F.col("_bit")) != 0)
    return passed.select(*docs.columns)


def full_sets(docs: DataFrame, named: DataFrame, wanted: DataFrame, shared: frozenset = frozenset()) -> DataFrame:
    """Rows (set, shingles) of the ``wanted`` sets, read again from one document each (``named``: set, doc_id)."""
    ids = stored(wanted.distinct().join(named, "set").select("set", F.col("doc_id").alias("_named")), "wanted")
    texts = sieved(docs, ids).join(ids, F.col("doc_id").eqNullSafe(F.col("_named"))).select("set", "text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        seen = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                names, rows = part.column(0).to_pylist(), {}
                for i, s in text_windows(part.column(1)):
                    if names[i] not in seen and len(s) and set_id(s, shared) == names[i]:  # an id may stand for several texts
                        seen.add(names[i])
                        rows[names[i]] = s.view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(rows.keys(), pa.int64()), pa.array(rows.values(), pa.list_(pa.int64()))], names=["set", "shingles"])

    return texts.mapInArrow(read, "set long, shingles array<long>")


def bound(a: str, b: str):
    """Sum of the smaller coordinates of two points of one kind."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)


def bounded(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose points let them link, with both sizes."""
    for side in ("a", "b"):
        pairs = pairs.join(points.select(F.col("set").alias(side), F.col("n").alias(f"n_{side}"), F.col("point").alias(f"p_{side}")), side)
    need = F.ceil(4 * (F.col("n_a") + F.col("n_b")) / F.lit(9))
    near = (F.size("p_a") != F.size("p_b")) | (bound("p_a", "p_b") >= need)
    return pairs.where((5 * F.least("n_a", "n_b") >= 4 * F.greatest("n_a", "n_b")) & near).select("a", "b", "n_a", "n_b")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b, n_a, n_b) that link, by their sets."""
    for side in ("b", "a"):
        pairs = pairs.join(sets.select(F.col("set").alias(side), F.col("shingles").alias(f"s_{side}")), side)
    shared = F.size(F.array_intersect("s_a", "s_b"))
    return pairs.where(100 * shared >= 80 * (F.col("n_a") + F.col("n_b") - shared)).select("a", "b")


class Forest:
    """Components of the members of a tile."""

    def __init__(self, of: list):
        known: dict = {}
        self.parent = [known.setdefault(c, i) for i, c in enumerate(of)]

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i


class Tree:
    """R-tree over the points of some rows: leaves packed along the size and then along the widest axis, ``FAN`` nodes to a parent.

    Each level has, for its nodes, the largest coordinates, and the smallest and largest size below.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> None:
        runs = [rows]
        if len(rows) > LEAF:
            axis = points[rows].var(axis=0).argmax()
            rows = rows[np.lexsort((points[rows, axis], sizes[rows]))]
            runs = [rows[s:s + LEAF * FAN] for s in range(0, len(rows), LEAF * FAN)]
            runs = [r[np.argsort(points[r, axis], kind="stable")] for r in runs]
        self.leaves = [r[i:i + LEAF] for r in runs for i in range(0, len(r), LEAF)]
        most = np.array([points[r].max(axis=0) for r in self.leaves])
        small, large = (np.array([f(sizes[r]) for r in self.leaves]) for f in (np.min, np.max))
        self.levels = [(most, small, large)]
        while len(small) > 1:
            at = np.arange(0, len(small), FAN)
            most, small, large = np.maximum.reduceat(most, at, axis=0), np.minimum.reduceat(small, at), np.maximum.reduceat(large, at)
            self.levels.append((most, small, large))

    def below(self, level: int, nodes: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The children of ``nodes``, each with the other node of its pair."""
        child = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
        there = child < len(self.levels[level - 1][1])
        return child[there], np.repeat(others, FAN)[there]


def may_link(a: tuple, i: np.ndarray, b: tuple, j: np.ndarray) -> np.ndarray:
    """Which pairs of nodes can hold a link, by the sum of the smaller of their largest coordinates, and by their sizes."""
    bound = np.minimum(a[0][i], b[0][j]).sum(axis=1)
    close = (5 * a[2][i] >= 4 * b[1][j]) & (5 * b[2][j] >= 4 * a[1][i])
    return close & (bound >= needed(a[1][i], b[1][j]))


def leaf_pairs(points: np.ndarray, sizes: np.ndarray, rows: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of the rows of two leaves that their own bounds and sizes let link."""
    at_most = np.minimum(points[rows][:, None, :], points[other][None, :, :]).sum(axis=2)
    n, m = sizes[rows][:, None], sizes[other][None, :]
    p, q = np.nonzero((at_most >= needed(n, m)) & (5 * np.minimum(n, m) >= 4 * np.maximum(n, m)))
    return rows[p], other[q]


def tree_pairs(points: np.ndarray, sizes: np.ndarray, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows (one of ``left``, one of ``right``) whose bound lets them link: both trees are walked down together."""
    if not (len(left) and len(right)):
        return
    if max(len(left), len(right)) <= LEAF:  # a leaf each
        yield leaf_pairs(points, sizes, left, right)
        return
    a, b = Tree(points, sizes, left), Tree(points, sizes, right)
    at_a, at_b = len(a.levels) - 1, len(b.levels) - 1
    i = j = np.zeros(1, dtype=np.int64)
    while True:
        near = may_link(a.levels[at_a], i, b.levels[at_b], j)
        i, j = i[near], j[near]
        if at_a == at_b == 0 or not len(i):
            break
        if at_a >= at_b:
            i, j = a.below(at_a, i, j)
            at_a -= 1
        else:
            j, i = b.below(at_b, j, i)
            at_b -= 1
    for x, y in zip(i.tolist(), j.tolist(), strict=True):
        yield leaf_pairs(points, sizes, a.leaves[x], b.leaves[y])


def tile_points(column: pa.ListArray) -> np.ndarray:
    """Points of the members as rows of one matrix: fine ones only if all are."""
    ends, values = column.offsets.to_numpy(), column.values.to_numpy()
    if (np.diff(ends) == FINE_GROUPS).all():
        return values[ends[0]:ends[-1]].reshape(-1, FINE_GROUPS)
    return np.array([values[a:b].reshape(-1, GROUPS).sum(axis=0) for a, b in zip(ends, ends[1:], strict=False)])


def shared_heads(values: np.ndarray, ends: np.ndarray) -> list[frozenset]:
    """The first shingles of each set that another set of the tile has too, in the order of rising counts in the tile.

    Two sets that link have one in common.
    """
    _, which, counts = np.unique(values[ends[0]:ends[-1]], return_inverse=True, return_counts=True)
    heads = []
    for a, b in zip(ends - ends[0], ends[1:] - ends[0], strict=False):
        of = which[a:b]
        order = np.lexsort((of, counts[of]))[:prefix_length(int(b - a))]
        heads.append(frozenset(of[order][counts[of[order]] > 1].tolist()))
    return heads


def tile_links(rows: pa.Table, verify: bool) -> list[tuple[int, int]]:
    """A forest over the members of one tile: of pairs that the bound lets pass, or, verified, of links.

    Pairs of one component are passed over. A verified link also joins the components of its ends.
    """
    column = {c: rows.column(c).combine_chunks() for c in rows.column_names}
    name, side, sizes = column["set"].to_numpy(), column["side"].to_numpy(), column["n"].to_numpy()
    points = tile_points(column["point"])
    left, right = np.flatnonzero(side < 2), np.flatnonzero(side > 0)  # 0: left only, 1: both, 2: right only
    component = column["component"].to_numpy()
    forest = Forest(component.tolist() if verify else range(len(name)))
    if verify:
        ends, values = column["shingles"].offsets.to_numpy(), column["shingles"].values.to_numpy()
        heads = shared_heads(values, ends)
        left, right = (np.array([i for i in rows if heads[i]], dtype=np.int64) for rows in (left, right))
    out = []
    for i, j in tree_pairs(points, sizes, left, right):
        other = component[i] != component[j]
        for x, y in zip(i[other].tolist(), j[other].tolist(), strict=True):
            p, q = forest.root(x), forest.root(y)
            if p == q:
                continue
            if verify:
                if heads[x].isdisjoint(heads[y]):
                    continue
                shared = len(np.intersect1d(values[ends[x]:ends[x + 1]], values[ends[y]:ends[y + 1]], assume_unique=True))
                if 100 * shared < 80 * (int(sizes[x]) + int(sizes[y]) - shared):
                    continue
            forest.parent[p] = q
            out.append((int(name[x]), int(name[y])))
    return out


def tiles(members: DataFrame) -> DataFrame:
    """Members (tree, set, n, component) dealt to tiles; a pair that can link meets in one tile at least.

    A tree is cut by classes of size, each with the members of the next class; a cut of more than TILE members into
    shares, and each pair of shares is a tile. The split is by hash and sizes are counted first.
    """
    size_class = F.floor(F.log("n") / F.lit(float(np.log(1.2501)))).cast("int")
    cuts = members.withColumn("_own", size_class).withColumn("cut", F.explode(F.array(F.col("_own"), F.col("_own") - 1)))
    cuts = cuts.withColumn("_next", F.col("_own") != F.col("cut")).drop("_own")
    counts = cuts.groupBy("tree", "cut").agg(F.count(F.lit(1)).alias("_all"), F.sum((~F.col("_next")).cast("int")).alias("_here"))
    counts = counts.where("_all > 1 AND _here > 0").select("tree", "cut", F.ceil(F.col("_all") / F.lit(TILE)).cast("int").alias("shares"))
    dealt = cuts.join(counts, ["tree", "cut"]).withColumn("share", F.pmod(F.xxhash64("set"), F.col("shares")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("shares") - 1))
    dealt = dealt.withColumn("other", other)
    side = F.when(F.col("share") == F.col("other"), 1).when(F.col("share") < F.col("other"), 0).otherwise(2)
    return dealt.withColumn("side", side).withColumn("tile", F.concat_ws(
        ":", "tree", "cut", F.least("share", "other"), F.greatest("share", "other"))).drop("share", "other", "shares", "cut", "_next")


def in_tiles(members: DataFrame, points: DataFrame, sets: DataFrame | None = None) -> DataFrame:
    """Run ``tile_links`` over tiles that stream through sorted partitions; one tile is held at a time."""
    verify = sets is not None
    columns = ["tile", "tree", "side", "set", "n", "component", "point", *(["shingles"] if verify else [])]
    dealt = tiles(members.select("tree", "set", "n", "component")).join(points.select("set", "point"), "set")
    if verify:
        dealt = dealt.join(sets, "set")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        held: list[pa.RecordBatch] = []
        now, results = None, []

        def flush() -> None:
            if sum(part.num_rows for part in held) > 1:
                results.extend(tile_links(pa.Table.from_batches(held), verify))
            held.clear()

        def result() -> pa.RecordBatch:
            pairs = pa.RecordBatch.from_arrays([pa.array([r[k] for r in results], pa.int64()) for k in (0, 1)], names=["a", "b"])
            results.clear()
            return pairs

        for batch in batches:
            tile = batch.column(0).to_pylist()
            edges = [i for i in range(len(tile)) if i == 0 or tile[i] != tile[i - 1]]
            for i, j in zip(edges, [*edges[1:], len(tile)], strict=True):
                if tile[i] != now:
                    flush()
                    now = tile[i]
                held.append(batch.slice(i, j - i))
            if results:
                yield result()
        flush()
        if results:
            yield result()

    return dealt.select(*columns).repartition("tile").sortWithinPartitions("tile").mapInArrow(walk, "a long, b long")


def merged_trees(members: DataFrame, trees: DataFrame) -> DataFrame:
    """Members (tree, set, component) of fewer trees: those with one smallest set (``first``) are one, unless that gives more pairs.

    Texts of one family share very many shingles with nearly the same members, and each tree needs their points. Every
    pair that meets in one of ``trees`` (tree, n, first) meets in one of the result; a set is never in more trees than before.
    """
    apart = trees.groupBy("first").agg(F.sum(F.col("n") * F.col("n")).alias("_apart"), F.min("tree").alias("_tree"))
    whole = members.join(trees.select("tree", "first"), "tree").select("first", "set").distinct().groupBy("first").agg(F.count(F.lit(1)).alias("_all"))
    one = apart.join(whole, "first").where("_all * _all <= _apart").select("first", "_tree")
    names = trees.join(one, "first", "left").select("tree", F.coalesce("_tree", "tree").alias("_name"))
    return members.join(names, "tree").select(F.col("_name").alias("tree"), "set", "component").distinct()


def tree_links(docs: DataFrame, members: DataFrame, points: DataFrame, done: DataFrame, shared: frozenset) -> DataFrame:
    """Links between different components of ``done`` (node, root) under one shingle, beyond those with the centre.

    Points alone go through the trees of all shingles. What the bound lets pass, as a forest, makes groups of near sets;
    the sets themselves are sent once, to the tree of their group, and verified there.
    """
    named = members.join(done, F.col("set") == F.col("node"), "left").select("shingle", "set", F.coalesce("root", "set").alias("component"))
    trees = named.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("_n"), F.min("component").alias("_a"), F.max("component").alias("_b"),
        F.sum(F.xxhash64("set").cast("decimal(38,0)")).alias("_sum"), F.bit_xor(F.xxhash64("set", F.lit(1))).alias("_xor"), F.min("set").alias("first"))
    trees = trees.where("_n > 2 AND _a <> _b").groupBy("first", F.col("_n").alias("n"), "_sum", "_xor").agg(F.min("shingle").alias("tree"))  # equal trees are one
    trees = stored(trees.select("tree", "n", "first"), "trees")
    members = stored(named.join(trees.select("tree"), F.col("shingle") == F.col("tree")).select("tree", "set", "component"), "in-trees")
    members = stored(merged_trees(members, trees).join(points.select("set", "n"), "set"), "open")
    near = components(in_tiles(members, points), "near")
    near = near.select(F.col("node").alias("set"), F.col("root").alias("tree")).unionAll(
        near.select(F.col("root").alias("set"), F.col("root").alias("tree")).distinct())
    near = stored(near.join(members.select("set", "n", "component").distinct(), "set"), "near")
    return stored(in_tiles(near, points, full_sets(docs, points, near.select("set"), shared)), "tree-links")


def linked_sets(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, set, n) of every row, and (node, root) of the sets that are not the root of their component."""
    docs = docs.select("doc_id", "text")
    read = stored(read_sets(docs), "sets")
    double = shared_names(read)
    if double:
        read = read.withColumn("set", F.when((F.col("n") > 0) & F.col("set").isin(*double), F.col("also")).otherwise(F.col("set")))
    of = read.where("n >= 0").select("doc_id", "set", "n")
    held = Round("members")
    rows = held.store(prefixes(docs, frequent_shingles(read), double)).repartition("shingle")  # one shuffle serves count and join
    shared = rows.groupBy("shingle").agg(F.min("set").alias("_a"), F.max("set").alias("_b")).where("_a <> _b").select("shingle")
    members = held.store(rows.join(shared, "shingle").distinct())
    sizes = members.groupBy("set").agg(F.count(F.lit(1)).alias("held")).join(
        of.where("n > 0").groupBy("set").agg(F.min("doc_id").alias("doc_id"), F.min("n").alias("n")), "set")
    points = stored(read.where("point IS NOT NULL").select("set", "point").join(sizes, "set").dropDuplicates(["set"]), "points")
    alone = F.col("n") - F.ceil(4 * F.col("n") / F.lit(5)) + 1 - F.col("held")  # first shingles that no other set has
    central = members.join(points.select("set", "n", alone.alias("alone")), "set").repartition("shingle")
    centre = central.groupBy("shingle").agg(F.min(F.struct("alone", "set", "n")).alias("_c"))
    star = central.join(centre, "shingle").where(F.struct("alone", "set", "n") != F.col("_c"))
    star = star.where(5 * F.least("n", "_c.n") >= 4 * F.greatest("n", "_c.n"))  # before points are sent
    star = stored(bounded(star.select(F.col("_c.set").alias("a"), F.col("set").alias("b")).distinct(), points), "star")
    wanted = star.select(F.col("a").alias("set")).unionAll(star.select(F.col("b").alias("set")))
    links = stored(verified(star, full_sets(docs, points, wanted, double)), "star-links")
    found = components(links)
    more = tree_links(docs, members, points, found, double)
    if not more.isEmpty():
        found = components(links.unionAll(more))
    return of, found


def similar_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and ``class_id`` (the root set; null without shingles) of every row of ``docs``."""
    of, found = linked_sets(docs)
    named = of.join(found, F.col("set") == F.col("node"), "left").select(
        "doc_id", "n", F.when(F.col("n") > 0, F.coalesce("root", "set")).alias("class_id"))
    named = stored(named, "classes")
    least = named.where("class_id IS NOT NULL").groupBy(F.col("class_id").alias("_class")).agg(F.min("doc_id").alias("_least"))
    least = stored(least, "least")  # a large class can then be split
    return named.join(least, F.col("class_id") == F.col("_class"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("class_id").isNull(), F.col("doc_id")).otherwise(F.col("_least")).alias("component_id"), "class_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component: that of the smallest id.

    Rows without shingles stay. Of repeated rows of an id one stays; of rows without an id one for each different text.
    """
    named = similar_documents(docs.select("doc_id", "text"))
    kept = named.where("class_id IS NOT NULL AND component_id IS NOT NULL AND doc_id = component_id").select("doc_id").distinct()
    full = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    bare = docs.where(~F.coalesce(full, F.lit(False)))
    named_rows = docs.where(full).join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    unnamed = docs.where(full & F.col("doc_id").isNull()).dropDuplicates(["text"])
    return bare.unionByName(named_rows).unionByName(unnamed)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")


def brute_force(rows: list[tuple[int, str | None]], k: int = 5) -> dict[int, tuple[int, int]]:
    """doc_id -> (n_shingles, component_id) by comparing all pairs; for tests on small tables."""
    import re

    lower = {i: i + 32 for i in range(65, 91)}
    sets = {}
    for doc, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        sets[doc] = {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        holds = Counter(sets[a])
        for b in ids[i + 1:]:
            if sets[a] and sets[b] and 5 * min(len(sets[a]), len(sets[b])) >= 4 * max(len(sets[a]), len(sets[b])):
                shared = sum(1 for s in sets[b] if s in holds)
                if 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


SQL = None  # links of links need a search that no plain SQL of this size finishes; tests/llm compares with all pairs
