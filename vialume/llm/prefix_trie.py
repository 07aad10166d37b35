"""Prefix trie of conversations by van Emde Boas recursion on their depth.

Method. Sequences of turns are cut at half of their depth, each half at half again, down to single turns; ``CUTS`` such
cuts are made by one job, for all parts of all sequences at once. On the way up a segment gets a name of 128 bits from
the names of its parts. On the way down a prefix that ends at a cut gets its name from the prefix at the cut before and
the segments between, so equal prefixes have equal names and all nodes of the trie are known after a number of jobs that
grows with the logarithm of the depth. Totals go the same ways: each band of depths is summed for the nodes at its top
(lower forests), the sums are grafted on the band above, level by level up to the root, and then handed down to the nodes
between the cuts. Every node enters a bounded number of sums per level, and a level has an eighth of the nodes of the one before.

Spread over executors. No step walks along a conversation, so one conversation may hold any share of the turns: the order
of its turns comes from one sort over all rows, cut at any place. Names and sums are aggregated before the shuffle, so a
prefix that a third of the conversations share is one row for each task. Joins have one row for each key on one side and
are left to adaptive execution. Ids of the conversations that end at a node are joined 1,024 at a time and then streamed
through one digest for each node, in order, without holding them.

Defined results: a null role or text is empty. Rows with a null conversation take no part. Null turns come first; rows of equal turn
are ordered by role, then text, and repeated rows are turns of their own. An empty table has no nodes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vialume.llm.common import stored, table

QUERY = "op13_prefix_trie"
CUTS = 3
CHUNK_BITS = 10
KEY = ["depth", "a", "b"]


def numbered_turns(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, k, a, b, bytes): the place of each turn in its conversation from 0, its name, and the bytes of its text."""
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.orderBy("conv_id", F.asc_nulls_first("turn"), "role", "text").select(
        "conv_id", F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit(1), "text", "role").alias("b"),
        F.octet_length("text").cast("long").alias("bytes"), F.monotonically_increasing_id().alias("row"))
    laid = stored(ordered, "turns").withColumn("part", F.shiftright("row", 33))
    sizes = laid.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # a row for each partition of the sort
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    seen = laid.join(F.broadcast(sizes), "part").withColumn("at", F.col("before") + F.col("row").bitwiseAND(2**33 - 1))
    starts = seen.groupBy("conv_id").agg(F.min("at").alias("start"))
    return stored(seen.join(starts, "conv_id").select("conv_id", (F.col("at") - F.col("start")).alias("k"), "a", "b", "bytes"), "numbered")


def _root() -> list[Column]:
    return [F.lit(0).cast("long").alias(c) for c in ("a", "b")]


def _fold(items: Column, start: Column) -> Column:
    """Name of a sequence: that of what stands before it, mixed with each part in turn."""
    return F.aggregate(items, start, lambda h, x: F.struct(F.xxhash64(h["a"], x["a"]).alias("a"), F.xxhash64(h["b"], x["b"], F.lit(7)).alias("b")))


def named_prefixes(turns: DataFrame, width: int) -> tuple[DataFrame, int]:
    """Rows (conv_id, depth, a, b, bytes) for each prefix of each conversation, and the number of levels."""
    longest = turns.agg(F.max("k")).first()[0]
    levels = 1
    while longest is not None and width**levels <= longest + 1:
        levels += 1
    blocks, items = [], turns
    for _ in range(levels):  # names of segments, bottom up
        held = F.array_sort(F.collect_list(F.struct("k", "a", "b", "bytes"))).alias("items")
        blocks.append(stored(items.groupBy("conv_id", F.floor(F.col("k") / F.lit(width)).alias("block")).agg(held), "blocks"))
        whole = blocks[-1].where(F.size("items") == width)
        name = _fold(F.col("items"), F.struct(F.lit(11).cast("long").alias("a"), F.lit(13).cast("long").alias("b")))
        items = whole.select("conv_id", F.col("block").alias("k"), name.alias("n"), F.element_at("items", -1)["bytes"].alias("bytes"))
        items = items.select("conv_id", "k", "n.a", "n.b", "bytes")
    starts, found = None, []
    for level in reversed(range(levels)):  # names of prefixes, top down
        root = F.struct(*_root())
        if starts is None:
            named = blocks[level].withColumn("start", root)
        else:
            named = blocks[level].join(starts.withColumn("start", F.struct("a", "b")).drop("a", "b"), ["conv_id", "block"], "left")
            named = named.withColumn("start", F.coalesce("start", root))  # only the first block has none
        ends = F.transform(F.sequence(F.lit(1), F.least(F.size("items"), F.lit(width - 1))), lambda r: F.struct(
            r.alias("r"), _fold(F.slice("items", F.lit(1), r), F.col("start")).alias("n"), F.element_at("items", r)["bytes"].alias("bytes")))
        inside = named.select("conv_id", "block", F.inline(ends)).select(
            "conv_id", (F.col("block") * width + F.col("r")).alias("block"), "n.a", "n.b", "bytes")
        inside = stored(inside, "prefixes")
        found.append(inside.select("conv_id", (F.col("block") * width**level).alias("depth"), "a", "b", "bytes"))
        handed = inside.select("conv_id", "block", "a", "b")
        starts = handed if starts is None else handed.unionByName(starts.select("conv_id", (F.col("block") * width).alias("block"), "a", "b"))
    prefixes = found[0]
    for more in found[1:]:
        prefixes = prefixes.unionByName(more)
    return prefixes, levels


def links_up(nodes: DataFrame, prefixes: DataFrame, width: int, levels: int) -> DataFrame:
    """Rows (level, at, node, up_depth, up_a, up_b): from each node to those above it in its band, at every level it takes part in.

    ``at`` is the place of the upper node in the band, 0 at its top. A node at the top of the next band is linked to all but the top.
    """
    depth = F.col("depth")

    def of_level(level: int) -> Column:
        unit = width**level
        rest = F.floor(depth / F.lit(unit)) % F.lit(width)
        place = F.when(rest == 0, width).otherwise(rest)
        steps = F.when(depth % unit != 0, 0).when(rest == 0, width - 1).otherwise(rest)
        every = F.transform(F.sequence(F.lit(1), F.lit(width - 1)), lambda i: F.struct(
            F.lit(level).alias("level"), (place - i).cast("long").alias("at"), (depth - i * unit).cast("long").alias("up_depth")))
        return F.slice(every, F.lit(1), steps.cast("int"))

    rows = nodes.where(depth > 0).select("conv_id", F.struct(*KEY).alias("node"), F.inline(F.concat(*[of_level(level) for level in range(levels)])))
    upper = prefixes.select("conv_id", F.col("depth").alias("up_depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"))
    return stored(rows.join(upper, ["conv_id", "up_depth"]).drop("conv_id"), "links")


def _sent(links: DataFrame, values: DataFrame, names: list[str]) -> DataFrame:
    """Values of nodes, keyed by the upper node of each link."""
    flat = links.select(*[F.col(f"node.{c}").alias(c) for c in KEY], "up_depth", "up_a", "up_b")
    return flat.join(values, KEY).select(*[F.col(f"up_{c}").alias(c) for c in KEY], *names)


def _summed(rows: DataFrame, names: list[str], label: str) -> DataFrame:
    return stored(rows.groupBy(*KEY).agg(*[F.sum(c).alias(c) for c in names]), label)


def subtree_totals(values: DataFrame, links: DataFrame, names: list[str], width: int, levels: int) -> DataFrame:
    """Sums of ``names`` over the subtree of each node, itself included."""
    bands = [values.select(*KEY, *names)]
    for level in range(levels):  # lower forests are summed for the tops of their bands
        tops = bands[level].where(F.col("depth") % width ** (level + 1) == 0)
        into = _sent(links.where((F.col("level") == level) & (F.col("at") == 0)), bands[level], names)
        bands.append(_summed(tops.unionByName(into), names, "bands"))
    done = bands[levels]
    for level in reversed(range(levels)):  # and handed on to the nodes between the cuts
        own = bands[level].where(F.col("depth") % width ** (level + 1) != 0)
        into = _sent(links.where((F.col("level") == level) & (F.col("at") > 0)), own.unionByName(done), names)
        done = done.unionByName(_summed(own.unionByName(into), names, "subtrees"))
    return done


def ends_digest(ends: DataFrame) -> DataFrame:
    """Digest of the sorted ids of the conversations that end at each node."""
    chunks = ends.groupBy(*KEY, F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in range(4)]
            for depth, a, b, ids in zip(*columns, strict=True):
                if (depth, a, b) != now:
                    if now is not None:
                        out.append((*now, state.hexdigest()))
                    now, state = (depth, a, b), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _rows(out)
        if now is not None:
            yield _rows([(*now, state.hexdigest())])

    def _rows(out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names=[*KEY, "ends_sha256"])

    inorder = chunks.repartition(*KEY).sortWithinPartitions(*KEY, "chunk").select(*KEY, "ids")
    return inorder.mapInArrow(digest, "depth long, a long, b long, ends_sha256 string")


def prefix_trie(turns: DataFrame, lengths: DataFrame, cuts: int = CUTS) -> DataFrame:
    """One row for each node of the trie.

    ``turns`` has (conv_id, k, a, b, bytes) as :func:`numbered_turns` gives them, ``lengths`` one row (conv_id, length) for every
    conversation, also those without turns. Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.
    """
    width = 2**cuts
    prefixes, levels = named_prefixes(turns, width)
    prefixes = prefixes.unionByName(lengths.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), *_root(), F.lit(0).cast("long").alias("bytes")))
    nodes = stored(prefixes.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.first("bytes").alias("bytes")), "nodes")
    links = links_up(nodes, prefixes, width, levels)
    to_parent = links.where((F.col("level") == 0) & (F.col("up_depth") == F.col("node.depth") - 1))
    children = to_parent.groupBy(*[F.col(f"up_{c}").alias(c) for c in KEY]).agg(F.count(F.lit(1)).alias("n_children"))
    values = nodes.select(*KEY, F.lit(0).alias("n_children"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"))
    values = values.unionByName(children.withColumn("saved_tokens", F.lit(0)))
    values = _summed(values, ["n_children", "saved_tokens"], "values").withColumn("n_leaves", (F.col("n_children") == 0).cast("long"))
    totals = subtree_totals(values, links, ["n_leaves", "saved_tokens"], width, levels)
    above = nodes.select(*[F.col(c).alias(f"up_{c}") for c in KEY], F.col("conv_id").alias("parent_conv_id"))
    parents = to_parent.join(above, [f"up_{c}" for c in KEY]).select("node.*", "parent_conv_id")
    ends = prefixes.join(lengths.select("conv_id", F.col("length").alias("depth")), ["conv_id", "depth"])
    parts = [nodes.drop("bytes"), values.select(*KEY, "n_children"), totals, stored(parents, "parents"), stored(ends_digest(ends), "ends")]
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more, allowMissingColumns=True)
    names = ["conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    one = rows.groupBy(*KEY).agg(*[F.max(c).alias(c) for c in names])
    return one.select("conv_id", "depth", *names[1:-1], F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and lengths of the conversations of the query: the head of conversation c - c % 5, then the own turns after it."""
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    convs = convs.select("conv_id", "n", (F.crc32(F.col("conv_id").cast("string")) % 9).alias("h"), (F.col("conv_id") - F.col("conv_id") % 5).alias("base"))
    heads = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = convs.join(heads, "base", "left").withColumn("head", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = stored(convs.withColumn("length", F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "convs")
    own = turns.join(convs.select("conv_id", "h", "head"), "conv_id").where("k >= h").withColumn("k", F.col("head") + F.col("k") - F.col("h"))
    first = turns.where("k < 9").withColumnRenamed("conv_id", "base")
    taken = first.join(convs.select("conv_id", "base", "head"), "base").where("k < head")
    columns = ["conv_id", "k", "a", "b", "bytes"]
    return stored(own.select(*columns).unionByName(taken.select(*columns)), "rebuilt"), convs.select("conv_id", "length")


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*rebuilt(numbered_turns(table(spark, sf_dir, "conversations"))))


SQL = """
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS k
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, count(*) AS n, xor(4294967295, list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ord(s)::BIGINT)),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[]),
    lambda v, i: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END)))) % 9 AS h FROM t GROUP BY conv_id),
b AS (SELECT c.*, least(h, coalesce(o.n, 0)) AS head FROM c LEFT JOIN (SELECT conv_id AS base, n FROM c) o USING (base)),
r AS (SELECT b.conv_id, head + k - h AS k, role, text FROM b JOIN t USING (conv_id) WHERE k >= h
  UNION ALL SELECT b.conv_id, k, role, text FROM b JOIN t ON t.conv_id = b.base WHERE k < head),
p AS (SELECT conv_id, k + 1 AS depth, strlen(text) AS bytes,
  sha256(string_agg(sha256(strlen(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY k)) AS name FROM r
  UNION ALL SELECT conv_id, 0, 0, 'root' FROM b),
n AS (SELECT depth, name, min(conv_id) AS m, count(*) AS n_convs, any_value(bytes) AS bytes FROM p GROUP BY ALL),
up AS (SELECT y.depth AS d, y.name AS y, y.n_convs, y.bytes, x.depth AS up_depth, x.name AS up FROM n y JOIN p x ON x.conv_id = y.m AND x.depth <= y.depth),
ch AS (SELECT up_depth AS depth, up AS name, count(*) AS n_children FROM up WHERE up_depth = d - 1 GROUP BY ALL),
s AS (SELECT up_depth AS depth, up AS name, count(*) FILTER (ch.n_children IS NULL) AS n_leaves, sum((n_convs - 1) * bytes) AS saved
  FROM up LEFT JOIN ch ON ch.depth = d AND ch.name = y GROUP BY ALL),
e AS (SELECT p.depth, p.name, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM p
  JOIN (SELECT conv_id, max(depth) AS depth FROM p GROUP BY conv_id) USING (conv_id, depth) GROUP BY ALL)
SELECT n.m AS conv_id, n.depth, q.m AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM n JOIN s USING (depth, name) LEFT JOIN ch USING (depth, name) LEFT JOIN e USING (depth, name)
LEFT JOIN up ON up.d = n.depth AND up.y = n.name AND up.up_depth = n.depth - 1
LEFT JOIN n q ON q.depth = up.up_depth AND q.name = up.up
"""
