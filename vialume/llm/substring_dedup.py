"""Removal of passages of ``window`` words or more that stand in an earlier document too, by difference-cover anchors.

Method. Two equal passages start at different places of their texts. A difference cover of ``period`` is a set of
residues such that for any two places there is one shift below ``period`` that takes both to residues of the set. So only
windows of ``window - period + 1`` words at covered places are hashed (5 of 21): any match of ``window`` words holds one
such anchor at the same place on both sides. An anchor that stands in two different texts is extended: all full windows
around it are compared by 128 bits, and a window goes where the smallest id that holds it is smaller than the own.

Spread over executors. Texts with the same words are one class from the start; only its first id is searched, as the
others lose everything anyway. Anchors and windows are compared in one shuffle each, by hash. Those that are frequent in
a batch (lossy counting over all rows) never enter it: they are a bounded list (``FREQUENT``), so a passage that a third
of the documents share meets in no task. Texts move once, and only those with shared anchors move a second time; the
rest of the work moves hashes. A group in one task is at most the documents that share a passage less often than once
in 2,000 rows of every batch.

Result: for every row the number of words, the number that goes, the digest of what is left and the spans that stay.

Defined results: words are runs of characters other than space and 0x09 to 0x0D and are compared unchanged. Null and empty
texts have no words and stay as they are. Repeats inside one document stay. Rows with one id are equal in rank: none takes
words from another. Null ids come after all others and take nothing from each other. Repeated rows get the same result each.
Other columns are kept, whatever their names, but for ``n_words`` and ``n_removed``, which are replaced.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vialume.llm.common import stored, table, text_or_empty
from vialume.llm.textkernel import U, Words, _power, buffers, chunks, mix

QUERY = "op12_substring_dedup"
WINDOW = 50
PERIOD = 21
#: Frequent values kept apart: at most so many, each found in so many texts at least.
FREQUENT = 1 << 16
FREQUENT_ROWS = 24
#: Difference sets in which every difference occurs once.
PERFECT = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 3, 4, 9, 11), 31: (0, 1, 3, 8, 12, 18)}
_BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)
_INVERSES = tuple(pow(b, -1, 2**64) for b in _BASES)
_NO_ID = 2**63 - 1
_BLANK = r"[\x20\x09-\x0D]+"


def difference_cover(period: int) -> tuple[int, ...]:
    """Residues such that any two places have a shift below ``period`` that takes both to one of them."""
    if period in PERFECT:
        return PERFECT[period]
    step = math.isqrt(period - 1) + 1  # a small number and a multiple of the step make any difference
    return tuple(sorted({*range(step), *range(0, period, step)}))


class Shape(NamedTuple):
    """Length of a passage, and the period of the cover."""

    window: int = WINDOW
    period: int = PERIOD

    @property
    def anchor(self) -> int:
        return self.window - self.period + 1

    def places(self, n: int) -> np.ndarray:
        """Covered places among the first ``n``."""
        places = np.arange(0, n + self.period, self.period)[:, None] + np.array(difference_cover(self.period))
        places = places.ravel()
        return places[places < n]


def window_hashes(words: np.ndarray, length: int, which: int) -> np.ndarray:
    """Hash of the ``length`` words from each place, by sums over powers of one of two bases."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, U)
    sums = np.zeros(len(words) + 1, U)
    np.cumsum(words * _power(_BASES[which], len(words))[:len(words)], out=sums[1:])
    return mix((sums[length:] - sums[:n]) * _power(_INVERSES[which], n)[:n] + U(length))


def class_of(words: np.ndarray) -> tuple[int, int]:
    """128 bits of the whole sequence of words."""
    return tuple(int(window_hashes(words, len(words), k).view(np.int64)[0]) if len(words) else 0 for k in (0, 1))


def anchors(words: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Covered places of a text and the hashes of the anchors there."""
    if len(words) < shape.window:
        return np.zeros(0, np.int64), np.zeros(0, U)
    found = window_hashes(words, shape.anchor, 0)
    places = shape.places(len(found))
    return places, found[places]


def each_text(texts: pa.Array) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """Number, bytes and word hashes of each text."""
    data, offsets = buffers(texts)
    for i, j in chunks(offsets):
        words = Words(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        hashes = words.hashes()
        for k in range(j - i):
            yield i + k, data[offsets[i + k]:offsets[i + k + 1]].tobytes(), hashes[words.first[k]:words.first[k + 1]]


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


class Often:
    """Values that many texts of a batch share: a count for each."""

    def __init__(self) -> None:
        self.found: list[np.ndarray] = []

    def add(self, values: np.ndarray) -> None:
        self.found.append(np.unique(values))

    def counts(self, rows: int) -> tuple[np.ndarray, np.ndarray]:
        if not self.found:
            return np.zeros(0, U), np.zeros(0, np.int64)
        values, n = np.unique(np.concatenate(self.found), return_counts=True)
        often = n >= max(3, rows // 2000)
        return values[often], n[often]


def read_words(docs: DataFrame, shape: Shape) -> DataFrame:
    """For each row (rid, th, c1, c2, n, digest): its class, number of words and digest of all its words.

    Also rows with rid null, an anchor in c1 and a count below 0 in n, of anchors that many texts of a batch share.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.num_rows
            c1, c2, n, digests = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64), [b""] * size
            seen, often = set(), Often()
            for i, raw, words in each_text(batch.column(2)):
                c1[i], c2[i] = class_of(words)
                n[i] = len(words)
                digests[i] = hashlib.sha256(b" ".join(raw.split())).digest()
                if len(words) >= shape.window and (c1[i], c2[i]) not in seen:
                    seen.add((c1[i], c2[i]))
                    often.add(anchors(words, shape)[1])
            values, counts = often.counts(size)
            none = pa.nulls(len(values), pa.int64())
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([batch.column(0), none]), pa.concat_arrays([batch.column(1), none]),
                pa.array(np.concatenate((c1, values.view(np.int64)))), pa.concat_arrays([pa.array(c2), none]),
                pa.array(np.concatenate((n, -counts))), pa.array([*digests, *[None] * len(values)], pa.binary()),
            ], names=["rid", "th", "c1", "c2", "n", "digest"])

    return docs.select("rid", "th", "text").mapInArrow(read, "rid long, th long, c1 long, c2 long, n long, digest binary")


def frequent(counts: DataFrame, key: list[str]) -> pa.Table:
    """The most frequent keys by their summed ``n``: at most ``FREQUENT``, in ``FREQUENT_ROWS`` texts each."""
    summed = stored(counts.groupBy(*key).agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT_ROWS), "frequent")
    level, room = 64, FREQUENT
    sizes = {r["level"]: r["rows"] for r in summed.groupBy(F.floor(F.log2("n")).alias("level")).agg(
        F.count(F.lit(1)).alias("rows")).collect()}  # at most 64 rows
    for k in sorted(sizes, reverse=True):
        room -= sizes[k]
        if room < 0:
            break
        level = k
    return summed.where(F.floor(F.log2("n")) >= level).select(*key).orderBy(*key).toArrow()


def rare_anchors(docs: DataFrame, often: np.ndarray, shape: Shape) -> DataFrame:
    """Rows (anchor, c1, often): the anchors of each text that are not frequent, and one row for a text with frequent ones."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, of, flags, seen = [], [], [], set()
            for _, _, words in each_text(batch.column(0)):
                if len(words) < shape.window or (name := class_of(words)) in seen:
                    continue
                seen.add(name)
                found = np.unique(anchors(words, shape)[1])
                hot = _among(found, often)
                values.append(found[~hot].view(np.int64))
                flags.append(np.zeros(len(values[-1]), bool))
                if hot.any():
                    values.append(np.array(name[1:]))
                    flags.append(np.ones(1, bool))
                of.append(np.full(len(found) - hot.sum() + hot.any(), name[0]))
            if of:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (values, of, flags)], names=["anchor", "c1", "often"])

    return docs.select("text").mapInArrow(read, "anchor long, c1 long, often boolean")


def shared_anchors(docs: DataFrame, often: np.ndarray, shape: Shape) -> DataFrame:
    """(c1, anchors): the anchors of each class of texts that stand in another class too, without the frequent ones."""
    same = Window.partitionBy("anchor")
    found = rare_anchors(docs, often, shape).withColumn("least", F.min("c1").over(same)).withColumn("most", F.max("c1").over(same))
    return found.where("often OR least <> most").groupBy("c1").agg(F.collect_set("anchor").alias("anchors"))


def with_candidates(docs: DataFrame, rows: DataFrame, shape: Shape, often: np.ndarray) -> DataFrame:
    """Texts that share anchors, one row for each class: (at, rid, c1, c2, packed text, anchors)."""
    firsts = rows.where(F.col("n") >= shape.window).groupBy("c1", "c2").agg(F.min(F.struct("rid", "th")).alias("first"))
    wanted = shared_anchors(docs, often, shape).join(firsts, "c1").select("first.rid", "first.th", "c1", "c2", "anchors")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            squeeze = zstandard.ZstdCompressor(level=1)
            packed = [squeeze.compress(text.as_buffer()) for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["rid", "th", "packed"])

    long = docs.where(F.octet_length("text") >= 2 * shape.window - 1)  # shorter texts have no window
    texts = long.select("rid", "th", "text").mapInArrow(pack, "rid long, th long, packed binary")
    texts = texts.groupBy("rid", "th").agg(F.first("packed").alias("packed"))
    found = texts.join(wanted, ["rid", "th"]).withColumn("at", F.monotonically_increasing_id())
    return stored(found.select("at", "rid", "c1", "c2", "packed", "anchors"), "candidates")


def _unpacked(packed: pa.Array) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """Number, bytes and word hashes of packed texts, one at a time."""
    for i, value in enumerate(packed):
        raw = zstandard.ZstdDecompressor().decompress(value.as_buffer())
        words = Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        yield i, raw, words.hashes()


def extended(words: np.ndarray, own: np.ndarray, often: np.ndarray, shape: Shape) -> np.ndarray:
    """Places of the full windows around the shared anchors of a text."""
    places, found = anchors(words, shape)
    at = places[_among(found, own) | _among(found, often)]
    n = len(words) - shape.window + 1
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, np.maximum(at - shape.period + 1, 0), 1)
    np.add.at(edges, np.minimum(at + 1, n), -1)
    return np.flatnonzero(np.cumsum(edges[:n]) > 0)


def candidate_windows(batch: pa.RecordBatch, often: np.ndarray, shape: Shape) -> Iterator[tuple[int, bytes, int, np.ndarray, np.ndarray]]:
    """For each text: number, bytes, number of words, places of its candidate windows and their hashes (two columns)."""
    column = {c: batch.column(c) for c in ("packed", "anchors")}
    for i, raw, words in _unpacked(column["packed"]):
        own = np.sort(column["anchors"][i].values.to_numpy(zero_copy_only=False).view(U))
        places = extended(words, own, often, shape)
        names = np.stack([window_hashes(words, shape.window, k)[places] for k in (0, 1)], axis=1)
        yield i, raw, len(words), places, names


def frequent_windows(found: DataFrame, often: np.ndarray, shape: Shape) -> np.ndarray:
    """First hashes of the candidate windows that many texts share."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = Often()
            for _, _, _, _, names in candidate_windows(batch, often, shape):
                seen.add(names[:, 0])
            values, n = seen.counts(batch.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n)], names=["h1", "n"])

    rows = frequent(found.select("packed", "anchors").mapInArrow(count, "h1 long, n long"), ["h1"])
    return np.sort(rows.column("h1").to_numpy().view(U))


def windows_of(found: DataFrame, often: np.ndarray, hot: np.ndarray, shape: Shape, of_hot: bool) -> DataFrame:
    """Rows (h1, h2, rid, at, place) of the candidate windows: of the frequent ones, or of all others."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid, at = batch.column("rid").to_numpy(), batch.column("at").to_numpy()
            for i, _, _, places, names in candidate_windows(batch, often, shape):
                keep = _among(names[:, 0], hot) == of_hot
                n = int(keep.sum())
                if n:
                    yield pa.RecordBatch.from_arrays([
                        pa.array(names[keep, 0].view(np.int64)), pa.array(names[keep, 1].view(np.int64)), pa.array(np.full(n, rid[i])),
                        pa.array(np.full(n, at[i])), pa.array(places[keep].astype(np.int64))], names=["h1", "h2", "rid", "at", "place"])

    return found.select("at", "rid", "packed", "anchors").mapInArrow(read, "h1 long, h2 long, rid long, at long, place long")


def removals(found: DataFrame, often: np.ndarray, shape: Shape) -> DataFrame:
    """For each candidate class (c1, c2): the number of words that go, the digest and the spans of those that stay."""
    hot = frequent_windows(found, often, shape)
    firsts = windows_of(found, often, hot, shape, True).groupBy("h1", "h2").agg(F.min("rid").alias("least")).toArrow()
    first = {(r["h1"], r["h2"]): r["least"] for r in firsts.to_pylist()}  # as bounded as the list of frequent ones
    rare = windows_of(found, often, hot, shape, False)
    rare = rare.withColumn("least", F.min("rid").over(Window.partitionBy("h1", "h2"))).where("rid > least")
    places = rare.groupBy("at").agg(F.collect_list("place").alias("places"))
    joined = found.join(places, "at", "left").select("rid", "c1", "c2", "packed", "anchors", "places")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid, given, out = batch.column("rid").to_numpy(), batch.column("places"), []
            for i, raw, n, at, of in candidate_windows(batch, often, shape):
                known = np.flatnonzero(_among(of[:, 0], hot))
                names = zip(*of[known].view(np.int64).T.tolist()) if len(known) else ()
                starts = [at[[k for k, name in zip(known.tolist(), names) if first[name] < rid[i]]]]
                if given[i].is_valid:
                    starts.append(given[i].values.to_numpy(zero_copy_only=False))
                starts = np.concatenate(starts)
                edges = np.zeros(n + 1, np.int64)
                np.add.at(edges, starts, 1)
                np.add.at(edges, starts + shape.window, -1)
                stays = np.cumsum(edges[:n]) == 0
                turns = np.flatnonzero(np.diff(np.concatenate(([False], stays, [False])).astype(np.int8)))
                words = raw.split()
                kept = [(int(a), int(b)) for a, b in turns.reshape(-1, 2)]
                digest = hashlib.sha256(b" ".join(w for a, b in kept for w in words[a:b])).digest()
                out.append((n - int(stays.sum()), digest, [{"start": a, "length": b - a} for a, b in kept]))
            span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
            yield pa.RecordBatch.from_arrays([
                batch.column("c1"), batch.column("c2"), pa.array([x[0] for x in out], pa.int64()),
                pa.array([x[1] for x in out], pa.binary()), pa.array([x[2] for x in out], span)], names=["c1", "c2", "gone", "left", "spans"])

    return joined.mapInArrow(apply, "c1 long, c2 long, gone long, left binary, spans array<struct<start: long, length: long>>")


def row_key(doc_id: str, text: str) -> list:
    return [F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID)).alias("rid"), F.xxhash64(text_or_empty(text)).alias("th")]


def repeated_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shape: Shape = Shape()) -> DataFrame:
    """For every row of ``docs``: rid, th (:func:`row_key`), n_words, n_removed, kept_sha256 and ``spans``.

    ``spans`` are the runs of words that stay (start, length); null where no word goes.
    """
    docs = docs.select(*row_key(doc_id, text), F.col(text).alias("text"))
    read = stored(read_words(docs, shape), "words")
    rows = read.where("rid IS NOT NULL")
    often = frequent(read.where("rid IS NULL").select("c1", (-F.col("n")).alias("n")), ["c1"])
    often = np.sort(often.column("c1").to_numpy().view(U))
    found = with_candidates(docs, rows, shape, often)
    of = rows.where(F.col("n") >= shape.window).groupBy("c1", "c2").agg(F.min("rid").alias("first"))
    of = stored(of.join(removals(found, often, shape), ["c1", "c2"], "left"), "classes")  # a large class of copies can then be split
    joined = rows.join(of, ["c1", "c2"], "left")
    copy, cut = F.col("rid") > F.col("first"), F.col("gone") > 0
    return joined.select(
        "rid", "th", F.col("n").alias("n_words"),
        F.when(copy, F.col("n")).when(cut, F.col("gone")).otherwise(0).cast("long").alias("n_removed"),
        F.when(copy, F.sha2(F.lit(b""), 256)).when(cut, F.lower(F.hex("left"))).otherwise(F.lower(F.hex("digest"))).alias("kept_sha256"),
        F.when(copy, F.expr("cast(array() AS array<struct<start: long, length: long>>)")).when(cut, F.col("spans")).alias("spans"))


def dedup_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shape: Shape = Shape()) -> DataFrame:
    """``docs`` with the words that are left, joined by one space, and the columns n_words and n_removed.

    A text from which nothing goes stays as it is.
    """
    found = repeated_words(docs, doc_id, text, shape).select("rid", "th", F.struct("n_words", "n_removed", "spans").alias("of")).dropDuplicates(["rid", "th"])
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *row_key(doc_id, text))
    joined = rows.join(found, ["rid", "th"])
    words = F.filter(F.split(F.col("row")[text], _BLANK), lambda w: w != "")
    left = F.array_join(F.flatten(F.transform(F.col("of.spans"), lambda s: F.slice(words, (s["start"] + 1).cast("int"), s["length"].cast("int")))), " ")
    kept = F.when(F.col("of.n_removed") > 0, left).otherwise(F.col("row")[text])
    return joined.select(*[(kept if c == text else F.col("row")[c]).alias(c) for c in docs.columns if c not in ("n_words", "n_removed")],
                         "of.n_words", "of.n_removed")


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_words(table(spark, sf_dir, "documents"))
    return found.select(F.when(F.col("rid") < _NO_ID, F.col("rid")).alias("doc_id"), "n_words", "n_removed", "kept_sha256")


SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS pos FROM d WHERE len(ws) >= 50),
w AS (SELECT doc_id, pos, md5_number(array_to_string(ws[pos:pos + 49], ' ')) AS h FROM p),
f AS (SELECT h, min(doc_id) AS least FROM w GROUP BY h),
c AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS pos FROM w JOIN f USING (h) WHERE doc_id > least),
a AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM d),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS left_text FROM a ANTI JOIN c USING (doc_id, pos) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM c GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n.n, 0) AS n_removed, sha256(coalesce(left_text, '')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)
"""
