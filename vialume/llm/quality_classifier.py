"""Quality scores from compression: does a text shrink more beside good or beside bad examples?

Labelled texts of one fold become two zstandard dictionaries (raw content, one for each label). Every text is
compressed in blocks of 2,048 bytes, whole and to its end, with either dictionary. The difference of the two
sizes and the smaller size, both over the length of the text, go through a logistic function whose
weights are fitted on the other fold of the labelled texts, so a score is a calibrated probability.

Fit on a bounded sample: at most ``SAMPLE`` labelled rows of each label and fold, in the order of a hash of
the id, whole texts. A dictionary takes the whole of a short text and pieces from begin to end of a long one, the weights are
fitted on the features of whole texts. Rows whose crc32 of the id modulo 3 is 1 are never learned
from. The rows of a label weigh as many as it has. Scoring covers all rows and whole texts.

Defined results: null and empty texts have the features 0 and a score from them. Null labels and ids
are not learned from; several labels of one id count as their smallest. Where one label has no rows,
every score is the share of label 1, drawn towards 0.5. Repeated rows are scored each by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vialume.llm.common import keep_only, smallest_hashes, stored, table, text_or_empty

QUERY = "op9_quality_classifier"
SAMPLE = 2000
DICTIONARY = 1 << 18
BLOCK = 2048
LEVEL = 3


def fold(column: str):
    return F.crc32(F.col(column).cast("string").cast("binary")) % 3


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[DataFrame, dict[int, int]]:
    """(_fold, quality, text) of the sampled rows, whole texts, and the number of rows of each label."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = known.withColumn("_fold", fold("doc_id").cast("int")).where("_fold <> 1")
    counts = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = None
    for part in (0, 2):
        for label in (0, 1):
            some = smallest_hashes(known.where((F.col("_fold") == part) & (F.col("quality") == label)), ["doc_id"], sample)
            picked = some if picked is None else picked.unionAll(some)
    texts = docs.select("doc_id", text_or_empty().alias("text")).join(
        F.broadcast(picked), "doc_id").dropDuplicates(["doc_id"])  # at most 4 * sample ids are broadcast
    return stored(texts.select("doc_id", "_fold", "quality", "text"), "labelled"), counts


def spread_pieces(data: bytes, size: int, piece: int = 256) -> bytes:
    """At most ``size`` bytes of a text: all of it, or pieces at even distances from its begin to its end."""
    if len(data) <= size:
        return data
    n = max(1, size // piece)
    return b"".join(data[at:at + piece] for at in np.linspace(0, max(0, len(data) - piece), n).astype(int).tolist())


def build_dictionary(sample: DataFrame, texts: int) -> bytes:
    """Pieces of each of about ``texts`` texts, the first texts last, where zstandard finds them cheapest."""
    each = max(512, DICTIONARY // max(1, texts))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        for batch in batches:
            pieces = [spread_pieces(t.as_py().encode(), each) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pieces, pa.binary())], names=["doc_id", "piece"])

    rows = sample.select("doc_id", "text").mapInArrow(cut, "doc_id long, piece binary").orderBy(F.xxhash64("doc_id"), "doc_id")
    parts, size = [], 0
    for (piece,) in rows.select("piece").collect():  # at most 512 bytes a text beyond DICTIONARY in all
        if size + len(piece) > DICTIONARY:
            break
        parts.append(bytes(piece))
        size += len(piece)
    return b"".join(reversed(parts))


class Sizes:
    """Compressed sizes with the two dictionaries."""

    def __init__(self, dictionaries: tuple[bytes, bytes]):
        self.by_label = []
        for data in dictionaries:
            held = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=LEVEL)
            self.by_label.append(zstandard.ZstdCompressor(dict_data=held, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False))

    def features(self, text: str | None) -> tuple[float, float]:
        data = (text or "").encode()
        if not data:
            return 0.0, 0.0
        bad = good = least = 0
        for at in range(0, len(data), BLOCK):
            block = data[at:at + BLOCK]
            b, g = len(self.by_label[0].compress(block)), len(self.by_label[1].compress(block))
            bad, good, least = bad + b, good + g, least + min(b, g)
        return (bad - good) / len(data), least / len(data)


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights of a constant and the columns of ``x``, by Newton's method."""
    mean, spread = x.mean(0), x.std(0) + 1e-9
    z = np.c_[np.ones(len(x)), (x - mean) / spread]
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (weight * p * (1 - p) + 1e-9)[:, None]).T @ z + ridge * np.eye(len(w)), z.T @ (weight * (p - y)) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return np.r_[w[0] - (w[1:] * mean / spread).sum(), w[1:] / spread]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """The two dictionaries and the weights of the logistic function."""
    rows, counts = labelled_sample(docs.select("doc_id", "text"), labels, sample)
    sizes = {(r[0], r[1]): r[2] for r in rows.groupBy("_fold", "quality").agg(F.count(F.lit(1))).collect()}
    folds = {}
    for q in (0, 1):  # a fold without a label borrows the other's rows
        there = [f for f in (0, 2) if sizes.get((f, q))]
        if not there:
            p = (counts.get(1, 0) + 1) / (counts.get(0, 0) + counts.get(1, 0) + 2)
            return {"dictionaries": (b"", b""), "weights": [float(np.log(p / (1 - p))), 0.0, 0.0]}
        folds[q] = (there[0], there[-1])
    dictionaries = tuple(build_dictionary(rows.where((F.col("_fold") == folds[q][0]) & (F.col("quality") == q)), sizes[folds[q][0], q]) for q in (0, 1))
    held = rows.where(" OR ".join(f"_fold = {folds[q][1]} AND quality = {q}" for q in (0, 1))).select("quality", "text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        both = Sizes(dictionaries)
        for batch in batches:
            x = [both.features(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), *(pa.array([v[i] for v in x], pa.float64()) for i in (0, 1))], names=["y", "a", "b"])

    found = held.mapInArrow(measure, "y int, a double, b double").orderBy("y", "a", "b").toPandas()  # three numbers a sampled row
    y = found["y"].to_numpy(dtype=float)
    weight = np.where(y == 1, counts[1] / max(1, (y == 1).sum()), counts[0] / max(1, (y == 0).sum()))
    return {"dictionaries": dictionaries, "weights": fit_logistic(found[["a", "b"]].to_numpy(), y, weight / weight.mean()).tolist()}


def score(docs: DataFrame, model: dict, name: str = "score") -> DataFrame:
    """``docs`` with the score of ``text``; a column called ``name`` is replaced."""
    kept = [c for c in docs.columns if c != name]
    rows = docs.select(*kept)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), f"`{name}` double"])
    at = kept.index("text")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        sizes, w = Sizes(model["dictionaries"]), model["weights"]
        for batch in batches:
            x = np.array([sizes.features(t.as_py()) for t in batch.column(at)]).reshape(-1, 2)
            p = 1 / (1 + np.exp(-np.clip(w[0] + x @ np.array(w[1:]), -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64())], names=[*kept, name])

    return rows.mapInArrow(judge, schema)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(fold("doc_id") == 1, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


SQL = None  # no SQL engine compresses with a dictionary; tests/llm measures accuracy on held out rows
