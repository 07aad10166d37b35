"""Quality rules with verdicts on hosts.

Counts of each text (numpy over Arrow batches, whole texts) give a base verdict. Failures are summed by
host with map-side sums, each host's rate of failures is drawn towards the corpus by a beta prior
that is estimated from all hosts (method of moments), and hosts whose drawn rate is above
``max_rate`` are rejected as a whole. The verdicts go back to the documents by a join on the host;
Spark broadcasts them only when their measured size is small, and splits a hot host otherwise.

Defined results: a null text is empty (no words, so it fails). A null host is a host of its own.
Repeated rows count each time. An empty table gives an empty table. Other columns pass through ``host_rules``
unread, whatever their names, but for those named like a result, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vialume.llm.common import keep_only, stored, table
from vialume.llm.textkernel import Words, buffers, chunks, run_hashes, windows

QUERY = "op4_quality_rules"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between neighbouring offsets."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeats(group: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of a (group, key) that occurs more than once: all of them, and all but the first of each."""
    order = np.lexsort((key, group))
    g, k = group[order], key[order]
    same = (g[1:] == g[:-1]) & (k[1:] == k[:-1])
    later = np.concatenate(([False], same))[:len(order)]
    return order[later | np.concatenate((same, [False]))[:len(order)]], order[later]


def text_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The five counts of each text."""
    data, offsets = buffers(texts)
    out = {c: np.zeros(len(texts), dtype=np.int64) for c in COUNTS}
    for i, j in chunks(offsets):
        part, off = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        words = Words(part, off)
        out["n_words"][i:j] = np.diff(words.first)
        out["word_chars"][i:j] = _sums(~words.space & ((part & 0xC0) != 0x80), off)
        out["n_symbols"][i:j] = _sums(_SYMBOL[part], off)
        ends = np.union1d(np.flatnonzero(part == 10), off[1:])  # a line ends at a line feed or with its text
        starts = np.concatenate(([0], ends[:-1] + (part[np.minimum(ends[:-1], len(part) - 1)] == 10) if len(part) else ends[:-1]))
        full = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
        starts, ends = starts[full], ends[full]
        of = np.searchsorted(off, starts, side="right") - 1
        _, later = _repeats(of, run_hashes(part, starts, ends))
        out["n_dup_lines"][i:j] = np.bincount(of[later], minlength=j - i)
        of_word = np.repeat(np.arange(j - i), np.diff(words.first))
        grams = windows(words.hashes())
        inside = np.flatnonzero(of_word[4:] == of_word[:len(grams)]) if len(grams) else np.zeros(0, np.int64)
        again, _ = _repeats(of_word[inside], grams[inside])
        edge = np.zeros(len(of_word) + 1, dtype=np.int64)
        np.add.at(edge, inside[again], 1)
        np.add.at(edge, inside[again] + 5, -1)
        covered = np.cumsum(edge[:-1]) > 0
        out["n_repeat_words"][i:j] = np.bincount(of_word[covered], minlength=j - i)
    return out


def count_texts(docs: DataFrame, keep: list[str], host: str) -> DataFrame:
    """For every row the columns ``keep`` as the struct ``row``, its ``host`` and the five counts of ``text``."""
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    slim = docs.select(row, F.col(host).alias("host"))
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in slim.schema), *(f"{c} bigint" for c in COUNTS)])
    within = keep.index("text") if "text" in keep else None  # then the text is sent once, inside its row
    if within is None:
        slim = docs.select(row, F.col(host).alias("host"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        for batch in batches:
            counts = text_counts(batch.column(2) if within is None else batch.column(0).field(within))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *(pa.array(counts[c]) for c in COUNTS)], names=["row", "host", *COUNTS])

    return slim.mapInArrow(count, schema)


def base_failed(min_words: int = 10, max_repeat: int = 20):
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))


def host_verdicts(rows: DataFrame, host: str, failed: str, max_rate: float = 0.5) -> DataFrame:
    """One row for each host: rows, failures, drawn rate and verdict.

    The prior has the corpus rate as its mean. Its weight follows from the spread of the hosts'
    rates beyond what their sizes explain, and lies between 1 and 1,000,000 rows.
    """
    hosts = rows.groupBy(F.col(host).alias("_host")).agg(
        F.count(F.lit(1)).alias("host_rows"), F.sum(F.col(failed).cast("long")).alias("host_failed"))
    rate = F.col("host_failed") / F.col("host_rows")
    prior = hosts.agg(
        F.try_divide(F.sum("host_failed"), F.sum("host_rows")).alias("_p"),
        F.var_pop(rate).alias("_var"), F.avg(F.lit(1.0) / F.col("host_rows")).alias("_inv"))
    noise = F.col("_p") * (1 - F.col("_p"))
    extra = F.greatest(F.col("_var") - noise * F.col("_inv"), F.lit(1e-12))
    prior = prior.select("_p", F.greatest(F.lit(1.0), F.least(F.lit(1e6), noise / extra - 1)).alias("_weight"))
    drawn = (F.col("host_failed") + F.col("_p") * F.col("_weight")) / (F.col("host_rows") + F.col("_weight"))
    return hosts.join(F.broadcast(prior)).select(  # the prior is one row
        "_host", "host_rows", "host_failed", drawn.alias("host_rate"), (drawn <= max_rate).alias("host_kept"))


def host_rules(docs: DataFrame, keep: list[str], host: str = "source", max_rate: float = 0.5) -> DataFrame:
    """Columns ``keep``, the counts, ``base_failed``, ``host_rate`` and ``kept`` of every document.

    Texts are counted once: the counts are stored for the verdicts and for the join. Columns of ``keep`` that are named like
    one of the results are replaced by it.
    """
    own = [*COUNTS, "base_failed", "host_rate", "kept"]
    keep = [c for c in keep if c not in own]
    rows = stored(count_texts(docs, keep, host).withColumn("base_failed", base_failed()), "counts")
    verdicts = host_verdicts(rows, "host", "base_failed", max_rate)
    return rows.join(verdicts, rows["host"].eqNullSafe(verdicts["_host"]), "left").select(
        *[F.col("row")[c].alias(c) for c in keep], *COUNTS, "base_failed", "host_rate", (~F.col("base_failed") & F.col("host_kept")).alias("kept"))


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = host_rules(table(spark, sf_dir, "documents"), ["doc_id"])
    return rows.select("doc_id", *COUNTS, "base_failed", "kept")


SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
pos AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1))) AS i FROM w),
gram AS (SELECT doc_id, i, ws[i:i + 4] AS g FROM pos),
again AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM gram),
cov AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM again, (SELECT unnest(range(5)) AS j) WHERE c > 1 GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d),
dup AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM lines WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
c AS (SELECT w.doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c),
h AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS x FROM b GROUP BY source),
p AS (SELECT sum(x) / sum(n) AS p, var_pop(x / n) AS v, avg(1.0 / n) AS inv FROM h),
q AS (SELECT p, greatest(1.0, least(1e6, p * (1 - p) / greatest(v - p * (1 - p) * inv, 1e-12) - 1)) AS s FROM p),
v AS (SELECT source, (x + p * s) / (n + s) <= 0.5 AS host_kept FROM h, q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND host_kept AS kept
FROM b JOIN v ON b.source IS NOT DISTINCT FROM v.source
"""
