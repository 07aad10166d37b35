"""Removal of repeated passages of three lines or more, with DataFrame functions only.

Lines with a word are numbered in each text and every three neighbours are hashed to 128 bits. Where a
window occurs more than once in the corpus, its first occurrence (by id, then hash of the text, then
position) stays; the lines that later occurrences cover, and the blank lines between them, go.
Overlapping windows merge, as covered lines are a set.

Only hashes and positions are shuffled to find repeats. Windows are reduced to their first occurrence
map-side, and the join that looks up later occurrences has one row for each window on one side, so a
window that a third of the corpus holds is split by adaptive execution.

Defined results: lines are compared without leading and trailing white space. Texts of fewer than three
lines with words stay whole, null and empty texts too. Rows of one id with the same text are one
document and get the same result; a null id comes after all others. Other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vialume.llm.common import table, text_or_empty

QUERY = "op1_line_dedup"
WINDOW = 3
_WORD = r"[^\x20\x09-\x0D]"


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", size: int = WINDOW) -> DataFrame:
    """Rows (rid, th, covered): for each text with repeats the sorted numbers of the lines to remove."""
    trimmed = F.transform(F.split(text_or_empty(), "\n", -1), lambda l: F.regexp_replace(l, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", ""))
    lines = F.filter(F.transform(trimmed, lambda l, i: F.struct(i.alias("at"), l.alias("l"))), lambda x: x["l"] != "")
    hashed = F.transform(lines, lambda x: F.struct(
        x["at"].alias("at"), F.xxhash64(x["l"]).alias("a"), F.xxhash64(F.lit(size), x["l"]).alias("b")))
    found = F.transform(F.sequence(F.lit(0), F.size("_h") - size), lambda i: F.struct(
        i.alias("pos"), F.get("_h", i)["at"].alias("line_from"), F.get("_h", i + size - 1)["at"].alias("line_to"),
        F.xxhash64(*[F.get("_h", i + k)["a"] for k in range(size)]).alias("h1"),
        F.xxhash64(*[F.get("_h", i + k)["b"] for k in range(size)]).alias("h2")))
    windows = docs.select(*row_key(doc_id), hashed.alias("_h")).where(F.size("_h") >= size).select("rid", "th", F.inline(found))
    firsts = windows.groupBy("h1", "h2").agg(
        F.min(F.struct("rid", "th", "pos")).alias("first"), F.max(F.struct("rid", "th", "pos")).alias("last")).where("first < last")
    later = windows.join(firsts.select("h1", "h2", "first"), ["h1", "h2"]).where(F.struct("rid", "th", "pos") > F.col("first"))
    return later.groupBy("rid", "th").agg(F.array_sort(F.array_distinct(F.flatten(
        F.collect_set(F.sequence("line_from", "line_to"))))).alias("covered"))


def row_key(doc_id: str):
    return [F.coalesce(F.col(doc_id).cast("long"), F.lit(2**63 - 1)).alias("rid"), F.xxhash64(text_or_empty()).alias("th")]


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with the text that is left, and the columns n_lines and n_removed."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *row_key(doc_id))
    joined = rows.join(repeated_lines(docs, doc_id), ["rid", "th"], "left")
    row = F.col("row")
    lines = F.split(text_or_empty(row["text"]), "\n", -1)
    total = F.when(text_or_empty(row["text"]) == "", 0).otherwise(F.size(lines))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("covered"))
    text = F.when(F.col("covered").isNull(), row["text"]).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))
    kept = [(text if c == "text" else row[c]).alias(c) for c in docs.columns if c not in ("n_lines", "n_removed")]
    return joined.select(*kept, total.cast("long").alias("n_lines"),
                         F.coalesce(F.size(F.col("covered")), F.lit(0)).cast("long").alias("n_removed"))


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


SQL = r"""
WITH d AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
a AS (SELECT doc_id, unnest(ls) AS l, unnest(range(len(ls))) AS pos FROM d),
t AS (SELECT doc_id, pos, regexp_replace(l, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS l FROM a),
w AS (SELECT doc_id, pos, l,
  lead(l) OVER o AS l2, lead(l, 2) OVER o AS l3, lead(pos, 2) OVER o AS upto
  FROM t WHERE l <> '' WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
r AS (SELECT *, row_number() OVER (PARTITION BY l, l2, l3 ORDER BY doc_id, pos) AS nth FROM w WHERE l3 IS NOT NULL),
c AS (SELECT DISTINCT doc_id, unnest(range(pos, upto + 1)) AS pos FROM r WHERE nth > 1),
k AS (SELECT a.doc_id, string_agg(l, chr(10) ORDER BY pos) AS text FROM a ANTI JOIN c USING (doc_id, pos) GROUP BY a.doc_id),
n AS (SELECT doc_id, count(*) AS n FROM c GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN coalesce(d.text, '') = '' THEN 0 ELSE CAST(len(ls) AS BIGINT) END AS n_lines,
  coalesce(n.n, 0) AS n_removed, CASE WHEN n.n IS NULL THEN d.text ELSE coalesce(k.text, '') END AS text
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)
"""
