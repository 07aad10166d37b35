"""A corpus pipeline of five stages over the operators of ``vialume.llm``.

Each stage takes the session, the documents that the stage before kept, and the folder of the tables, and
returns the documents it keeps; the last returns the packed pieces. Between stages the documents are written
as Parquet to the shared folder and read again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vialume.llm import jaccard_join, line_dedup, packing, quality_classifier, quality_rules
from vialume.llm.common import stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.5 or more."""
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality_classifier.score(docs.select(*COLUMNS), model, "_score")
    return scored.where("_score >= 0.5").select(*COLUMNS)


def host_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose source is not rejected as a whole."""
    return quality_rules.host_rules(docs.select(*COLUMNS), list(COLUMNS)).where("kept").select(*COLUMNS)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of three lines that stand earlier in the corpus; those left without a word go."""
    rows = line_dedup.dedup_lines(docs.select(*COLUMNS))
    bare = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return rows.where(~((F.col("n_removed") > 0) & bare)).withColumn("n_chars", F.when(
        F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id."""
    return jaccard_join.one_of_each(docs.select(*COLUMNS))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2,048 tokens with their sequence and place."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_classifier", good_quality), ("quality_rules", host_rules), ("line_dedup", without_repeated_lines),
    ("jaccard_join", one_of_each_group), ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


ORACLE_SQL = None  # compression and tokenizer have no SQL form; tests/llm compares the stages with plain Python
