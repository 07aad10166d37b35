"""Shards by rendezvous hashing, with DataFrame functions only.

Each record draws a number for every shard from its key and the shard's number, raised by the
shard's weight; the shard with the highest draw takes it. A further shard only takes records into
itself, a removed one only gives its own away. No state and no shuffle are needed for that; the
places inside the shards are numbered with sizes of parts (``gapless``).

Defined results: the key of a null id is the empty text, so such rows share one shard, and their
places are still dealt out in parts. Repeated rows share the shard and get places of their own.
A null text has size 1 and checksum 0. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vialume.llm.common import gapless, table, text_or_empty

QUERY = "op2_sharding"
SHARDS = 16


def draw(key: Column, shard: int, weight: float = 1.0) -> Column:
    """Logarithm of a uniform number from key and shard, over the weight: below 0, the highest wins."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11).cast("double")
    return F.log((bits + 0.5) / F.lit(float(1 << 53))) / F.lit(float(weight))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key; equal draws go to the smaller number. Shards of weight 0 or less take nothing."""
    draws = [F.struct(draw(key, s, w).alias("d"), F.lit(-s).alias("s")) for s, w in enumerate(weights) if w > 0]
    best = draws[0] if len(draws) == 1 else F.greatest(*draws)
    return (-best["s"]).cast("int")


def record_key(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def assign_shards(df: DataFrame, column: str, weights: Sequence[float], name: str = "shard") -> DataFrame:
    """``df`` with the shard of each row."""
    return df.withColumn(name, rendezvous(record_key(column), weights))


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text_or_empty()) + 1).cast("long").alias("size"),
        F.crc32(text_or_empty().cast("binary")).alias("text_crc32"))
    rows = assign_shards(rows, "doc_id", [1.0] * SHARDS)
    rows = assign_shards(rows, "doc_id", [1.0] * (SHARDS + 1), "grown_shard")
    rows = gapless(rows, ["shard"], ["doc_id", "text_crc32"], "slot")
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


SQL = None  # the checksum has no SQL form in the comparing engine; tests/llm compares with plain Python
