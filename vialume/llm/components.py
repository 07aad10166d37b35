"""Connected components of a table of links, on Spark alone.

Large-star and small-star rounds: every node's greater neighbours are linked to its smallest one, then every node and its smaller
neighbours to the smallest, until nothing changes. A round has two aggregates with map-side minima and
two joins with one row for each node on one side, so a node with very many links is split by adaptive
execution. Links never leave the executors; the driver compares a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vialume.llm.common import Round


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """Rows (node, root) for the nodes of ``links`` (a, b) that are not their own root: the smallest node they reach."""
    held = Round(label)
    pairs = held.store(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("w")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, F.col("u") == F.col("w")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        near = large.join(least, F.col("u") == F.col("w"))
        small = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select(F.col("w").alias("u"), F.col("m").alias("v")))
        pairs = held.store(small.distinct())
        now = tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
