"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vialume.session import remove_path, scratch_path

#: Words are runs of characters other than these.
SPACE = r"\x20\x09-\x0D"

#: What operators remember in this Python worker beyond a task.
_caches: list[dict] = []


def worker_cache() -> dict:
    """A new cache of a Python worker; ``keep_only`` empties it when the worker goes on to another operator."""
    _caches.append(made := {})
    return made


def keep_only(*own: dict) -> None:
    """Where an Arrow function begins: what other operators remember in this worker goes, and what the last task's batches took.

    Spark uses a worker again for whatever comes next, so all that would lie beside this operator's own memory.
    """
    for cache in _caches:
        if not any(cache is c for c in own):
            cache.clear()
    pa.default_memory_pool().release_unused()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it again: the lineage ends here."""
    return Round(label).store(df)


class Round:
    """The stored table of a loop: each one takes the place of the one before, which only it was made from."""

    def __init__(self, label: str) -> None:
        self.label, self.path = label, None

    def store(self, df: DataFrame) -> DataFrame:
        spark, before = df.sparkSession, self.path
        self.path = scratch_path(spark, self.label)
        df.write.parquet(self.path)
        if before:
            remove_path(spark, before)
        return spark.read.schema(df.schema).parquet(self.path)


def gapless(df: DataFrame, group: list[str], order: list[str], name: str, parts: int = 1024) -> DataFrame:
    """Number the rows of each group from 0 without gaps, in a column called ``name``.

    A group may hold any share of the rows. Equal rows are counted before the shuffle, and each
    group is dealt over ``parts`` parts by a hash of ``order``; only the sizes of the parts are
    summed in one place for each group. Rows that are equal in all columns get the numbers of
    one run. The columns of ``group`` must not be null.
    """
    columns = df.columns
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    counted = counted.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    key = [*group, "_part"]
    sizes = counted.groupBy(*key).agg(F.sum("_n").alias("_size"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*key, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*key).orderBy(*order, *[c for c in columns if c not in order])
    first = F.coalesce(F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = counted.withColumn("_first", first).join(starts, key)
    at = F.col("_start") + F.col("_first")
    return placed.select(*columns, F.explode(F.sequence(at, at + F.col("_n") - 1)).alias(name))


def smallest_hashes(df: DataFrame, key: list[str], n: int) -> DataFrame:
    """The ``n`` rows of smallest hash of ``key``, all if there are fewer: a sample that does not depend on partitions.

    Rows are counted first, and only those below a cut that some twice as many rows pass are sorted, so a task gets about
    2 * n rows, however many there are. The chance that fewer than ``n`` pass the cut is below one in 10**9.
    """
    total = df.count()
    share = 1.0 if total <= 2 * n + 200 else (2 * n + 200) / total
    low = F.xxhash64(*key) <= F.lit(min(2**63 - 1, int(-(2**63) + share * 2**64)))
    return df.where(low).orderBy(F.xxhash64(*key), *key).limit(n)


def text_or_empty(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
