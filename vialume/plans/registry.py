"""Collects the queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Run = Callable[[SparkSession, str], DataFrame]


class Query(NamedTuple):
    run: Run
    sql: str | None
    operators: str


REGISTRY: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, which is how the SQL side shows them."""
    zoned = {f.name for f in df.schema if f.dataType.typeName() == "timestamp"}
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in zoned else F.col(c) for c in df.columns])


def query(operators: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function under its own name; ``operators`` lists the inventory rows it covers."""

    def add(run: Run) -> Run:
        def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return comparable(run(spark, sf_dir))

        REGISTRY[run.__name__] = Query(wrapped, sql, operators)
        return run

    return add
