"""Start, end and length of collapses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vialume.config import COLAPSO, COLAPSO_FIN, COLAPSO_INICIO
from vialume.functions.calendar import epoch_us
from vialume.operators.ordered import SLICE_SECONDS, with_next, with_previous

_MINUTE_US = 60_000_000


def _collapse_changes(df, keys, order, seconds) -> DataFrame:
    """Rows where a collapse starts or ends, with ``starts`` telling which."""
    now = F.coalesce(F.col("estado") == COLAPSO, F.lit(False))

    def changed(before):
        return now != F.coalesce(before["v"] == COLAPSO, F.lit(False))

    seen = with_previous(df, keys, order, "estado", "__before", seconds, only=changed)
    return seen.withColumn("starts", now).drop("__before")


def collapse_starts(
    df: DataFrame,
    keys: Sequence[str] = ("camera_id",),
    order: Sequence[str] = ("ts", "event_id"),
    seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Rows in collapse whose previous row on the same camera is not, or does not exist.

    A row without a state is in no collapse; rows without a camera count as one camera.
    """
    return _collapse_changes(df, keys, order, seconds).filter("starts").select(*df.columns)


def collapse_episodes(
    df: DataFrame,
    keys: Sequence[str] = ("camera_id",),
    order: Sequence[str] = ("ts", "event_id"),
    seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Start, end and whole minutes of each collapse.

    It ends with the first later row in another state; while there is none, end and minutes are null.
    """
    changes = _collapse_changes(df.select(*keys, *order, "estado"), keys, order, seconds)
    paired = with_next(changes, keys, order, order[0], "__end", seconds).filter("starts")
    start, end = F.col(order[0]), F.col("__end.v")
    return paired.select(
        *keys,
        start.alias("inicio"),
        end.alias("fin"),
        F.floor((epoch_us(end) - epoch_us(start)) / F.lit(_MINUTE_US)).cast("int").alias("duracion_min"),
    )


def alert_rows(episodes: DataFrame, keys: Sequence[str] = ("camera_id",)) -> DataFrame:
    """Alert table of the episodes: one row per start, one per known end with the length."""
    start = F.struct(F.col("inicio").alias("ts"), F.lit(COLAPSO_INICIO).alias("tipo"), F.lit(None).cast("int").alias("duracion_min"))
    end = F.struct(F.col("fin").alias("ts"), F.lit(COLAPSO_FIN).alias("tipo"), F.col("duracion_min"))
    rows = episodes.select(*keys, F.explode(F.array(start, end)).alias("a")).filter(F.col("a.ts").isNotNull())
    return rows.select(*keys, "a.ts", "a.tipo", "a.duracion_min", F.lit(False).alias("notificado"))


def alert_lengths(alerts: DataFrame, keys: Sequence[str] = ("camera_id",), seconds: int = SLICE_SECONDS) -> DataFrame:
    """Fill ``duracion_min`` of the end rows: whole minutes since the alert row before, its start."""
    seen = with_previous(alerts, keys, ["ts", "tipo"], "ts", "__start", seconds)
    minutes = F.floor((epoch_us("ts") - epoch_us(F.col("__start.v"))) / F.lit(_MINUTE_US)).cast("int")
    return seen.withColumn("duracion_min", F.when(F.col("tipo") == COLAPSO_FIN, minutes)).drop("__start")
