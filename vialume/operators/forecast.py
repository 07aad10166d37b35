"""Ten-minute forecast from window rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vialume.config import FORECAST_WINDOWS
from vialume.functions.states import next_state
from vialume.operators.ordered import trailing_mean

#: A day of window rows is a slice: some thousands per key.
SLICE_SECONDS_WINDOWS = 86_400


def rolling_mean(
    windows: DataFrame,
    n: int = FORECAST_WINDOWS,
    keys: Sequence[str] = ("camera_id",),
    order: str = "window_start",
    value: str = "avg_vehicles",
    out: str = "avg_reciente",
) -> DataFrame:
    """Add the mean of the last ``n`` window rows, the current one included.

    Each task sorts one time slice of a key, not its whole history.
    """
    return trailing_mean(windows, keys, [order], value, n, out, SLICE_SECONDS_WINDOWS)


def forecast_each(windows: DataFrame, keys: Sequence[str] = ("camera_id",), order: str = "window_start") -> DataFrame:
    """The forecast as it stood after each window."""
    ahead = next_state(F.col("tendencia"), F.col("estado_ventana"), F.col("avg_reciente"))
    return rolling_mean(windows, keys=keys, order=order).withColumn("prediccion_10min", ahead)


def forecast_state(windows: DataFrame, keys: Sequence[str] = ("camera_id",), order: str = "window_start") -> DataFrame:
    """The current forecast of each key, from its newest window and the mean of its last four.

    A key without windows gives no row.
    """
    newest = Window.partitionBy(*keys).orderBy(F.desc(order))
    last = windows.withColumn("rank", F.row_number().over(newest)).filter(F.col("rank") <= FORECAST_WINDOWS)
    summary = last.groupBy(*keys).agg(
        F.avg("avg_vehicles").alias("avg_reciente"),
        F.max_by(F.struct("tendencia", "estado_ventana"), order).alias("latest"),
    )
    trend, state = F.col("latest.tendencia"), F.col("latest.estado_ventana")
    return summary.select(
        *keys,
        trend.alias("tendencia"),
        state.alias("estado_ventana"),
        "avg_reciente",
        next_state(trend, state, F.col("avg_reciente")).alias("prediccion_10min"),
    )
