"""History, summary and top-k queries over detections and windows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vialume.config import COLAPSO, COLLAPSE_FROM, DENSE_FROM, DENSO, FLUIDO, STATES
from vialume.functions.calendar import local_time

DEFAULT_MINUTES = 60
SPARK_BARS = 20
MIN_BAR = 10


def as_day(day: dt.date | str) -> dt.datetime:
    day = dt.date.fromisoformat(day) if isinstance(day, str) else day
    return dt.datetime(day.year, day.month, day.day)


def same_type(df: DataFrame, ts: str, moment: dt.datetime) -> Column:
    """``moment`` (UTC wall clock) as a literal of the type of ``ts``, so that nothing wraps the
    column and the filter reaches the file scan."""
    text = moment.isoformat(sep=" ")
    kind = df.schema[ts].dataType.typeName()
    return F.lit(text).cast("timestamp_ntz") if kind == "timestamp_ntz" else F.lit(f"{text}+00:00").cast("timestamp")


def history_minutes(df: DataFrame, now: dt.datetime, minutes: int = DEFAULT_MINUTES, ts: str = "ts",
                    max_minutes: int | None = None) -> DataFrame:
    """Rows of the last ``minutes`` before ``now``, oldest first; ``max_minutes`` is the caller's bound, if any."""
    since = now - dt.timedelta(minutes=minutes if max_minutes is None else min(minutes, max_minutes))
    return df.filter(F.col(ts) > same_type(df, ts, since)).orderBy(ts)


def in_days(df: DataFrame, first: dt.date | str, last: dt.date | str, ts: str = "ts") -> DataFrame:
    """Rows from the start of ``first`` to the end of ``last``."""
    end = as_day(last) + dt.timedelta(days=1)
    return df.filter((F.col(ts) >= same_type(df, ts, as_day(first))) & (F.col(ts) < same_type(df, ts, end)))


def history_range(
    df: DataFrame,
    desde: dt.date | str,
    hasta: dt.date | str,
    limit: int | None = None,
    order: Sequence[str] = ("ts",),
) -> DataFrame:
    """The rows of a span of days in order; with ``limit`` only the oldest."""
    found = in_days(df, desde, hasta, order[0]).orderBy(*order)
    return found if limit is None else found.limit(limit)


def on_day(df: DataFrame, day: dt.date | str, ts: str = "ts") -> DataFrame:
    """Rows of one day."""
    return in_days(df, day, day, ts)


def day_stats(df: DataFrame, day: dt.date | str, ts: str = "ts") -> DataFrame:
    """One row for a day: count, mean, maximum and rows per state (null when a state is absent)."""

    def tally(state: str) -> Column:
        return F.sum(F.when(F.col("estado") == state, 1))

    return on_day(df, day, ts).agg(
        F.count(F.lit(1)).alias("total"),
        F.avg("vehicle_count").alias("avg_vehicles"),
        F.max("vehicle_count").alias("max_vehicles"),
        tally(COLAPSO).alias("colapsos"),
        tally(DENSO).alias("densos"),
        tally(FLUIDO).alias("fluidos"),
    )


def class_distribution(df: DataFrame, label: str = "estado") -> DataFrame:
    """Rows and share in percent of each label. The share is taken over the few label rows."""
    counted = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return counted.withColumn("share_pct", F.col("n") * 100.0 / F.greatest(total, F.lit(1))).orderBy(label)


def hourly_congestion(df: DataFrame, hour: str = "hour", state: str = "estado") -> DataFrame:
    """Share of dense and collapsed rows per hour."""
    busy = F.col(state).isin(DENSO, COLAPSO).cast("double")
    return df.groupBy(hour).agg(F.avg(busy).alias("congestion_score")).orderBy(hour)


def range_kpis(df: DataFrame) -> DataFrame:
    """One row: total, rows per state (0 when absent), mean to one decimal, maximum from 0 up."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("estado") == s).alias(s) for s in STATES],
        F.round(F.avg("vehicle_count"), 1).alias("avg"),
        F.greatest(F.max("vehicle_count"), F.lit(0)).alias("max"),
    )


def by_hour(df: DataFrame, ts: str = "ts", tz: str | None = None) -> DataFrame:
    """Rows per state, total, sum and mean for each hour of the day, in order."""
    hourly = df.groupBy(F.hour(local_time(ts, tz)).alias("h")).agg(
        *[F.count_if(F.col("estado") == s).alias(s) for s in STATES],
        F.count(F.lit(1)).alias("total"),
        F.sum("vehicle_count").alias("sum_v"),
    )
    return hourly.orderBy("h").select(
        F.format_string("%02dh", "h").alias("hour"),
        *STATES,
        "total",
        "sum_v",
        F.round(F.col("sum_v") / F.col("total"), 1).alias("avg"),
    )


def window_state_share(windows: DataFrame) -> DataFrame:
    """Whole percent of the window rows in each of the three states, half up; 0 when absent."""
    n = F.count(F.lit(1))
    share = {s: F.coalesce(F.round(F.try_divide(F.count_if(F.col("estado_ventana") == s), n) * 100).cast("int"), F.lit(0)) for s in STATES}
    row = windows.agg(*[c.alias(s) for s, c in share.items()])
    return row.select(F.explode(F.create_map(*[x for s in STATES for x in (F.lit(s), F.col(s))])).alias("estado", "pct"))


def enrich_summary(df: DataFrame, day: str = "fecha", errors: Column | None = None) -> DataFrame:
    """Rows, unreadable rows and mean count of each day."""
    failed = F.lit(False) if errors is None else errors
    return df.groupBy(day).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(failed).alias("n_errors"),
        (F.sum("vehicle_count") / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("avg_vehicles"),
    )


def distinct_days(df: DataFrame, day: str = "fecha") -> DataFrame:
    return df.select(day).distinct().orderBy(day)


def newest_rows(df: DataFrame, n: int, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest ``n`` rows of each key. The limit works before the shuffle, too."""
    latest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("__rank", F.row_number().over(latest)).filter(F.col("__rank") <= n).drop("__rank")


def recent_windows(
    windows: DataFrame,
    n: int = 12,
    minutes: int | None = None,
    now: dt.datetime | None = None,
    order: Sequence[str] = ("window_end", "camera_id"),
) -> DataFrame:
    """Windows of the last ``minutes`` if given and not 0, else the newest ``n``; oldest first."""
    if minutes:
        since = now - dt.timedelta(minutes=minutes)
        return windows.filter(F.col(order[0]) >= same_type(windows, order[0], since)).orderBy(*order)
    return windows.orderBy(*[F.desc(c) for c in order]).limit(n).orderBy(*order)


def latest_windows_table(windows: DataFrame, n: int = 10, order: Sequence[str] = ("window_end", "camera_id")) -> DataFrame:
    """The newest ``n`` windows, newest first."""
    return windows.orderBy(*[F.desc(c) for c in order]).limit(n)


def last_state(df: DataFrame, keys: Sequence[str] = ("camera_id",), order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """Newest stored state of each key; no row for a key without rows."""
    return df.groupBy(*keys).agg(F.max_by("estado", F.struct(*order)).alias("estado"))


def newest_snapshots(df: DataFrame, keys: Sequence[str] = ("camera_id",), order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """The newest row of each key as the struct ``s``, and its place in ``order`` as ``at``; for batches and streams."""
    fields = ["vehicle_count", "roi_counts", "estado", "confianza", "metodo", order[0]]
    present = [c for c in fields if c in df.columns]
    at = F.struct(*order)
    return df.groupBy(*keys).agg(F.max_by(F.struct(*present), at).alias("s"), F.max(at).alias("at"))


def status_rows(newest: DataFrame, cameras: DataFrame | None = None, keys: Sequence[str] = ("camera_id",)) -> DataFrame:
    """Status of each camera from its newest snapshot; cameras without one are not ready, in free flow."""
    present = newest.schema["s"].dataType.names
    if cameras is not None:
        newest = cameras.select(*keys).join(newest, list(keys), "left")
    ready = F.col("s").isNotNull()
    out = {c: F.col(f"s.{c}") for c in present}
    out["estado"] = F.coalesce(F.col("s.estado"), F.lit(FLUIDO))
    out["metodo"] = F.coalesce(out.get("metodo", F.lit(None)), F.lit("umbral"))
    out.setdefault("confianza", F.lit(None).cast("double"))
    out.setdefault("roi_counts", F.lit(None).cast("map<string,int>"))
    out["roi_counts"] = F.coalesce(out["roi_counts"], F.create_map().cast("map<string,int>"))
    return newest.select(*keys, *[c.alias(name) for name, c in out.items()], ready.alias("ready"))


def latest_status(
    df: DataFrame,
    cameras: DataFrame | None = None,
    keys: Sequence[str] = ("camera_id",),
    order: Sequence[str] = ("ts", "event_id"),
) -> DataFrame:
    """Newest snapshot of each camera.

    With ``cameras``, cameras without rows appear as not ready, in free flow. Columns that the
    detections lack (zone counts, method, confidence) come back null.
    """
    return status_rows(newest_snapshots(df, keys, order), cameras, keys)


def sparkline(
    df: DataFrame,
    n: int = SPARK_BARS,
    keys: Sequence[str] = ("camera_id",),
    order: Sequence[str] = ("ts", "event_id"),
) -> DataFrame:
    """Bar heights of the newest ``n`` rows, as a percentage of the key's all-time maximum."""
    peak = df.groupBy(*keys).agg(F.max(F.coalesce(F.col("vehicle_count"), F.lit(0))).alias("peak"))
    bars = newest_rows(df, n, keys, order).join(peak, list(keys))
    height = F.coalesce(F.col("vehicle_count"), F.lit(0)) / F.greatest(F.col("peak"), F.lit(1)) * 100
    return bars.select(
        *keys, *order, "vehicle_count", "estado", F.greatest(F.lit(float(MIN_BAR)), height).alias("height_pct")
    )


def adaptive_thresholds(df: DataFrame, keys: Sequence[str] = ("camera_id",), min_rows: int = 10) -> DataFrame:
    """Exact order statistics at 65 % and 85 % of the counts; fixed thresholds for few rows.

    The values are small whole numbers, so each key is first reduced to its histogram; the
    running totals then run over distinct values only.
    """
    histogram = (
        df.filter(F.col("vehicle_count").isNotNull())
        .groupBy(*keys, "vehicle_count").agg(F.count(F.lit(1)).alias("n"))
    )
    upto = Window.partitionBy(*keys).orderBy("vehicle_count")
    everything = Window.partitionBy(*keys)
    ranked = histogram.select(
        *keys, "vehicle_count", F.sum("n").over(upto).alias("reached"), F.sum("n").over(everything).alias("rows")
    )

    def at(percent: int, fixed: int) -> Column:
        place = F.floor(F.col("rows") * percent / 100)
        found = F.min(F.when(F.col("reached") > place, F.col("vehicle_count")))
        return F.when(F.max("rows") >= min_rows, found).otherwise(fixed)

    return ranked.groupBy(*keys).agg(
        F.max("rows").alias("n_rows"),
        at(65, DENSE_FROM).alias("umbral_denso"),
        at(85, COLLAPSE_FROM).alias("umbral_colapso"),
    )
