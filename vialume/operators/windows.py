"""Sliding event-time windows over detections.

A row belongs to ``duration / slide`` windows. Instead of copying every row that often, rows are
first reduced to panes (the largest step that tiles both the window and the slide), and the small
pane rows are copied. Sums, maxima and state counts of a pane combine map-side. The trend needs
the first and last three samples of a window, so each pane keeps its own first and last three;
the limit is applied before the shuffle, so a pane with very many rows stays small.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vialume.config import SLIDE_SECONDS, WINDOW_SECONDS
from vialume.functions.calendar import epoch_us, from_epoch_us
from vialume.functions.states import dominant_state, state_counts, trend_label

_MICROS = 1_000_000
TREND_SAMPLES = 3
N_STATES = ("n_fluido", "n_denso", "n_colapso")


def pane_seconds(duration: int, slide: int) -> int:
    """Width of the panes that tile a window of ``duration`` moved by ``slide``."""
    return gcd(duration, slide)


def pane_start(ts: Column | str, seconds: int) -> Column:
    """Start of the epoch-aligned pane of a timestamp, in microseconds."""
    step = seconds * _MICROS
    micros = epoch_us(ts)
    return micros - F.pmod(micros, F.lit(step))


def window_starts(pane: Column, duration: int, slide: int) -> Column:
    """Starts, in microseconds, of all windows that contain a pane."""
    span, step, width = duration * _MICROS, slide * _MICROS, pane_seconds(duration, slide) * _MICROS
    newest = pane - F.pmod(pane, F.lit(step))
    oldest = newest - F.lit((-(-span // step) - 1) * step)
    starts = F.sequence(oldest, newest, F.lit(step).cast("long"))
    return F.filter(starts, lambda s: s + F.lit(span) >= pane + F.lit(width))


def pane_partials(
    df: DataFrame, seconds: int, keys: Sequence[str], order: Sequence[str], newest: Sequence[str] = ()
) -> DataFrame:
    """One row per key and pane: counts, sum, maximum and the outermost samples.

    ``order`` holds the timestamp and an integer that breaks ties. The columns of ``newest`` are
    kept from the last row of the pane, in struct ``newest``.
    """
    ts, tie = order
    slim = df.select(
        *keys,
        pane_start(ts, seconds).alias("pane"),
        epoch_us(ts).alias("us"),
        F.col(tie).cast("long").alias("tie"),
        "vehicle_count",
        "estado",
        *[F.struct(*newest).alias("row")] * bool(newest),
    )
    group = [*keys, "pane"]
    at = F.struct("us", "tie")
    totals = slim.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("vehicle_count").alias("total"),
        F.max("vehicle_count").alias("peak"),
        *[c.alias(name) for name, c in state_counts(F.col("estado")).items()],
        *[F.max_by("row", at).alias("newest"), F.max(at).alias("newest_at")] * bool(newest),
    )

    # A limit for each end; both are applied before the shuffle.
    sample = F.struct("us", "tie", "vehicle_count")
    ends = None
    for name, sort in (("first", F.asc), ("last", F.desc)):
        near = Window.partitionBy(*group).orderBy(sort("us"), sort("tie"))
        outer = slim.select(*group, "us", "tie", "vehicle_count").withColumn("rank", F.row_number().over(near)).filter(F.col("rank") <= TREND_SAMPLES)
        outer = outer.select(*group, F.array(sample).alias(name))
        ends = outer if ends is None else ends.unionByName(outer, allowMissingColumns=True)
    return merge_partials(totals.unionByName(ends, allowMissingColumns=True), keys)


def merge_partials(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add up partial rows of the same key and pane, of which there are a few each."""
    return parts.groupBy(*keys, "pane").agg(*merged_columns("newest" in parts.columns))


def sample_columns(first: Column, last: Column) -> list[Column]:
    """``first`` and ``last``: the outermost samples of two arrays."""
    return [
        F.slice(F.array_sort(first), 1, TREND_SAMPLES).alias("first"),
        F.slice(F.sort_array(last, asc=False), 1, TREND_SAMPLES).alias("last"),
    ]


def merged_columns(newest: bool = False) -> list[Column]:
    """Aggregates that add up partial rows."""
    return [
        *[F.sum(c).alias(c) for c in ("n", "total")],
        F.max("peak").alias("peak"),
        *[F.sum(name).alias(name) for name in N_STATES],
        *sample_columns(_samples("first"), _samples("last")),
        *[F.max_by("newest", "newest_at").alias("newest"), F.max("newest_at").alias("newest_at")] * newest,
    ]


def _samples(column: str) -> Column:
    return F.array_compact(F.flatten(F.collect_list(column)))


def trend_of(samples_first: Column, samples_last: Column, n: Column) -> Column:
    """Trend from arrays that contain the first and the last three samples of a window."""

    def mean(samples: Column) -> Column:
        total = F.aggregate(samples, F.lit(0).cast("long"), lambda acc, s: acc + s["vehicle_count"])
        return total / F.lit(float(TREND_SAMPLES))

    oldest = F.slice(F.array_sort(samples_first), 1, TREND_SAMPLES)
    newest = F.slice(F.sort_array(samples_last, asc=False), 1, TREND_SAMPLES)
    return trend_label(n, mean(newest), mean(oldest))


def window_columns() -> list[Column]:
    """The measures of a window row, from the sums over its panes."""
    state = dominant_state({name: F.col(name) for name in N_STATES})
    return [
        (F.col("total") / F.col("n_samples")).alias("avg_vehicles"),
        F.col("max_vehicles"),
        trend_of(F.col("first"), F.col("last"), F.col("n_samples")).alias("tendencia"),
        state.alias("estado_ventana"),
        state.alias("estado_predicho"),
        F.col("n_samples"),
    ]


def sliding_windows(
    df: DataFrame,
    duration: int = WINDOW_SECONDS,
    slide: int = SLIDE_SECONDS,
    keys: Sequence[str] = ("camera_id",),
    order: Sequence[str] = ("ts", "event_id"),
) -> DataFrame:
    """Window rows per key: mean, maximum, trend, dominant state and sample count.

    Windows are half-open, aligned to the epoch and partly filled at both ends of the data;
    empty windows do not appear. ``estado_predicho`` repeats the dominant state.
    """
    panes = pane_partials(df, pane_seconds(duration, slide), keys, order)
    return windows_of_panes(panes, duration, slide, keys)


def windows_of_panes(panes: DataFrame, duration: int, slide: int, keys: Sequence[str] = ("camera_id",)) -> DataFrame:
    """Window rows from the rows of :func:`pane_partials`; at most duration / pane rows meet."""
    extra = "newest" in panes.columns
    spread = panes.withColumn("start", F.explode(window_starts(F.col("pane"), duration, slide)))
    merged = spread.groupBy(*keys, "start").agg(
        F.sum("n").alias("n_samples"),
        F.sum("total").alias("total"),
        F.max("peak").alias("max_vehicles"),
        *[F.sum(name).alias(name) for name in N_STATES],
        _samples("first").alias("first"),
        _samples("last").alias("last"),
        *[F.max_by("newest", "newest_at").alias("newest")] * extra,
    )
    return merged.select(
        *keys,
        from_epoch_us(F.col("start")).alias("window_start"),
        from_epoch_us(F.col("start") + F.lit(duration * _MICROS)).alias("window_end"),
        *window_columns(),
        *["newest"] * extra,
    )


def window_stats(df: DataFrame, duration: int = WINDOW_SECONDS, slide: int = SLIDE_SECONDS,
                 keys: Sequence[str] = ("camera_id",), ts: str = "ts") -> DataFrame:
    """Mean, maximum and sample count per window; no trend, so no samples are kept."""
    pane = pane_start(ts, pane_seconds(duration, slide)).alias("pane")
    panes = df.select(*keys, pane, "vehicle_count").groupBy(*keys, "pane").agg(
        F.count(F.lit(1)).alias("n"), F.sum("vehicle_count").alias("total"), F.max("vehicle_count").alias("peak")
    )
    spread = panes.withColumn("start", F.explode(window_starts(F.col("pane"), duration, slide)))
    merged = spread.groupBy(*keys, "start").agg(
        F.sum("total").alias("total"), F.max("peak").alias("max_vehicles"), F.sum("n").alias("n_samples")
    )
    return merged.select(
        *keys,
        from_epoch_us(F.col("start")).alias("window_start"),
        (F.col("total") / F.col("n_samples")).alias("avg_vehicles"),
        "max_vehicles",
        "n_samples",
    )


def window_state(df: DataFrame, duration: int = WINDOW_SECONDS, slide: int = SLIDE_SECONDS,
                 keys: Sequence[str] = ("camera_id",), ts: str = "ts") -> DataFrame:
    """Dominant state per window with the counts behind it."""
    pane = pane_start(ts, pane_seconds(duration, slide)).alias("pane")
    panes = df.select(*keys, pane, "estado").groupBy(*keys, "pane").agg(
        *[c.alias(name) for name, c in state_counts(F.col("estado")).items()]
    )
    spread = panes.withColumn("start", F.explode(window_starts(F.col("pane"), duration, slide)))
    merged = spread.groupBy(*keys, "start").agg(*[F.sum(name).alias(name) for name in N_STATES])
    return merged.select(
        *keys,
        from_epoch_us(F.col("start")).alias("window_start"),
        *N_STATES,
        dominant_state({name: F.col(name) for name in N_STATES}).alias("estado_ventana"),
    )


def state_mode(df: DataFrame, keys: Sequence[str], state: str = "estado") -> DataFrame:
    """Most frequent state per key; equal counts go to the more severe state."""
    counts = state_counts(F.col(state))
    counted = df.groupBy(*keys).agg(*[c.alias(name) for name, c in counts.items()])
    return counted.withColumn("estado", dominant_state({name: F.col(name) for name in counts}))
