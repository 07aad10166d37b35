"""Calendar parts and the two notions of a busy hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialume.config import PEAK_HOURS, RUSH_HOURS


def epoch_us(ts: Column | str) -> Column:
    """Microseconds since the epoch of a timestamp with or without a zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(ts.cast("timestamp"))


def from_epoch_us(micros: Column) -> Column:
    return F.timestamp_micros(micros)


def local_time(ts: Column | str, tz: str | None = None) -> Column:
    """The wall clock of ``tz`` for a UTC timestamp."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return ts if tz in (None, "UTC") else F.from_utc_timestamp(ts, tz)


def is_rush_hour(hour: Column) -> Column:
    first, *others = [hour.between(start, last) for start, last in RUSH_HOURS]
    for span in others:
        first = first | span
    return first


def is_peak_hour(hour: Column) -> Column:
    """1 in the historic peak, else 0."""
    return hour.between(*PEAK_HOURS).cast("int")


def with_calendar(df: DataFrame, ts: str = "ts", tz: str | None = None) -> DataFrame:
    """Add weekday (0 = Monday), hour, minute and the rush-hour flag of ``ts``."""
    clock = local_time(ts, tz)
    hour = F.hour(clock)
    return df.withColumns({
        "weekday": F.weekday(clock),
        "hour": hour,
        "minute": F.minute(clock),
        "is_rush_hour": is_rush_hour(hour),
    })
