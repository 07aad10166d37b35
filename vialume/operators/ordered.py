"""Previous and next row of a key, without sorting a whole key in one task.

A plain ``lag`` over a camera puts all rows of that camera in one task, and one camera may hold a
third of the table. Here time is cut into slices of fixed width. A first window runs inside
(key, slice). Only the outermost rows of each slice need a look across its border: a second window
runs over those alone, a few per key and slice. In it the other rows stay in groups of their own
slices, so that one plan with one scan serves all rows. Keys may be null: null is a key like others.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from vialume.functions.calendar import epoch_us

SLICE = "__slice"
SLICE_SECONDS = 3600
_EDGES = "edges"


def with_slice(df: DataFrame, ts: str, seconds: int = SLICE_SECONDS) -> DataFrame:
    """Add the slice of each row; rows without a time share one."""
    number = F.floor(epoch_us(ts) / F.lit(seconds * 1_000_000)).cast("string")
    return df.withColumn(SLICE, F.coalesce(number, F.lit("none")))


def _across(keys: Sequence[str], edge: Column, sort: Sequence[Column]) -> WindowSpec:
    """The edges of all slices of a key in one group, the other rows in those of their slices."""
    return Window.partitionBy(*keys, F.when(edge, F.lit(_EDGES)).otherwise(F.col(SLICE))).orderBy(*sort)


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str = "previous",
    seconds: int = SLICE_SECONDS,
    only: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Add ``out``, a struct with field ``v``: the value of the row before, or null if none.

    ``order`` starts with the timestamp and should be unique within a key; equal rows come in any
    order. ``only`` makes a condition of the neighbour: rows that do not meet it are left out, most
    of them before the second window.
    """
    return _neighbour(df, keys, order, value, out, seconds, False, only)


def with_next(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str = "following",
    seconds: int = SLICE_SECONDS,
    only: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """As :func:`with_previous`, for the row after."""
    return _neighbour(df, keys, order, value, out, seconds, True, only)


def _neighbour(df, keys, order, value, out, seconds, forward, only) -> DataFrame:
    boxed = F.struct(F.col(value).alias("v"))
    sort = [F.desc(c) if forward else F.asc(c) for c in order]
    inside = Window.partitionBy(*keys, SLICE).orderBy(*sort)
    rows = with_slice(df, order[0], seconds).withColumns({
        out: F.lag(boxed).over(inside),
        "__first": F.row_number().over(inside) == 1,
        "__last": F.lead(F.lit(1)).over(inside).isNull(),
    })
    edge = F.col("__first") | F.col("__last")
    if only is not None:
        rows = rows.filter(edge | only(F.col(out)))
    # Of equal edges of one slice, its last row comes last.
    carried = F.lag(boxed).over(_across(keys, edge, [*sort, F.asc("__last")]))
    found = rows.withColumn(out, F.when(F.col("__first"), carried).otherwise(F.col(out))).select(*df.columns, out)
    return found if only is None else found.filter(only(F.col(out)))


def trailing_mean(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, n: int, out: str, seconds: int = SLICE_SECONDS
) -> DataFrame:
    """Add the mean of ``value`` over the last ``n`` rows, the current one included.

    The first and last ``n - 1`` rows of a slice are its edges: the rows before one of its first
    rows are edges of this slice or of those before, without a gap.
    """
    ahead = Window.partitionBy(*keys, SLICE).orderBy(*order)
    rows = with_slice(df, order[0], seconds).withColumns({
        out: F.avg(value).over(ahead.rowsBetween(1 - n, 0)),
        "__rank": F.row_number().over(ahead),
        "__end": F.lead(F.lit(1), n - 1).over(ahead).isNull(),
    })
    edge = (F.col("__rank") < n) | F.col("__end")
    carried = F.avg(value).over(_across(keys, edge, [*map(F.asc, order), F.asc("__rank")]).rowsBetween(1 - n, 0))
    return rows.withColumn(out, F.when(F.col("__rank") < n, carried).otherwise(F.col(out))).select(*df.columns, out)
