"""Tolerant parsing of text fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INT_MAX = 2147483647


def safe_int(col: Column | str, default: int = 0) -> Column:
    """Whole part of a number written as text; anything else gives ``default``.

    Empty text, words, NaN, infinities and values beyond 32 bits count as "anything else".
    ``True`` and ``False`` in any case are read as 1 and 0.
    """
    text = F.trim((F.col(col) if isinstance(col, str) else col).cast("string"))
    number = text.try_cast("double")
    flag = F.when(F.lower(text) == "true", 1.0).when(F.lower(text) == "false", 0.0)
    value = F.coalesce(flag, number)
    usable = value.isNotNull() & ~F.isnan(value) & (F.abs(value) <= F.lit(float(_INT_MAX)))
    return F.when(usable, value).otherwise(F.lit(float(default))).cast("int")


def stem(filename: Column | str) -> Column:
    """File name without its ``.jpg`` ending."""
    return F.regexp_replace(filename, r"\.jpg$", "")
