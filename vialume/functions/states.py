"""Traffic states: thresholds, scores, dominant state, trend and next state."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from vialume.config import (
    BAJANDO, COLAPSO, COLLAPSE_FROM, CONGESTION_BY_HOUR, CONGESTION_DEFAULT, DENSE_FROM, DENSO,
    ESTABLE, FALLING_FACTOR, FLUIDO, FORECAST_DENSE_ABOVE, RISING_FACTOR, STATES, SUBIENDO,
)


def threshold_state(count: Column, dense: int = DENSE_FROM, collapse: int = COLLAPSE_FROM) -> Column:
    """State of a vehicle count; a missing count is free flow."""
    return F.when(count >= collapse, COLAPSO).when(count >= dense, DENSO).otherwise(FLUIDO)


def threshold_class(count: Column, dense: int = DENSE_FROM, collapse: int = COLLAPSE_FROM) -> Column:
    """Classification struct of the rule: state, full confidence, method."""
    return F.struct(
        threshold_state(count, dense, collapse).alias("estado"),
        F.lit(1.0).alias("confianza"),
        F.lit("umbral").alias("metodo"),
    )


def congestion_score(hour: Column) -> Column:
    """Historic share of congested frames in an hour, with a neutral default."""
    table = F.create_map(*[F.lit(v) for v in chain.from_iterable(CONGESTION_BY_HOUR.items())])
    return F.coalesce(F.try_element_at(table, hour.cast("int")), F.lit(CONGESTION_DEFAULT))


def state_counts(state: Column) -> dict[str, Column]:
    """Aggregates ``n_<state>`` for the three states."""
    return {f"n_{s.lower()}": F.count_if(state == s) for s in STATES}


def dominant_state(counts: dict[str, Column]) -> Column:
    """State with the highest count; equal counts go to the more severe one.

    ``counts`` maps the names of :func:`state_counts` to columns that hold the counts.
    """
    ranked = [
        F.struct(counts[f"n_{s.lower()}"].alias("n"), F.lit(i).alias("severity"), F.lit(s).alias("state"))
        for i, s in enumerate(STATES)
    ]
    top = F.greatest(*ranked)
    return F.when(top["n"] > 0, top["state"])


def trend_label(n: Column, recent: Column, older: Column) -> Column:
    """Trend of a window with ``n`` samples from the means of its last and first three."""
    return (
        F.when(n < 3, ESTABLE)
        .when(recent > older * RISING_FACTOR, SUBIENDO)
        .when(recent < older * FALLING_FACTOR, BAJANDO)
        .otherwise(ESTABLE)
    )


def next_state(trend: Column, state: Column, recent_mean: Column) -> Column:
    """State expected in ten minutes: a trend moves the state by one step at most."""
    worse = (
        F.when((state == FLUIDO) & (recent_mean > FORECAST_DENSE_ABOVE), DENSO)
        .when(state == DENSO, COLAPSO)
        .otherwise(state)
    )
    better = F.when(state == COLAPSO, DENSO).when(state == DENSO, FLUIDO).otherwise(state)
    return F.when(trend == SUBIENDO, worse).when(trend == BAJANDO, better).otherwise(state)
