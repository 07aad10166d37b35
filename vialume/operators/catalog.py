"""Label catalogue: joins of labels, counts, metadata and frames, and relabelling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialume.config import FEATURES, FLUIDO
from vialume.functions.calendar import is_peak_hour
from vialume.functions.parsing import safe_int, stem
from vialume.functions.states import congestion_score

KEY = ["fecha", "filename"]
META = ["weekday", "weekday_name", "hour", "minute", "is_rush_hour"]
SUSPICIOUS_FROM = 7


def for_day(df: DataFrame, fecha: str) -> DataFrame:
    """Rows of one day folder; prunes partitions when ``fecha`` is one."""
    return df.filter(F.col("fecha") == fecha)


def enrich_counts(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """Set ``vehicle_count`` from the counts of the same day and file, 0 where a file is missing.

    A day without any counts keeps what it had. The list of days is bounded by the calendar.
    """
    counted_days = counts.select("fecha").distinct().withColumn("__counted", F.lit(True))
    before = F.col("vehicle_count").cast("int") if "vehicle_count" in labels.columns else F.lit(None).cast("int")
    fresh = counts.select(*KEY, F.col("vehicle_count").alias("__count"))
    joined = (
        labels.withColumn("__before", before)
        .join(fresh, KEY, "left")
        .join(F.broadcast(counted_days), "fecha", "left")
    )
    value = F.when(F.col("__counted"), F.coalesce(F.col("__count"), F.lit(0))).otherwise(F.col("__before"))
    keep = [c for c in labels.columns if c != "vehicle_count"]
    return joined.select(*keep, value.cast("int").alias("vehicle_count"))


def merge_counts(counts: DataFrame) -> DataFrame:
    """One count per file name over all days; the latest day wins."""
    return counts.groupBy("filename").agg(F.max_by("vehicle_count", "fecha").alias("vehicle_count"))


def labels_with_frames(labels: DataFrame, frames: DataFrame) -> DataFrame:
    """Labels whose frame exists."""
    return labels.join(frames.select(*KEY), KEY, "left_semi")


def unlabelled_frames(frames: DataFrame, labels: DataFrame) -> DataFrame:
    """Frames that have no label yet."""
    return frames.join(labels.select(*KEY), KEY, "left_anti")


def frames_with_meta(frames: DataFrame, meta: DataFrame) -> DataFrame:
    """Frames with the metadata of the same stem; all fields null where there is none."""
    return (
        frames.withColumn("stem", stem("filename"))
        .join(meta.select("fecha", "stem", "timestamp", *META), ["fecha", "stem"], "left")
        .drop("stem")
    )


def label_rows(frames: DataFrame, meta: DataFrame, estado: Column | str = "estado") -> DataFrame:
    """Label rows of frames: time from the metadata or else the file stem, other gaps empty."""
    joined = frames_with_meta(frames, meta)

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)

    state = F.col(estado) if isinstance(estado, str) else estado
    return joined.select(
        "fecha",
        "filename",
        F.coalesce(F.col("timestamp").cast("string"), stem("filename")).alias("timestamp"),
        *[text(c) for c in META],
        state.alias("estado"),
    )


def suspicious_labels(labels: DataFrame, min_vehicles: int = SUSPICIOUS_FROM, fecha: str | None = None) -> DataFrame:
    """Labels that say free flow although many vehicles were counted.

    Days that lack the count column come with nulls and drop out.
    """
    rows = labels if fecha is None else for_day(labels, fecha)
    return rows.filter((F.col("estado") == FLUIDO) & (F.col("vehicle_count") >= min_vehicles))


def apply_relabels(labels: DataFrame, changes: DataFrame, order: str = "seq") -> DataFrame:
    """Labels with the listed new states; of several changes to a file the last one wins."""
    last = changes.groupBy(*KEY).agg(F.max_by("estado", order).alias("__new"))
    joined = labels.join(last, KEY, "left")
    state = F.coalesce(F.col("__new"), F.col("estado"))
    return joined.withColumn("estado", state).select(*labels.columns)


def build_catalog(labels: DataFrame, frames: DataFrame | None = None) -> DataFrame:
    """Training catalogue: clean numbers, hour features, only labels whose frame exists."""
    rows = labels if frames is None else labels_with_frames(labels, frames)
    hour = safe_int("hour")
    count = safe_int("vehicle_count") if "vehicle_count" in rows.columns else F.lit(0)
    return rows.select(
        "fecha",
        "filename",
        hour.alias("hour"),
        safe_int("weekday").alias("weekday"),
        safe_int("minute").alias("minute"),
        safe_int("is_rush_hour").alias("is_rush_hour"),
        count.alias("vehicle_count"),
        congestion_score(hour).alias("congestion_hour_score"),
        is_peak_hour(hour).alias("is_peak_hour"),
        "estado",
    )


def training_rows(catalogue: DataFrame, features: DataFrame, keys: Sequence[str] = ("fecha", "filename")) -> DataFrame:
    """Catalogue rows with the visual features of their frames; rows without features are left out.

    Gives the keys, all features in order, and the state. Features must be unique by key.
    """
    return catalogue.join(features, list(keys)).select(*keys, *FEATURES, "estado")


def union_days(days: Sequence[DataFrame]) -> DataFrame:
    """All day tables in one, whatever columns each has."""
    first, *others = days
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
