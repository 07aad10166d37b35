"""Detected boxes: filters, zones and counts.

Zones are a short fixed list, so they are unrolled into column expressions. No join is needed,
counts combine map-side, and a frame with very many boxes costs no more than its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialume.config import (
    BEST_ZONE_MIN_OVERLAP, COUNT_MIN_OVERLAP, MASK_POLYGON, MIN_CONFIDENCE, VEHICLE_CLASSES, ZONES, Zone,
)
from vialume.functions.geometry import center, center_in, in_polygon, overlap_ratio, rect, zone_rect


def vehicles_only(boxes: DataFrame, classes: Sequence[int] = tuple(VEHICLE_CLASSES)) -> DataFrame:
    return boxes.filter(F.col("cls").isin(*classes))


def min_conf(boxes: DataFrame, threshold: float = MIN_CONFIDENCE) -> DataFrame:
    return boxes.filter(F.col("conf") >= threshold)


def in_mask(boxes: DataFrame, polygon: Sequence[tuple[int, int]] = MASK_POLYGON) -> DataFrame:
    """Boxes whose centre is inside the road polygon."""
    return boxes.filter(in_polygon(*center(rect()), polygon))


def _hits(zones: Sequence[Zone], letterbox: Column | None) -> list[tuple[Zone, Column]]:
    return [(z, center_in(rect(), zone_rect(z, letterbox))) for z in zones]


def boxes_in_zones(boxes: DataFrame, zones: Sequence[Zone] = ZONES, letterbox: Column | None = None) -> DataFrame:
    """One row per box and zone that holds the box's centre; a box may be in several."""
    names = F.array(*[F.when(hit, z.name) for z, hit in _hits(zones, letterbox)])
    return boxes.withColumn("zone", F.explode(F.array_compact(names)))


def _tallies(zones: Sequence[Zone], letterbox: Column | None) -> list[Column]:
    return [F.count_if(hit).alias(z.name) for z, hit in _hits(zones, letterbox)]


def count_in_zones(boxes: DataFrame, zones: Sequence[Zone] = ZONES, frame: str = "frame_id") -> DataFrame:
    """Boxes per frame and zone, by centre; zones without boxes count 0."""
    wide = boxes.groupBy(frame).agg(*_tallies(zones, None))
    pairs = F.array(*[F.struct(F.lit(z.name).alias("zone"), F.col(z.name).alias("n")) for z in zones])
    return wide.select(frame, F.inline(pairs))


def zone_counts(boxes: DataFrame, frames: DataFrame | None = None, zones: Sequence[Zone] = ZONES,
                frame: str = "frame_id", letterbox: Column | None = None) -> DataFrame:
    """Zone counts of each frame as a map, and their sum as ``vehicle_count``.

    With ``frames``, frames without boxes appear with zeros.
    """
    wide = boxes.groupBy(frame).agg(*_tallies(zones, letterbox))
    if frames is not None:
        wide = frames.select(frame).join(wide, frame, "left").na.fill(0, [z.name for z in zones])
    total = sum((F.col(z.name) for z in zones[1:]), F.col(zones[0].name))
    counts = F.create_map(*[x for z in zones for x in (F.lit(z.name), F.col(z.name).cast("int"))])
    return wide.select(frame, counts.alias("roi_counts"), total.cast("int").alias("vehicle_count"))


def with_best_zone(boxes: DataFrame, zones: Sequence[Zone] = ZONES, threshold: float = BEST_ZONE_MIN_OVERLAP) -> DataFrame:
    """Add ``zone`` and ``overlap`` of the zone that each box overlaps most.

    Equal overlaps go to the zone that comes first. Below the threshold ``zone`` is null.
    """
    ratios = {f"__r{z.ord}": overlap_ratio(rect(), zone_rect(z)) for z in zones}
    most = F.greatest(F.lit(0.0), *[F.col(r) for r in ratios])
    enough = (F.col("overlap") > 0) & (F.col("overlap") >= threshold)
    first, *others = sorted(zones)
    winner = F.when(F.col(f"__r{first.ord}") == F.col("overlap"), first.name)
    for z in others:
        winner = winner.when(F.col(f"__r{z.ord}") == F.col("overlap"), z.name)
    rated = boxes.withColumns(ratios).withColumn("overlap", most)
    return rated.select(*boxes.columns, F.when(enough, winner).alias("zone"), "overlap")


def assign_best_zone(boxes: DataFrame, zones: Sequence[Zone] = ZONES, threshold: float = BEST_ZONE_MIN_OVERLAP) -> DataFrame:
    """Boxes with the one zone they overlap most; boxes below the threshold are left out.

    Unfit boxes are dropped by a generator. A filter would move below the projections, and
    all overlaps would be worked out twice.
    """
    rated = with_best_zone(boxes, zones, threshold)
    return rated.select(*boxes.columns, F.inline(F.when(F.col("zone").isNotNull(), F.array(F.struct("zone", "overlap")))))


def overlapping(boxes: DataFrame, zones: Sequence[Zone] = ZONES, threshold: float = COUNT_MIN_OVERLAP) -> DataFrame:
    """Boxes that overlap at least one zone by the threshold, each once."""
    ratios = [overlap_ratio(rect(), zone_rect(z)) for z in zones]
    return boxes.filter(F.greatest(F.lit(0.0), *ratios) >= threshold)


def count_overlapping(boxes: DataFrame, zones: Sequence[Zone] = ZONES, threshold: float = COUNT_MIN_OVERLAP,
                      frame: str = "frame_id") -> DataFrame:
    """Boxes per frame that overlap any zone by the threshold; frames without such boxes count 0."""
    ratios = [overlap_ratio(rect(), zone_rect(z)) for z in zones]
    hit = F.greatest(F.lit(0.0), *ratios) >= threshold
    return boxes.groupBy(frame).agg(F.count_if(hit).alias("vehicle_count"))


def detection_report(boxes: DataFrame, zones: Sequence[Zone] = ZONES, frame: str = "frame_id") -> DataFrame:
    """Per frame: all boxes, vehicles, others, vehicles without a zone, counts by best zone, total."""
    vehicle = F.col("cls").isin(*VEHICLE_CLASSES)
    rated = with_best_zone(boxes, zones)
    placed = rated.select(frame, vehicle.alias("vehicle"), F.when(vehicle, F.col("zone")).alias("zone"))
    return placed.groupBy(frame).agg(
        F.count(F.lit(1)).alias("n_boxes"),
        F.count_if("vehicle").alias("n_vehicles"),
        F.count_if(~F.col("vehicle")).alias("n_others"),
        F.count_if(F.col("vehicle") & F.col("zone").isNull()).alias("n_outside"),
        *[F.count_if(F.col("zone") == z.name).alias(z.name) for z in zones],
        F.count("zone").alias("total"),
    )


def ignored_classes(boxes: DataFrame) -> DataFrame:
    """Boxes per class that is not a vehicle, most frequent first."""
    others = boxes.filter(~F.col("cls").isin(*VEHICLE_CLASSES))
    return others.groupBy("cls").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "cls")


def mean_vehicles(report: DataFrame) -> DataFrame:
    """One row: mean number of counted vehicles over the frames, 0 when there are none."""
    return report.agg((F.coalesce(F.sum("total"), F.lit(0)) / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("mean_vehicles"))


def first_images(frames: DataFrame, n: int = 10, name: str = "filename") -> DataFrame:
    """The first ``n`` frames by name."""
    return frames.orderBy(name).limit(n)
