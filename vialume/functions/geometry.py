"""Letterbox geometry, rectangles, overlap and point-in-polygon, as column arithmetic."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from vialume.config import MASK_POLYGON, TARGET_H, TARGET_W, Zone


class Rect(NamedTuple):
    """Four columns, or numbers, that bound a rectangle."""

    x1: Column
    y1: Column
    x2: Column
    y2: Column


def rect(source: Column | None = None) -> Rect:
    """The rectangle in columns x1, y1, x2, y2, or in the fields of a struct."""
    field = F.col if source is None else source.getField
    return Rect(*(field(name) for name in Rect._fields))


def zone_rect(zone: Zone, letterbox: Column | None = None) -> Rect:
    """A zone's rectangle, fitted to a letterboxed frame when one is given."""
    if letterbox is None:
        return Rect(*(F.lit(v) for v in (zone.x1, zone.y1, zone.x2, zone.y2)))
    return adapt_zone(zone, letterbox)


def letterbox_params(w: Column, h: Column, target_w: int = TARGET_W, target_h: int = TARGET_H) -> Column:
    """Struct (w, h, scale, new_w, new_h, pad_x, pad_y) of a frame fitted into the target."""
    scale = F.least(F.lit(float(target_w)) / w, F.lit(float(target_h)) / h)
    new_w, new_h = F.floor(w * scale).cast("int"), F.floor(h * scale).cast("int")
    return F.struct(
        w.cast("int").alias("w"),
        h.cast("int").alias("h"),
        scale.alias("scale"),
        new_w.alias("new_w"),
        new_h.alias("new_h"),
        F.floor((F.lit(target_w) - new_w) / 2).cast("int").alias("pad_x"),
        F.floor((F.lit(target_h) - new_h) / 2).cast("int").alias("pad_y"),
    )


def _axis(letterbox: Column, axis: str) -> tuple[Column, Column, Column, int]:
    """Stretch, scale, pad and target length of one axis."""
    side, target = ("w", TARGET_W) if axis == "x" else ("h", TARGET_H)
    return letterbox[side] / F.lit(float(target)), letterbox["scale"], letterbox[f"pad_{axis}"], target


def adapt_zone(zone: Zone, letterbox: Column) -> Rect:
    """Zone corners in a letterboxed frame, cut off at the frame's edges."""

    def fit(value: int, axis: str) -> Column:
        stretch, scale, pad, _ = _axis(letterbox, axis)
        return (F.lit(value) * stretch * scale + pad).cast("int")

    return Rect(
        F.greatest(F.lit(0), fit(zone.x1, "x")),
        F.greatest(F.lit(0), fit(zone.y1, "y")),
        F.least(F.lit(TARGET_W - 1), fit(zone.x2, "x")),
        F.least(F.lit(TARGET_H - 1), fit(zone.y2, "y")),
    )


def adapt_polygon(letterbox: Column, polygon: Sequence[tuple[int, int]] = MASK_POLYGON) -> Column:
    """Polygon corners in a letterboxed frame, in single precision, each clipped to the frame."""

    single = "float"

    def fit(value: Column, axis: str) -> Column:
        stretch, scale, pad, target = _axis(letterbox, axis)
        placed = value * stretch.cast(single) * scale.cast(single) + pad.cast(single)
        inside = F.least(F.greatest(placed, F.lit(0.0).cast(single)), F.lit(float(target - 1)).cast(single))
        return inside.cast("int")

    corners = F.array(*[
        F.struct(F.lit(float(x)).cast(single).alias("x"), F.lit(float(y)).cast(single).alias("y")) for x, y in polygon
    ])
    return F.transform(corners, lambda p: F.struct(fit(p["x"], "x").alias("x"), fit(p["y"], "y").alias("y")))


def _exact(value: Column) -> Column:
    """Whole pixels as doubles: exact, and cheaper than integers, which are checked for overflow."""
    return value.cast("double")


def area(box: Rect) -> Column:
    return (_exact(box.x2) - _exact(box.x1)) * (_exact(box.y2) - _exact(box.y1))


def intersection(a: Rect, b: Rect) -> Column:
    """Shared area of two rectangles; 0 when they only touch or lie apart."""
    width = _exact(F.least(a.x2, b.x2)) - _exact(F.greatest(a.x1, b.x1))
    height = _exact(F.least(a.y2, b.y2)) - _exact(F.greatest(a.y1, b.y1))
    return F.greatest(width, F.lit(0.0)) * F.greatest(height, F.lit(0.0))


def overlap_ratio(box: Rect, zone: Rect) -> Column:
    """Part of the box that lies in the zone."""
    return intersection(box, zone) / F.greatest(area(box), F.lit(1.0))


def iou(a: Rect, b: Rect, variant: str = "live") -> Column:
    """Intersection over union.

    ``live`` lifts each area to at least 1; ``offline`` keeps areas and adds 1e-6 below the line.
    """
    shared = intersection(a, b)
    if variant == "live":
        return shared / (F.greatest(area(a), F.lit(1.0)) + F.greatest(area(b), F.lit(1.0)) - shared)
    if variant == "offline":
        return shared / (area(a) + area(b) - shared + F.lit(1e-6))
    raise ValueError(f"unknown variant: {variant}")


def center(box: Rect) -> tuple[Column, Column]:
    return (_exact(box.x1) + _exact(box.x2)) / 2, (_exact(box.y1) + _exact(box.y2)) / 2


def center_in(box: Rect, zone: Rect) -> Column:
    """True when the box's centre is in the zone, edges included."""
    cx, cy = center(box)
    return cx.between(zone.x1, zone.x2) & cy.between(zone.y1, zone.y2)


def in_polygon(x: Column, y: Column, polygon: Sequence[tuple[int, int]] = MASK_POLYGON) -> Column:
    """Even-odd test: an odd number of polygon edges lies to the right of the point.

    Corners are whole numbers, so all points of one pixel row cross the same edges. The edges are
    listed per row in a constant, and a point is tested against the few of its own row.
    """
    edges = [(a, b) for a, b in zip(polygon, [*polygon[1:], polygon[0]]) if a[1] != b[1]]
    top, bottom = min(y for _, y in polygon), max(y for _, y in polygon)

    def crossing(row: int) -> str:
        found = [
            f"named_struct('ax', {ax}D, 'ay', {ay}D, 'dx', {bx - ax}D, 'dy', {by - ay}D)"
            for (ax, ay), (bx, by) in edges if min(ay, by) <= row < max(ay, by)
        ]
        return f"array({', '.join(found)})"

    rows = F.expr(f"array({', '.join(crossing(row) for row in range(top, bottom))})")
    mine = F.get(rows, (F.floor(y) - F.lit(top)).cast("int"))
    to_the_right = F.aggregate(
        mine, F.lit(0), lambda n, e: n + (x < e["dx"] * (y - e["ay"]) / e["dy"] + e["ax"]).cast("int")
    )
    return F.coalesce(to_the_right % 2 == 1, F.lit(False))
