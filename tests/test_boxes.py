import random

import pytest
from pyspark.sql import functions as F

from vialume.config import Zone
from vialume.operators import boxes as ops
from vialume.operators.nms import nms

SCHEMA = "frame_id bigint, box_id bigint, x1 int, y1 int, x2 int, y2 int, cls int, conf double"
SQUARES = (Zone(0, "left", 0, 0, 10, 10), Zone(1, "right", 10, 0, 20, 10), Zone(2, "wide", 0, 0, 20, 10))


def boxes(spark, rows):
    """Rows of (frame, x1, y1, x2, y2, class, confidence)."""
    return spark.createDataFrame([(r[0], i, *r[1:]) for i, r in enumerate(rows)], SCHEMA)


def plain_nms(rows, limit=0.45):
    """Survivors by a loop over all boxes in order of confidence."""
    kept = []
    for frame, box_id, x1, y1, x2, y2, cls, conf in sorted(rows, key=lambda r: (-r[7], r[1])):
        fine = True
        for f, _, a1, b1, a2, b2, c, _ in kept:
            w, h = min(x2, a2) - max(x1, a1), min(y2, b2) - max(y1, b1)
            if f == frame and c == cls and w > 0 and h > 0:
                shared = w * h
                below = max((x2 - x1) * (y2 - y1), 1) + max((a2 - a1) * (b2 - b1), 1) - shared
                fine = fine and shared / below <= limit
        if fine:
            kept.append((frame, box_id, x1, y1, x2, y2, cls, conf))
    return sorted(kept)


def test_filters(spark):
    df = boxes(spark, [(1, 0, 0, 1, 1, c, p) for c, p in [(2, 0.2), (3, 0.19), (0, 0.9), (7, 0.5)]])
    assert ops.vehicles_only(df).count() == 3
    assert sorted(r.conf for r in ops.min_conf(df).collect()) == [0.2, 0.5, 0.9]


def test_centres_on_edges_belong_to_both_zones(spark):
    df = boxes(spark, [(1, 8, 2, 12, 4, 2, 0.9), (1, 100, 100, 110, 110, 2, 0.9)])
    hits = sorted(r.zone for r in ops.boxes_in_zones(df, SQUARES).collect())
    assert hits == ["left", "right", "wide"]
    counts = {r.zone: r.n for r in ops.count_in_zones(df, SQUARES).collect()}
    assert counts == {"left": 1, "right": 1, "wide": 1}


def test_frames_without_boxes_count_zero(spark):
    df = boxes(spark, [(1, 2, 2, 4, 4, 2, 0.9)])
    frames = spark.createDataFrame([(1,), (2,)], "frame_id bigint")
    got = {r.frame_id: (r.roi_counts, r.vehicle_count) for r in ops.zone_counts(df, frames, SQUARES).collect()}
    assert got == {1: ({"left": 1, "right": 0, "wide": 1}, 2), 2: ({"left": 0, "right": 0, "wide": 0}, 0)}


def test_best_zone_ties_go_to_the_first(spark):
    df = boxes(spark, [
        (1, 5, 0, 15, 10, 2, 0.9),   # half left, half right, all wide
        (1, 2, 2, 4, 4, 2, 0.9),     # all left, all wide
        (1, 17, 5, 29, 15, 2, 0.9),  # 15 of 144
        (1, 50, 50, 60, 60, 2, 0.9),
        (1, 3, 3, 3, 3, 2, 0.9),     # no area
    ])
    got = {r.box_id: (r.zone, r.overlap) for r in ops.assign_best_zone(df, SQUARES).collect()}
    assert got == {0: ("wide", 1.0), 1: ("left", 1.0)}
    loose = {r.box_id: r.zone for r in ops.assign_best_zone(df, SQUARES, 0.0).collect()}
    assert loose == {0: "wide", 1: "left", 2: "right"}


def test_overlapping_counts_a_box_once(spark):
    df = boxes(spark, [(1, 5, 0, 15, 10, 2, 0.9), (1, 15, 5, 25, 15, 2, 0.9), (2, 90, 90, 95, 95, 2, 0.9)])
    got = {r.frame_id: r.vehicle_count for r in ops.count_overlapping(df, SQUARES, 0.5).collect()}
    assert got == {1: 1, 2: 0}
    assert ops.overlapping(df, SQUARES, 0.5).count() == 1


def test_report(spark):
    df = boxes(spark, [(1, 2, 2, 4, 4, 2, 0.9), (1, 50, 50, 60, 60, 3, 0.9), (1, 2, 2, 4, 4, 0, 0.9)])
    r = ops.detection_report(df, SQUARES).first()
    assert (r.n_boxes, r.n_vehicles, r.n_others, r.n_outside, r.left, r.right, r.total) == (3, 2, 1, 1, 1, 0, 1)
    assert ops.mean_vehicles(ops.detection_report(df, SQUARES)).first()[0] == 1.0
    assert ops.mean_vehicles(ops.detection_report(df.limit(0), SQUARES)).first()[0] == 0.0
    assert [tuple(r) for r in ops.ignored_classes(df).collect()] == [(0, 1)]


def test_suppression_edges(spark):
    rows = [
        (1, 0, 0, 10, 10, 2, 0.9), (1, 0, 0, 10, 10, 3, 0.8),  # same place, another class
        (2, 0, 0, 29, 10, 2, 0.9), (2, 11, 0, 40, 10, 2, 0.8),  # IoU exactly 0.45
        (3, 0, 0, 28, 10, 2, 0.9), (3, 10, 0, 38, 10, 2, 0.8),  # IoU above it
        (4, 0, 0, 10, 10, 2, 0.5), (4, 0, 0, 10, 10, 2, 0.5),  # equal confidence
        (5, 3, 3, 3, 3, 2, 0.5), (5, 3, 3, 3, 3, 2, 0.4),  # no area
    ]
    assert sorted(r.box_id for r in nms(boxes(spark, rows)).collect()) == [0, 1, 2, 3, 4, 6, 8, 9]


@pytest.mark.parametrize("seed", [1, 2])
def test_suppression_against_a_loop(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(300):
        x, y = rng.randrange(60), rng.randrange(40)
        rows.append((rng.randrange(4), i, x, y, x + rng.randrange(0, 30), y + rng.randrange(1, 30), rng.choice([2, 3]), rng.randrange(10) / 10))
    df = spark.createDataFrame(rows, SCHEMA)
    kept = nms(df)
    assert sorted(map(tuple, kept.collect())) == plain_nms(rows)
    assert sorted(map(tuple, nms(kept).collect())) == plain_nms(rows)  # nothing more to drop


def test_large_groups_are_suppressed_in_rounds(spark):
    """A frame far beyond one block, full of copies, gives what one long loop gives."""
    rng = random.Random(5)
    rows = []
    for i in range(900):
        frame = 1 if i % 10 else 2 + i % 3
        x, y = rng.randrange(80), rng.randrange(60)
        corners = (x, y, x + 20, y + 20) if i % 3 else (5, 5, 30, 30)
        if i % 50 == 0:
            corners = (7, 7, 7, 7)
        rows.append((frame, i, *corners, 2, rng.randrange(50) / 50))
    df = spark.createDataFrame(rows, SCHEMA)
    want = plain_nms(rows)
    assert sorted(map(tuple, nms(df, block=25).select(*df.columns).collect())) == want
    assert sorted(map(tuple, nms(df).select(*df.columns).collect())) == want


def test_large_groups_without_a_broadcast(spark, monkeypatch):
    from vialume.operators import nms as module

    monkeypatch.setattr(module, "BROADCAST_GROUPS", 0)
    monkeypatch.setattr(module, "SPREAD", 4)
    rng = random.Random(6)
    rows = [(i % 2, i, x := rng.randrange(80), y := rng.randrange(60), x + 20, y + 20, 2, rng.randrange(50) / 50) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, module.nms(df, block=30).select(*df.columns).collect())) == plain_nms(rows)


def test_centre_filter_and_mask_agree_with_zones(spark):
    df = boxes(spark, [(1, 300, 250, 320, 270, 2, 0.9), (1, 0, 0, 10, 10, 2, 0.9)])
    assert [r.box_id for r in ops.in_mask(df).collect()] == [0]
    assert ops.first_images(spark.createDataFrame([("b",), ("a",)], "filename string"), 1).first().filename == "a"
    assert df.filter(F.col("cls") == 2).count() == 2


@pytest.mark.parametrize("threshold", [0.45, 1.0])
def test_rounds_agree_with_one_fold_on_awkward_boxes(spark, threshold):
    wide = [(None, None, i, float(i % 3), 0.0, i % 3 + 10.0, 10.0, None if i % 4 == 0 else 0.9 - i % 2 / 10) for i in range(12)]
    tiny = [(1, "car", 100 + i, 0.1, 0.1, 0.6, 0.6, 0.5) for i in range(4)]
    copies = [(1, "bus", 200 + i, 0.0, 0.0, 50.0, 50.0, None) for i in range(4)]
    df = spark.createDataFrame([*wide, *tiny, *copies], "frame_id long, cls string, box_id long, x1 double, y1 double, x2 double, y2 double, conf double")
    one = sorted(map(tuple, nms(df, threshold).select(*df.columns).collect()), key=repr)
    rounds = sorted(map(tuple, nms(df, threshold, block=2).select(*df.columns).collect()), key=repr)
    assert one == rounds and one
