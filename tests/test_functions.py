import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vialume.config import CONGESTION_BY_HOUR, FEATURES, MASK_POLYGON, ZONES
from vialume.functions import calendar, geometry, parsing, states
from vialume.functions.geometry import Rect
from vialume.sources.tables import zones_df


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("text,want", [
    ("12", 12), ("12.9", 12), ("-3.7", -3), ("", 0), (None, 0), ("NaN", 0), ("inf", 0), ("-Infinity", 0),
    ("word", 0), ("True", 1), ("false", 0), (" 8 ", 8), ("99999999999", 0), ("1e2", 100),
])
def test_safe_int(spark, text, want):
    assert one(spark, parsing.safe_int(F.lit(text))) == want


def test_safe_int_default(spark):
    assert one(spark, parsing.safe_int(F.lit("x"), default=-1)) == -1


@pytest.mark.parametrize("count,want", [(None, "FLUIDO"), (0, "FLUIDO"), (4, "FLUIDO"), (5, "DENSO"), (9, "DENSO"), (10, "COLAPSO"), (99, "COLAPSO")])
def test_threshold_state(spark, count, want):
    assert one(spark, states.threshold_state(F.lit(count).cast("int"))) == want


def test_hours(spark):
    hours = spark.range(24).select(
        F.col("id").cast("int").alias("h"),
        calendar.is_rush_hour(F.col("id")).alias("rush"),
        calendar.is_peak_hour(F.col("id")).alias("peak"),
        states.congestion_score(F.col("id")).alias("score"),
    ).collect()
    assert {r.h for r in hours if r.rush} == {7, 8, 9, 13, 14, 15, 17, 18, 19}
    assert {r.h for r in hours if r.peak} == set(range(11, 17))
    assert all(r.score == CONGESTION_BY_HOUR.get(r.h, 0.15) for r in hours)
    assert one(spark, states.congestion_score(F.lit(None).cast("int"))) == 0.15


def test_calendar_in_a_time_zone(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-07-01 23:30:00' AS ts")
    row = calendar.with_calendar(df).first()
    assert (row.weekday, row.hour, row.minute, row.is_rush_hour) == (0, 23, 30, False)
    row = calendar.with_calendar(df, tz="Europe/Madrid").first()
    assert (row.weekday, row.hour) == (1, 1)


@pytest.mark.parametrize("f,d,c,want", [
    (2, 2, 0, "DENSO"), (1, 1, 1, "COLAPSO"), (3, 1, 1, "FLUIDO"), (0, 2, 2, "COLAPSO"), (0, 0, 0, None),
])
def test_dominant_state_ties_go_to_the_severe_one(spark, f, d, c, want):
    counts = {"n_fluido": F.lit(f), "n_denso": F.lit(d), "n_colapso": F.lit(c)}
    assert one(spark, states.dominant_state(counts)) == want


@pytest.mark.parametrize("n,recent,older,want", [
    (2, 9.0, 1.0, "ESTABLE"), (3, 6.0, 5.0, "ESTABLE"), (3, 6.1, 5.0, "SUBIENDO"), (3, 4.0, 5.0, "ESTABLE"),
    (3, 3.9, 5.0, "BAJANDO"), (3, 1.0, 0.0, "SUBIENDO"), (3, 0.0, 0.0, "ESTABLE"),
])
def test_trend(spark, n, recent, older, want):
    assert one(spark, states.trend_label(F.lit(n), F.lit(recent), F.lit(older))) == want


@pytest.mark.parametrize("trend,state,mean,want", [
    ("SUBIENDO", "FLUIDO", 3.0, "FLUIDO"), ("SUBIENDO", "FLUIDO", 3.1, "DENSO"), ("SUBIENDO", "DENSO", 0.0, "COLAPSO"),
    ("SUBIENDO", "COLAPSO", 9.0, "COLAPSO"), ("BAJANDO", "COLAPSO", 9.0, "DENSO"), ("BAJANDO", "DENSO", 9.0, "FLUIDO"),
    ("BAJANDO", "FLUIDO", 9.0, "FLUIDO"), ("ESTABLE", "DENSO", 9.0, "DENSO"),
])
def test_next_state(spark, trend, state, mean, want):
    assert one(spark, states.next_state(F.lit(trend), F.lit(state), F.lit(mean))) == want


@pytest.mark.parametrize("w,h,want", [
    (640, 480, (1.0, 640, 480, 0, 0)), (1280, 720, (0.5, 640, 360, 0, 60)), (480, 640, (0.75, 360, 480, 140, 0)),
])
def test_letterbox(spark, w, h, want):
    lb = one(spark, geometry.letterbox_params(F.lit(w), F.lit(h)))
    assert (lb.scale, lb.new_w, lb.new_h, lb.pad_x, lb.pad_y) == want


def test_adapted_zone_is_cut_at_the_frame(spark):
    lb = geometry.letterbox_params(F.lit(640), F.lit(480))
    row = spark.range(1).select(*geometry.adapt_zone(ZONES[0], lb)).first()
    assert tuple(row) == (413, 246, 639, 404)


def test_adapted_polygon_keeps_its_corners_at_full_size(spark):
    corners = one(spark, geometry.adapt_polygon(geometry.letterbox_params(F.lit(640), F.lit(480))))
    assert [tuple(c) for c in corners] == list(MASK_POLYGON)


def lit_rect(*v):
    return Rect(*(F.lit(x) for x in v))


def test_overlap_and_iou(spark):
    box = lit_rect(0, 0, 10, 10)
    assert one(spark, geometry.overlap_ratio(box, lit_rect(10, 0, 20, 10))) == 0  # touching
    assert one(spark, geometry.overlap_ratio(box, lit_rect(5, 0, 20, 10))) == 0.5
    assert one(spark, geometry.overlap_ratio(lit_rect(3, 3, 3, 3), lit_rect(0, 0, 9, 9))) == 0
    assert one(spark, geometry.iou(box, box)) == 1.0
    assert one(spark, geometry.iou(box, box, "offline")) == 100 / (100 + 1e-6)
    assert one(spark, geometry.iou(lit_rect(0, 0, 0, 0), lit_rect(0, 0, 0, 0), "offline")) == 0
    with pytest.raises(ValueError):
        geometry.iou(box, box, "other")


def test_center_on_an_edge_is_inside(spark):
    zone = lit_rect(10, 10, 20, 20)
    assert one(spark, geometry.center_in(lit_rect(5, 5, 15, 15), zone)) is True
    assert one(spark, geometry.center_in(lit_rect(5, 5, 14, 15), zone)) is False


def test_in_polygon_against_a_plain_loop(spark):
    rng = np.random.default_rng(3)
    points = [(float(x), float(y)) for x, y in rng.integers(-5, 1300, (400, 2)) / 2]
    points += [(x + 0.5, float(y)) for x, y in MASK_POLYGON]

    def inside(px, py):
        odd = False
        for (ax, ay), (bx, by) in zip(MASK_POLYGON, MASK_POLYGON[1:] + MASK_POLYGON[:1]):
            if min(ay, by) <= py < max(ay, by) and px < float(bx - ax) * (py - ay) / (by - ay) + ax:
                odd = not odd
        return odd

    df = spark.createDataFrame(points, "x double, y double")
    got = {(r.x, r.y): r.i for r in df.select("x", "y", geometry.in_polygon(F.col("x"), F.col("y")).alias("i")).collect()}
    assert got == {p: inside(*p) for p in points}
    assert 20 < sum(got.values()) < len(points)


def test_fixed_values(spark):
    assert len(FEATURES) == 22 and len(MASK_POLYGON) == 42
    assert [r.zone for r in zones_df(spark).orderBy("ord").collect()] == [z.name for z in ZONES]
    assert math.isclose(sum(CONGESTION_BY_HOUR.values()), 3.414)
