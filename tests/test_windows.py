import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vialume.functions.states import threshold_state
from vialume.operators import forecast, history, windows

T0 = dt.datetime(2024, 1, 1)


def detections(spark, rows):
    """Rows of (camera, second, count)."""
    data = [(c, T0 + dt.timedelta(seconds=s), i, v) for i, (c, s, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "camera_id bigint, ts timestamp, event_id bigint, vehicle_count int")
    return df.withColumn("estado", threshold_state(F.col("vehicle_count")))


def brute(rows, duration, slide):
    """Window rows from their definition."""
    out = {}
    indexed = [(c, s, i, v) for i, (c, s, v) in enumerate(rows)]
    for camera in {r[0] for r in rows}:
        for start in range(-duration, max(r[1] for r in rows) + 1, slide):
            start -= start % slide
            inside = sorted((r for r in indexed if r[0] == camera and start <= r[1] < start + duration), key=lambda r: (r[1], r[2]))
            if not inside:
                continue
            v = [r[3] for r in inside]
            trend = "ESTABLE"
            if len(v) >= 3:
                recent, older = sum(v[-3:]) / 3, sum(v[:3]) / 3
                trend = "SUBIENDO" if recent > older * 1.2 else "BAJANDO" if recent < older * 0.8 else "ESTABLE"
            labels = ["COLAPSO" if x >= 10 else "DENSO" if x >= 5 else "FLUIDO" for x in v]
            mode = max(("FLUIDO", "DENSO", "COLAPSO"), key=lambda s: (labels.count(s), ("FLUIDO", "DENSO", "COLAPSO").index(s)))
            out[camera, start] = (sum(v) / len(v), max(v), trend, mode, len(v))
    return out


@pytest.mark.parametrize("duration,slide", [(300, 30), (120, 120), (90, 60), (60, 25)])
def test_windows_against_their_definition(spark, duration, slide):
    """A hot camera, bursts in one second, and a slide that does not divide the window."""
    rng = random.Random(duration)
    rows = [
        (1 if rng.random() < 0.6 else 2, 100 if rng.random() < 0.3 else rng.randrange(1200), rng.randrange(15))
        for _ in range(300)
    ]
    got = {}
    for r in windows.sliding_windows(detections(spark, rows), duration, slide).collect():
        assert (r.window_end - r.window_start).total_seconds() == duration
        start = int((r.window_start - T0).total_seconds())
        got[r.camera_id, start] = (r.avg_vehicles, r.max_vehicles, r.tendencia, r.estado_ventana, r.n_samples)
    # Windows start at multiples of the slide since 1970; count seconds from such a multiple.
    offset = int(T0.replace(tzinfo=dt.timezone.utc).timestamp()) % slide
    moved = brute([(c, s + offset, v) for c, s, v in rows], duration, slide)
    assert got == {(c, s - offset): v for (c, s), v in moved.items()}


def test_small_windows_have_no_trend(spark):
    one = windows.sliding_windows(detections(spark, [(1, 0, 0), (1, 1, 50)]), 60, 60).collect()
    assert len(one) == 1 and one[0].tendencia == "ESTABLE" and one[0].n_samples == 2


def test_forecast_of_few_windows(spark):
    rows = [(1, T0 + dt.timedelta(minutes=i), float(a), "SUBIENDO", "FLUIDO") for i, a in enumerate([3, 3])]
    schema = "camera_id bigint, window_start timestamp, avg_vehicles double, tendencia string, estado_ventana string"
    df = spark.createDataFrame(rows, schema)
    assert forecast.forecast_state(df).first().prediccion_10min == "FLUIDO"
    assert forecast.forecast_state(df.limit(0)).count() == 0
    more = df.unionByName(spark.createDataFrame([(1, T0 + dt.timedelta(minutes=9), 9.0, "SUBIENDO", "FLUIDO")], schema))
    assert forecast.forecast_state(more).first().prediccion_10min == "DENSO"


def test_group_limit_is_pushed_below_the_shuffle(spark):
    panes = windows.pane_partials(detections(spark, [(1, 0, 1)]), 30, ["camera_id"], ["ts", "event_id"])
    plan = panes._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_day_stats_are_null_not_zero(spark):
    df = detections(spark, [(1, 0, 1), (1, 5, 2)])
    row = history.day_stats(df, "2024-01-01").first()
    assert (row.total, row.fluidos, row.densos, row.colapsos) == (2, 2, None, None)
    row = history.range_kpis(df).first()
    assert (row.total, row.FLUIDO, row.DENSO, row.COLAPSO, row["avg"], row["max"]) == (2, 2, 0, 0, 1.5, 2)
    empty = history.day_stats(df, "2023-01-01").first()
    assert (empty.total, empty.avg_vehicles, empty.max_vehicles) == (0, None, None)


def test_range_takes_both_days_whole(spark):
    day = 86400
    df = detections(spark, [(1, -1, 1), (1, 0, 2), (1, 2 * day - 1, 3), (1, 2 * day, 4)])
    kept = history.history_range(df, "2024-01-01", "2024-01-02")
    assert [r.vehicle_count for r in kept.collect()] == [2, 3]
    assert [r.vehicle_count for r in history.history_range(df, "2024-01-01", "2024-01-02", limit=1).collect()] == [2]


def test_history_minutes_is_strict_and_capped(spark):
    df = detections(spark, [(1, 0, 1), (1, 1, 2), (1, 86400, 3)])
    now = T0 + dt.timedelta(days=1)
    assert [r.vehicle_count for r in history.history_minutes(df, now, 9999, max_minutes=1440).collect()] == [2, 3]
    assert [r.vehicle_count for r in history.history_minutes(df, now, 9999).collect()] == [1, 2, 3]


def test_adaptive_thresholds_need_ten_rows(spark):
    nine = detections(spark, [(1, i, i) for i in range(9)])
    row = history.adaptive_thresholds(nine).first()
    assert (row.umbral_denso, row.umbral_colapso) == (5, 10)
    twenty = detections(spark, [(1, i, i) for i in range(20)])
    row = history.adaptive_thresholds(twenty).first()
    assert (row.umbral_denso, row.umbral_colapso) == (13, 17)


def test_sparkline_bars(spark):
    df = detections(spark, [(1, i, 100 if i == 0 else i) for i in range(30)])
    bars = history.sparkline(df).orderBy("ts").collect()
    assert len(bars) == 20 and bars[0].vehicle_count == 10
    assert bars[0].height_pct == 10.0 and bars[-1].height_pct == pytest.approx(29)


def test_status_of_a_silent_camera(spark):
    cameras = spark.createDataFrame([(1,), (2,)], "camera_id bigint")
    status = {r.camera_id: r for r in history.latest_status(detections(spark, [(1, 0, 12)]), cameras).collect()}
    assert status[1].estado == "COLAPSO" and status[1].ready
    assert status[2].estado == "FLUIDO" and not status[2].ready and status[2].roi_counts == {}


def test_time_filters_reach_the_scan(spark, tmp_path):
    from vialume.sources.tables import scan_detections, write_detections

    write_detections(detections(spark, [(1, i * 86400, i) for i in range(5)]), str(tmp_path / "t"))
    df = scan_detections(spark, str(tmp_path / "t"), ["ts", "estado"], "2024-01-02", "2024-01-03")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert "PartitionFilters: [isnotnull(fecha" in plan
    assert "ReadSchema: struct<ts:timestamp,estado:string>" in plan
    assert df.count() == 2
