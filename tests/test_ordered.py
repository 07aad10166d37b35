import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vialume.operators import alerts, dedup, ordered

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "camera_id bigint, ts timestamp, event_id bigint, estado string"


def sequence(spark, states, camera=1, step=60):
    rows = [(camera, T0 + dt.timedelta(seconds=step * i), i, s) for i, s in enumerate(states)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("slices", [1, 3, 50, 5000])
def test_previous_and_next_do_not_depend_on_the_slices(spark, slices):
    rng = random.Random(slices)
    rows = []
    for i in range(400):
        camera = 1 if rng.random() < 0.7 else rng.choice([2, 3, None])  # one hot camera, and rows without one
        burst = rng.random() < 0.5  # half of the rows share one second
        ts = T0 + dt.timedelta(seconds=7 if burst else rng.randrange(1000))
        rows.append((camera, ts, i, rng.choice(["a", "b", None])))
    df = spark.createDataFrame(rows, SCHEMA)
    seconds = max(1, 1000 // slices)
    keys, order = ["camera_id"], ["ts", "event_id"]
    for forward, fn in ((False, ordered.with_previous), (True, ordered.with_next)):
        got = {r.event_id: r.n.v if r.n is not None else "none" for r in fn(df, keys, order, "estado", "n", seconds).collect()}
        want = {}
        for camera in {r[0] for r in rows}:
            line = sorted((r for r in rows if r[0] == camera), key=lambda r: (r[1], r[2]), reverse=forward)
            for before, now in zip([None, *line], line):
                want[now[2]] = "none" if before is None else before[3]
        assert got == want


def test_empty_table(spark):
    df = sequence(spark, ["x"]).limit(0)
    assert ordered.with_previous(df, ["camera_id"], ["ts", "event_id"], "estado").count() == 0
    assert alerts.collapse_episodes(df).count() == 0


@pytest.mark.parametrize("slices", [1, 4])
def test_collapse_starts_and_episodes(spark, slices):
    c, f = "COLAPSO", "FLUIDO"
    df = sequence(spark, [c, c, f, c, f, f, c, "DENSO", c, c])
    starts = [r.event_id for r in alerts.collapse_starts(df, seconds=600 // slices).orderBy("ts").collect()]
    assert starts == [0, 3, 6, 8]
    episodes = alerts.collapse_episodes(df, seconds=600 // slices).orderBy("inicio").collect()
    assert [e.duracion_min for e in episodes] == [2, 1, 1, None]
    assert episodes[-1].fin is None
    tipos = [r.tipo for r in alerts.alert_rows(alerts.collapse_episodes(df, seconds=600 // slices)).collect()]
    assert tipos.count("COLAPSO_INICIO") == 4 and tipos.count("COLAPSO_FIN") == 3


def test_unchanged_frames_are_dropped_only_when_consecutive(spark):
    rows = [(1, T0 + dt.timedelta(seconds=i), i, h) for i, h in enumerate("ABAABBA")]
    df = spark.createDataFrame(rows, "camera_id bigint, ts timestamp, frame_id bigint, md5 string")
    kept = sorted(r.frame_id for r in dedup.drop_unchanged(df).collect())
    assert kept == [0, 1, 2, 4, 6]


def test_copies_of_one_content(spark):
    """One content makes up most rows; every copy learns the first name."""
    rows = [("d1", f"f{i:04d}", "hot" if i % 10 else f"h{i}") for i in range(500)] + [("d2", "f0001", "hot")]
    df = spark.createDataFrame(rows, "fecha string, filename string, md5 string")
    marked = dedup.dedup_content(df, salts=8)
    assert marked.count() == 501
    hot = marked.filter("md5 = 'hot' and fecha = 'd1'")
    assert [r[0] for r in hot.select("kept_name").distinct().collect()] == ["f0001"]
    assert marked.filter("not is_duplicate").count() == df.select("fecha", "md5").distinct().count()
    assert dedup.unique_frames(df).count() == 52
    report = {r.fecha: (r.n_unique, r.n_duplicates) for r in dedup.dedup_report(df).collect()}
    assert report == {"d1": (51, 449), "d2": (1, 0)}


def test_frames_without_a_hash_are_no_copies(spark):
    df = spark.createDataFrame([("d", "a", None), ("d", "b", None)], "fecha string, filename string, md5 string")
    assert [(r.kept_name, r.is_duplicate) for r in dedup.dedup_content(df).orderBy("filename").collect()] == [("a", False), ("b", False)]


@pytest.mark.parametrize("seconds", [1, 7, 40, 100_000])
def test_trailing_mean_does_not_depend_on_the_slices(spark, seconds):
    rng = random.Random(seconds)
    rows = [(c, T0 + dt.timedelta(seconds=t), float(rng.randrange(99))) for c in (1, None) for t in sorted(rng.sample(range(900), 150))]
    df = spark.createDataFrame(rows, "camera_id bigint, at timestamp, x double")
    got = {(r.camera_id, r.at): r.m for r in ordered.trailing_mean(df, ["camera_id"], ["at"], "x", 4, "m", seconds).collect()}
    for camera in (1, None):
        line = [r for r in rows if r[0] == camera]
        for i, (_, at, _) in enumerate(line):
            near = [r[2] for r in line[max(0, i - 3):i + 1]]
            assert got[camera, at] == pytest.approx(sum(near) / len(near))


def test_rows_without_a_camera_are_one_camera(spark):
    df = sequence(spark, ["COLAPSO"] * 200, camera=None)
    assert alerts.collapse_starts(df).count() == 1


def test_episodes_read_the_table_once(spark, tmp_path):
    sequence(spark, ["COLAPSO", "FLUIDO"]).write.parquet(str(tmp_path / "t"))
    plan = alerts.collapse_episodes(spark.read.parquet(str(tmp_path / "t")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
