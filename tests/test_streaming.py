import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from vialume.operators import alerts, dedup, ml, windows
from vialume.operators import history as status
from vialume.sources.events import EVENT_SCHEMA, parse_events, read_event_stream, split_invalid
from vialume.sources.tables import batch_sink, compact_batches, live_sink, scan_batches, scan_live, scan_windows, write_windows, zones_df
from vialume.streaming import jobs

T0 = dt.datetime(2024, 1, 1)


def message(i, second, count, camera=1):
    state = "COLAPSO" if count >= 10 else "DENSO" if count >= 5 else "FLUIDO"
    return {
        "camera_id": camera, "event_id": i, "timestamp": (T0 + dt.timedelta(seconds=second)).isoformat(),
        "vehicle_count": count, "estado": state, "hour": 0, "weekday": 0, "is_rush_hour": 0,
    }


class Feed:
    """A folder that grows by one file of messages per micro-batch."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.n = spark, folder, 0
        folder.mkdir()

    def add(self, messages):
        self.n += 1
        lines = "\n".join(m if isinstance(m, str) else json.dumps(m) for m in messages)
        path = self.folder / f"part-{self.n:03d}.txt"
        path.write_text(lines + "\n")
        os.utime(path, (1_700_000_000 + self.n,) * 2)  # files are taken in order of age

    def events(self):
        return split_invalid(read_event_stream(self.spark, str(self.folder), max_files=1))[0]


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "in")


@pytest.fixture
def history():
    rng = random.Random(9)
    return [message(i, 20 * i, rng.randrange(14), camera=1 + (rng.random() < 0.3)) for i in range(120)]


def batch(spark, messages):
    rows = [json.dumps(m) for m in messages]
    return parse_events(spark.createDataFrame([(r,) for r in rows], "value string"))


def run(df, sink, checkpoint):
    jobs.start_stream(df, sink, str(checkpoint), every=None).awaitTermination()


def test_windows_of_a_stream_equal_those_of_the_batch(spark, feed, history, tmp_path):
    """Several micro-batches and a restart; every closed window comes once."""
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    for part in (history[:40], history[40:80]):
        feed.add(part)
    jobs.stream_windows(feed.events(), out, cp, 300, 60).awaitTermination()
    feed.add(history[80:])
    jobs.stream_windows(feed.events(), out, cp, 300, 60).awaitTermination()

    got = scan_windows(spark, out)
    newest = max(m["timestamp"] for m in history)
    closed = F.lit(newest).cast("timestamp") - F.expr("INTERVAL 1 MINUTE")
    want = windows.sliding_windows(batch(spark, history), 300, 60).filter(F.col("window_end") <= closed)
    assert got.count() == got.select("camera_id", "window_start").distinct().count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.count() > 30


def test_native_statistics_equal_those_of_the_batch(spark, feed, history, tmp_path):
    out = str(tmp_path / "out")
    for part in (history[:60], history[60:]):
        feed.add(part)
    run(jobs.stream_window_stats(feed.events(), 300, 60), write_windows(out), tmp_path / "cp")
    got = scan_batches(spark, out)
    newest = max(m["timestamp"] for m in history)
    closed = F.lit(newest).cast("timestamp") - F.expr("INTERVAL 1 MINUTE")
    want = windows.sliding_windows(batch(spark, history), 300, 60).filter(F.col("window_end") <= closed)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))


def test_late_rows_are_left_out_and_counted(spark, feed, tmp_path):
    feed.add([message(0, 0, 1), message(1, 1000, 1)])
    feed.add([message(5, 1001, 1)])
    feed.add([message(2, 5, 99), message(3, 945, 7), message(4, 2000, 1)])  # second 5 is too late, 945 is not
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    query = jobs.stream_windows(feed.events(), out, cp, 60, 60)
    query.awaitTermination()
    rows = {int((r.window_start - T0).total_seconds()): r for r in scan_windows(spark, out).collect()}
    assert (rows[0].max_vehicles, rows[0].n_samples) == (1, 1)
    assert (rows[900].max_vehicles, rows[900].n_samples) == (7, 1)
    assert jobs.late_rows(query) == 1


def test_native_late_rows_are_left_out(spark, feed, tmp_path):
    feed.add([message(0, 0, 1), message(1, 1000, 1)])
    feed.add([message(2, 2000, 1)])
    feed.add([message(3, 5, 99), message(4, 3000, 1)])  # second 5 lies behind the watermark of the batch before
    out = str(tmp_path / "out")
    run(jobs.stream_window_stats(feed.events(), 60, 60), write_windows(out), tmp_path / "cp")
    rows = {r.window_start: r for r in scan_batches(spark, out).collect()}
    assert rows[T0].max_vehicles == 1 and rows[T0].n_samples == 1


def test_sink_replaces_a_repeated_batch(spark, tmp_path):
    sink, out = batch_sink(str(tmp_path / "t")), str(tmp_path / "t")
    sink(spark.range(3), 0)
    sink(spark.range(5), 1)
    sink(spark.range(5), 1)
    assert scan_batches(spark, out).count() == 8


def left(rows):
    """Messages whose span had ended one minute before the newest of them."""
    span = jobs.CHANGE_SECONDS
    at = {m["event_id"]: int((dt.datetime.fromisoformat(m["timestamp"]) - T0).total_seconds()) for m in rows}
    return {i for i, t in at.items() if t // span * span + span <= max(at.values()) - 60}


PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@pytest.fixture
def plain_session(spark):
    """The state store that a session has by itself."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    yield spark
    spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


@pytest.mark.parametrize("camera", [1, None])
def test_collapses_across_batches(plain_session, spark, feed, history, tmp_path, camera):
    """Several micro-batches, rows out of order within each, and a restart; null is a camera too."""
    history = [{**m, "camera_id": camera if m["camera_id"] == 1 else 2} for m in history]
    for i in range(0, 120, 30):
        feed.add(history[i + 2:i + 30] + history[i:i + 2])
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    events = feed.events().withColumn("camera_id", F.when(F.col("camera_id") != 0, F.col("camera_id")))
    jobs.stream_collapse_starts(events, out, cp).awaitTermination()
    known = batch(spark, history).withColumn("camera_id", F.when(F.col("camera_id") != 0, F.col("camera_id")))

    def starts(rows):
        return {r.event_id for r in alerts.collapse_starts(rows).collect()}

    got = [r.event_id for r in scan_batches(spark, out).collect()]
    want = starts(known) & left(history)
    assert sorted(got) == sorted(want) and len(want) > 5

    more = [message(200 + i, 4000 + i, 20, camera=c) for i, c in enumerate((camera or 0, 2, 7))] + [message(300, 9000, 0, camera=9)]
    feed.add(more)  # after a restart the last states are still known
    jobs.stream_collapse_starts(events, out, cp).awaitTermination()
    rows = batch(spark, history + more).withColumn("camera_id", F.when(F.col("camera_id") != 0, F.col("camera_id")))
    got = [r.event_id for r in scan_batches(spark, out).collect()]
    assert sorted(got) == sorted(starts(rows) & left(history + more))


def test_alert_rows_across_batches(plain_session, spark, feed, history, tmp_path):
    for i in range(0, 120, 40):
        feed.add(history[i:i + 40])
    feed.add([message(999, 9000, 0, camera=5)])
    out = str(tmp_path / "out")
    jobs.stream_alerts(feed.events(), out, str(tmp_path / "cp")).awaitTermination()
    got = alerts.alert_lengths(scan_batches(spark, out))
    want = alerts.alert_rows(alerts.collapse_episodes(batch(spark, history)))
    key = lambda r: (r.camera_id, r.ts, r.tipo, r.duracion_min, r.notificado)
    assert sorted(map(key, got.collect()), key=repr) == sorted(map(key, want.collect()), key=repr)


def test_unchanged_frames_across_batches(spark, feed, history, tmp_path):
    for i in range(0, 120, 40):
        feed.add(history[i:i + 40])

    def frames(df):
        return df.select("camera_id", "ts", F.col("event_id").alias("frame_id"), F.md5(F.col("estado").cast("binary")).alias("md5"))

    out = str(tmp_path / "out")
    jobs.stream_drop_unchanged(frames(feed.events()), out, str(tmp_path / "cp")).awaitTermination()
    got = sorted(r.frame_id for r in scan_batches(spark, out).collect())
    assert got == sorted(left(history) & {r.frame_id for r in dedup.drop_unchanged(frames(batch(spark, history))).collect()})


def test_a_session_keeps_its_state_store(plain_session, feed, history, tmp_path):
    before = plain_session.conf.get(PROVIDER)
    feed.add(history)
    jobs.stream_alerts(feed.events(), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert plain_session.conf.get(PROVIDER) == before


def test_a_path_may_serve_several_checkpoints(spark, feed, history, tmp_path):
    """Two queries, each with batches 0, 1, ...; nothing is lost and nothing comes twice after a restart."""
    out = str(tmp_path / "out")
    feed.add(history[:60])
    feed.add(history[60:])
    for _ in range(2):
        for name in ("a", "b"):
            jobs.stream_windows(feed.events(), out, str(tmp_path / name), 300, 60).awaitTermination()
    one = tmp_path / "one"
    jobs.stream_windows(feed.events(), str(one), str(tmp_path / "c"), 300, 60).awaitTermination()
    want = sorted(map(tuple, scan_windows(spark, str(one)).collect()))
    assert sorted(map(tuple, scan_windows(spark, out).collect())) == sorted(want * 2) and want


def test_what_a_failed_attempt_left_is_not_read(spark, tmp_path):
    out = str(tmp_path / "t")
    batch_sink(out, query="q")(spark.range(3), 0)
    spark.range(9).write.parquet(f"{out}/data/folder=q-1-lost")  # written, but never committed
    batch_sink(out, query="q")(spark.range(5), 1)
    batch_sink(out, query="q")(spark.range(7), 1)  # a new start repeats a batch that was committed
    assert scan_batches(spark, out).count() == 8


def test_windows_of_some_days_open_only_their_files(spark, tmp_path):
    out = str(tmp_path / "t")
    for n in range(4):
        ends = spark.range(48).select("id", (F.lit(T0) + F.make_dt_interval(F.lit(n), F.col("id").cast("int"))).alias("window_end"))
        write_windows(out)(ends, n)
    since = T0 + dt.timedelta(days=3, hours=5)
    found = scan_windows(spark, out, since)
    assert found.count() == sum(d * 24 + h >= 77 for d in range(4) for h in range(48))
    assert all(day in f for f in found.inputFiles() for day in ["stored_day=2024-01-0"])
    assert {f.split("stored_day=")[1][:10] for f in found.inputFiles()} == {"2024-01-04", "2024-01-05"}
    some = scan_batches(spark, out, dt.date(2024, 1, 2), dt.date(2024, 1, 2))
    assert {f.split("stored_day=")[1][:10] for f in some.inputFiles()} == {"2024-01-02"} and some.count() == 48


def test_small_files_of_old_days_are_put_together(spark, tmp_path):
    """Rows stay the same, once each; days that are still written to keep their files; a second run finds nothing to do."""
    out = str(tmp_path / "t")
    for n in range(5):
        ends = spark.range(60).select("id", (F.lit(T0) + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("window_end"))
        write_windows(out)(ends.withColumn("batch", F.lit(n)), n)
    before = sorted(map(tuple, scan_batches(spark, out).collect()))
    assert compact_batches(spark, out, dt.date(2024, 1, 2)) == 5
    assert sorted(map(tuple, scan_batches(spark, out).collect())) == before
    opened = scan_batches(spark, out).inputFiles()
    assert {f.split("stored_day=")[1][:10] for f in opened if "compacted" in f} == {"2024-01-01", "2024-01-02"}
    assert sum("2024-01-03" in f for f in opened) >= 5 and not any("2024-01-03" in f for f in opened if "compacted" in f)
    assert compact_batches(spark, out, dt.date(2024, 1, 2)) == 0
    write_windows(out)(scan_batches(spark, out, dt.date(2024, 1, 1), dt.date(2024, 1, 1)).where("batch = 0").withColumn("batch", F.lit(9)), 9)
    assert scan_batches(spark, out).count() == len(before) + 24
    assert compact_batches(spark, out, dt.date(2024, 1, 1)) == 2 and scan_batches(spark, out).count() == len(before) + 24


def test_late_rows_are_kept_apart(spark, feed, tmp_path):
    """Rows in time and late ones together are the input, also over a restart."""
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    feed.add([message(0, 0, 1), message(1, 1000, 1)])
    feed.add([message(2, 5, 9), message(3, 945, 7), message(4, 939, 7)])
    jobs.split_late(feed.events(), out, cp).awaitTermination()
    feed.add([message(5, 900, 1), message(6, 3000, 1)])
    feed.add([message(7, 2939, 1), message(8, 2940, 1)])
    jobs.split_late(feed.events(), out, cp).awaitTermination()
    assert {r.event_id: r.late for r in scan_batches(spark, out).collect()} == {
        0: False, 1: False, 2: True, 3: False, 4: True, 5: True, 6: False, 7: True, 8: False}


def test_arrival_stamps_survive_a_failure(spark, feed, tmp_path):
    """A batch that failed after it was stamped has the same stamps when it is run again."""
    cp, seen = str(tmp_path / "cp"), []
    feed.add([message(0, 0, 1), message(1, 50, 2)])

    def sink(batch, batch_id):
        seen.append(sorted(map(tuple, batch.select("event_id", "arrival").collect())))
        if len(seen) == 1:
            raise RuntimeError("lost")

    for _ in range(2):
        try:
            jobs.start_stream(jobs.with_arrival(feed.events()), sink, cp, None).awaitTermination()
        except Exception as e:  # noqa: BLE001 - the first start fails
            assert "lost" in str(e)
    assert len(seen) == 2 and seen[0] == seen[1] and len({t for _, t in seen[0]}) == 1


def test_a_feed_that_ends_closes_its_windows(spark, feed, history, tmp_path):
    out, cp, end = (str(tmp_path / n) for n in ("out", "cp", "end"))
    for part in (history[:50], history[50:]):
        feed.add(part)
    events = feed.events()
    jobs.stream_windows(jobs.with_end(events, end), out, cp, 300, 60).awaitTermination()
    assert scan_windows(spark, out).count() < windows.sliding_windows(batch(spark, history), 300, 60).count()
    jobs.end_feed(events, end)
    jobs.stream_windows(jobs.with_end(events, end), out, cp, 300, 60).awaitTermination()
    want = windows.sliding_windows(batch(spark, history), 300, 60)
    assert sorted(map(tuple, scan_windows(spark, out).collect())) == sorted(map(tuple, want.collect()))


def test_messages_of_a_single_camera(spark):
    """Six fields: the camera is the default, the number comes from the line."""
    line = {k: v for k, v in message(0, 3, 12).items() if k not in ("camera_id", "event_id")}
    df = spark.createDataFrame([(json.dumps(line),), (json.dumps(line),), (json.dumps({**line, "vehicle_count": 4}),)], "value string")
    ok, rejected = split_invalid(df, camera=8)
    rows = ok.collect()
    assert rejected.count() == 0 and {r.camera_id for r in rows} == {8}
    assert len({r.event_id for r in rows}) == 2 and all(r.event_id is not None for r in rows)


def test_bad_messages(spark):
    good = json.dumps(message(1, 1, 3))
    lines = [good, good[:30], "5", "", json.dumps({"timestamp": T0.isoformat(), "estado": "FLUIDO"}),
             json.dumps({**message(2, 2, 3), "vehicle_count": "many"}), json.dumps({**message(3, 3, 3), "timestamp": "soon"}),
             json.dumps({**message(4, 4, 3), "estado": "OTRO"})]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    ok, rejected = split_invalid(df)
    assert [r.event_id for r in ok.collect()] == [1]
    assert ok.columns == [c.split()[0] for c in EVENT_SCHEMA.split(", ")] + ["ts"]
    reasons = {r.value: r.reason for r in rejected.collect()}
    assert set(reasons) == set(lines[1:])
    assert reasons[lines[4]] == "missing vehicle_count" and reasons[lines[6]] == "missing ts"
    assert reasons[lines[1]] == "malformed" and reasons[lines[7]] == "unknown state"
    assert 1 in {r.event_id for r in parse_events(df).collect()}


def test_scored_windows_without_a_model(spark, feed, history, tmp_path):
    feed.add(history)
    out = str(tmp_path / "out")
    jobs.stream_windows(
        feed.events(), out, str(tmp_path / "cp"), 300, 300, last_sample=("vehicle_count", "hour"),
        finish=lambda rows: jobs.score_last(rows, None),
    ).awaitTermination()
    rows = scan_batches(spark, out).collect()
    assert rows and all(r.estado_predicho == r.estado_ventana for r in rows)
    newest = {}
    for m in history:
        start = int((dt.datetime.fromisoformat(m["timestamp"]) - T0).total_seconds()) // 300 * 300
        newest[m["camera_id"], start] = m["estado"]
    for r in rows:
        assert r.estado_modelo == newest[r.camera_id, int((r.window_start - T0).total_seconds())]


def test_classified_stream(spark, feed, history, tmp_path):
    feed.add(history)
    counts = feed.events().select("camera_id", "event_id", "ts", "vehicle_count")
    jobs.classify_stream(counts, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    rows = {r.event_id: r for r in scan_batches(spark, str(tmp_path / "out")).collect()}
    assert {i: r.estado for i, r in rows.items()} == {m["event_id"]: m["estado"] for m in history}
    assert zones_df(spark).count() == 3


def test_live_status_equals_the_batch_after_every_batch(spark, feed, history, tmp_path):
    out, cp = str(tmp_path / "live"), str(tmp_path / "cp")
    known = spark.createDataFrame([(c,) for c in (1, 2, 3)], "camera_id long")
    for i in range(0, 120, 40):
        feed.add(history[i + 5:i + 40] + history[i:i + 5])
        jobs.stream_latest_status(feed.events(), out, cp).awaitTermination()
        got = status.status_rows(scan_live(spark, out), known)
        want = status.latest_status(batch(spark, history[:i + 40]), known)
        assert sorted(map(tuple, got.select(*want.columns).drop("roi_counts").collect())) == sorted(map(tuple, want.drop("roi_counts").collect()))
    assert len(list((tmp_path / "live" / "state").iterdir())) <= 2


def test_live_table_applies_a_batch_once_and_keeps_newer_rows(spark, tmp_path):
    sink, out = live_sink(str(tmp_path / "t"), ["k"], query="q"), str(tmp_path / "t")

    def rows(*values):
        return spark.createDataFrame(list(values), "k long, s string, at long")

    sink(rows((1, "a", 5), (2, "b", 5)), 0)
    sink(rows((1, "old", 4), (None, "c", 1)), 1)
    live_sink(out, ["k"], query="q")(rows((1, "again", 9)), 1)  # a start that repeats batch 1
    sink(rows((2, "d", 6)), 2)
    assert sorted(map(tuple, scan_live(spark, out).collect()), key=repr) == [(1, "a", 5), (2, "d", 6), (None, "c", 1)]


def test_versions_of_a_model(spark, tmp_path):
    root = str(tmp_path / "models")
    assert ml.published_version(spark, root) == 0 and ml.load_version(root, 0) is None
    rows = spark.createDataFrame([(float(i % 2), "FLUIDO" if i % 2 else "DENSO", 1.0) for i in range(40)], "x double, estado string, sample_weight double")
    for n in (1, 2):
        assert ml.publish_model(ml.pipeline(["x"], trees=1, depth=1).fit(rows), root) == n
    assert ml.published_version(spark, root) == 2 and ml.load_version(root, 2).stages[1].getInputCols() == ["x"]


def test_changes_need_no_group_of_a_whole_camera(spark, feed, history, tmp_path):
    """The only state is that of the spans; rows that change are compared by camera and slice of time in each micro-batch."""
    feed.add(history)
    frames = feed.events().select("camera_id", "ts", F.col("event_id").alias("frame_id"), F.lit("x").alias("md5"))
    query = jobs.stream_drop_unchanged(frames, str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination()
    assert {op["operatorName"] for p in query.recentProgress for op in p["stateOperators"]} == {"stateStoreSave"}
    cameras = {m["camera_id"] for m in history}
    assert scan_batches(spark, str(tmp_path / "out")).count() == len(cameras) == scan_live(spark, str(tmp_path / "cp" / "last")).count()
