"""Streaming queries: the tables are replayed as streams until nothing is left."""

from __future__ import annotations

from pyspark.sql import functions as F

from vialume.config import FEATURES, VISUAL_FEATURES
from vialume.operators import history, ml
from vialume.operators.alerts import alert_lengths
from vialume.plans.registry import query
from vialume.plans.standins import (
    CAMERA_FRAMES, DET, SCORE, WINDOW_COLUMNS, camera_frames, detections, feature_rows, raw_counts, stream_table, windows_sql,
)
from vialume.plans.traffic import EPISODES, LATEST, LONG, RECENT, STARTS, STATUS, STEP, known_cameras
from vialume.session import scratch_path
from vialume.sources.events import parse_events, read_event_stream, split_invalid
from vialume.sources.tables import batch_sink, scan_batches, scan_live, scan_windows, write_windows
from vialume.streaming import jobs

_CLOSED = "window_end <= (SELECT max(ts) - INTERVAL 1 MINUTE FROM det)"


def event_stream(spark, sf_dir):
    """``events`` as a stream of raw counts."""
    return raw_counts(stream_table(spark, sf_dir, "events"))


def _run(df, sink, root):
    jobs.start_stream(df, sink, f"{root}/checkpoint", every=None).awaitTermination()


def _windows(spark, sf_dir, duration, slide):
    root = scratch_path(spark, "windows")
    events = jobs.classify_events(event_stream(spark, sf_dir))
    jobs.stream_windows(events, f"{root}/table", f"{root}/checkpoint", duration, slide).awaitTermination()
    return scan_windows(spark, f"{root}/table")


@query("I1 I2 I3 I4 I5 I7 A8", f"WITH {DET}, {RECENT} SELECT {WINDOW_COLUMNS} FROM win WHERE {_CLOSED}")
def stream_windows(spark, sf_dir):
    return _windows(spark, sf_dir, LONG, STEP)


@query("I1 I2 I3 I4 I5 I7 A8", f"WITH {DET}, {windows_sql(300, 30)} SELECT {WINDOW_COLUMNS} FROM win WHERE {_CLOSED}")
def stream_windows_5min(spark, sf_dir):
    return _windows(spark, sf_dir, 300, 30)


@query("I1 I2 I3 I5 I7 I8 A8", f"""WITH {DET}, {RECENT} SELECT camera_id, window_start, window_end, avg_vehicles, max_vehicles, estado_ventana, n_samples
  FROM win WHERE {_CLOSED}""")
def stream_window_stats(spark, sf_dir):
    root = scratch_path(spark, "stats")
    closed = jobs.stream_window_stats(jobs.classify_events(event_stream(spark, sf_dir)), LONG, STEP)
    _run(closed, write_windows(f"{root}/table"), root)
    return scan_batches(spark, f"{root}/table")


@query("I11 A7", f"""WITH {DET} SELECT camera_id, event_id, ts, vehicle_count, weekday, hour, minute, is_rush_hour, {SCORE} AS congestion_hour_score,
  CAST(hour BETWEEN 11 AND 16 AS INTEGER) AS is_peak_hour, estado, 1.0::DOUBLE AS confianza, 'umbral' AS metodo FROM det""")
def stream_classified(spark, sf_dir):
    root = scratch_path(spark, "classified")
    jobs.classify_stream(event_stream(spark, sf_dir), f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return scan_batches(spark, f"{root}/table")


# Rows leave with their span, one minute after its end.
_SPAN = jobs.CHANGE_SECONDS * 1_000_000
_LEFT = f"make_timestamp(epoch_us(ts) - epoch_us(ts) % {_SPAN} + {_SPAN}) <= (SELECT max(ts) - INTERVAL 1 MINUTE FROM {{}})"


@query("I9", f"WITH {DET} SELECT * FROM ({STARTS}) WHERE {_LEFT.format('det')}")
def stream_collapse_starts(spark, sf_dir):
    root = scratch_path(spark, "collapses")
    events = jobs.classify_events(event_stream(spark, sf_dir))
    jobs.stream_collapse_starts(events, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return scan_batches(spark, f"{root}/table").select("camera_id", "event_id", "ts", "vehicle_count")


@query("A13 I9", f"""WITH {DET}, {EPISODES}, rws AS (SELECT camera_id, inicio AS ts, 'COLAPSO_INICIO' AS tipo, CAST(NULL AS INTEGER) AS duracion_min FROM epi
  UNION ALL SELECT camera_id, fin, 'COLAPSO_FIN', duracion_min FROM epi WHERE fin IS NOT NULL)
  SELECT *, false AS notificado FROM rws WHERE {_LEFT.format('det')}""")
def stream_alerts(spark, sf_dir):
    root = scratch_path(spark, "alerts")
    events = jobs.classify_events(event_stream(spark, sf_dir))
    jobs.stream_alerts(events, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return alert_lengths(scan_batches(spark, f"{root}/table"))


@query("I10", f"""WITH {CAMERA_FRAMES} SELECT camera_id, frame_id, ts, md5 FROM
  (SELECT *, lag(md5) OVER (PARTITION BY camera_id ORDER BY ts, frame_id) AS p FROM cam) WHERE p IS DISTINCT FROM md5 AND {_LEFT.format('cam')}""")
def stream_drop_unchanged(spark, sf_dir):
    root = scratch_path(spark, "unchanged")
    frames = camera_frames(stream_table(spark, sf_dir, "events"))
    jobs.stream_drop_unchanged(frames, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return scan_batches(spark, f"{root}/table").select("camera_id", "frame_id", "ts", "md5")


# ---- messages: some cut short, some without a field, some with a wrong one

def _messages(spark, sf_dir):
    det = detections(spark, sf_dir)
    state = F.when(F.col("event_id") % 10 != 1, F.col("estado"))
    text = F.to_json(F.struct(
        "camera_id", "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"), "vehicle_count",
        state.alias("estado"), "hour", "weekday", F.col("is_rush_hour").cast("int").alias("is_rush_hour"),
    ))
    kind = F.col("event_id") % 10
    return det.select(
        "event_id",
        F.when(kind == 0, F.substring(text, 1, 40)).when(kind == 2, "5").when(kind == 3, "").otherwise(text).alias("value"),
    )


def _stored_messages(spark, sf_dir):
    path = scratch_path(spark, "messages")
    _messages(spark, sf_dir).select("value").write.text(path)
    return path


@query("B2 M13", f"""WITH {DET} SELECT camera_id, event_id, ts, vehicle_count, CASE WHEN event_id % 10 <> 1 THEN estado END AS estado FROM det
  WHERE event_id % 10 NOT IN (0, 2, 3)""")
def parse_messages(spark, sf_dir):
    return parse_events(_messages(spark, sf_dir)).select("camera_id", "event_id", "ts", "vehicle_count", "estado")


@query("I12", """SELECT CASE WHEN event_id % 10 IN (0, 2, 3) THEN 'unreadable' ELSE 'missing estado' END AS reason, count(*) AS n
  FROM events WHERE event_id % 10 < 4 GROUP BY ALL""")
def rejected_messages(spark, sf_dir):
    _, rejected = split_invalid(_messages(spark, sf_dir))
    reason = F.when(F.col("reason") == "missing estado", F.col("reason")).otherwise("unreadable")
    return rejected.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("A6 I12", f"""WITH {DET} SELECT camera_id, event_id, ts, vehicle_count, estado FROM det WHERE event_id % 10 >= 4""")
def stream_messages(spark, sf_dir):
    root = scratch_path(spark, "valid")
    ok, _ = split_invalid(read_event_stream(spark, _stored_messages(spark, sf_dir)))
    _run(ok, batch_sink(f"{root}/table"), root)
    return scan_batches(spark, f"{root}/table").select("camera_id", "event_id", "ts", "vehicle_count", "estado")


def _six_fields(spark, sf_dir):
    """Messages as a single camera sends them, without camera and number."""
    text = F.to_json(F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"), "vehicle_count", "estado", "hour", "weekday",
        F.col("is_rush_hour").cast("int").alias("is_rush_hour"),
    ))
    path = scratch_path(spark, "single")
    detections(spark, sf_dir).select(text.alias("value")).write.text(path)
    return split_invalid(read_event_stream(spark, path))[0]


_SINGLE = "one AS (SELECT * REPLACE (0 AS camera_id) FROM det)"


@query("A6 I2 I4", f"""WITH {DET}, {_SINGLE}, {windows_sql(LONG, STEP, 'one')} SELECT {WINDOW_COLUMNS} FROM win WHERE {_CLOSED}""")
def stream_messages_single_camera(spark, sf_dir):
    root = scratch_path(spark, "single-windows")
    jobs.stream_windows(_six_fields(spark, sf_dir), f"{root}/table", f"{root}/checkpoint", LONG, STEP).awaitTermination()
    return scan_windows(spark, f"{root}/table")


@query("A6 I9", f"""WITH {DET}, {_SINGLE} SELECT camera_id, ts, vehicle_count FROM
  ({STARTS.replace('FROM det', 'FROM one')}) WHERE {_LEFT.format('det')}""")
def stream_single_camera_starts(spark, sf_dir):
    root = scratch_path(spark, "single-starts")
    jobs.stream_collapse_starts(_six_fields(spark, sf_dir), f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return scan_batches(spark, f"{root}/table").select("camera_id", "ts", "vehicle_count")


@query("I6 J8")
def stream_scored_windows(spark, sf_dir):
    """The model's state for the newest sample of each closed window.

    Messages carry no visual features, so the vector has zeros for them.
    """
    model = ml.fit(ml.with_class_weights(feature_rows(spark, sf_dir)))
    root = scratch_path(spark, "scored")
    events = jobs.classify_events(event_stream(spark, sf_dir)).withColumn("is_rush_hour", F.col("is_rush_hour").cast("int"))
    events = events.withColumns({name: F.lit(0.0) for name in VISUAL_FEATURES})
    jobs.stream_windows(
        events, f"{root}/table", f"{root}/checkpoint", LONG, STEP,
        last_sample=ml.feature_order(model), finish=lambda rows: jobs.score_last(rows, model),
    ).awaitTermination()
    return scan_batches(spark, f"{root}/table")


# ---- rows behind the watermark, time of arrival, the end of a feed

_BEHIND = """part AS (SELECT event_id, ts, CASE WHEN event_id % 10 = 0 THEN 3
    ELSE (epoch_us(ts) - epoch_us(lo)) * 3 // (epoch_us(hi) - epoch_us(lo) + 1) END AS part
  FROM events, (SELECT min(ts) AS lo, max(ts) AS hi FROM events)),
mark AS (SELECT p.part, max(epoch_ms(q.ts)) - 60000 AS ms FROM (SELECT DISTINCT part FROM part) p JOIN part q ON q.part < p.part GROUP BY p.part)"""


@query("I8", f"""WITH {_BEHIND} SELECT event_id, ts, coalesce(epoch_us(ts) < ms * 1000, false) AS late FROM part LEFT JOIN mark USING (part)""")
def stream_late_rows(spark, sf_dir):
    """Four deliveries, a tenth of the rows only in the last one."""
    events = raw_counts(spark.read.parquet(f"{sf_dir}/events.parquet"))
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(us), F.max(us)).first()
    span = 1 if low is None else high - low + 1
    part = F.when(F.col("event_id") % 10 == 0, 3).otherwise(F.floor((us - F.lit(low or 0)) * 3 / F.lit(span)))
    root = scratch_path(spark, "deliveries")
    feed = None
    for k in range(4):  # a micro-batch for each delivery
        events.where(part == k).write.mode("append").parquet(f"{root}/in")
        feed = feed or spark.readStream.schema(events.schema).parquet(f"{root}/in")
        jobs.split_late(feed, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return scan_batches(spark, f"{root}/table").select("event_id", "ts", "late")


_ARRIVAL = "arr AS (SELECT * REPLACE (ts + INTERVAL 1 SECOND * (event_id % 90) AS ts) FROM det)"


@query("I2", f"""WITH {DET}, {_ARRIVAL}, {windows_sql(LONG, STEP, 'arr')} SELECT {WINDOW_COLUMNS} FROM win
  WHERE window_end <= (SELECT max(ts) FROM arr)""")
def stream_windows_on_arrival(spark, sf_dir):
    """The stamps are part of the table, some behind the time of the event."""
    root = scratch_path(spark, "arrival")
    late = F.expr("ts + make_interval(0, 0, 0, 0, 0, 0, event_id % 90)")
    events = jobs.classify_events(event_stream(spark, sf_dir)).withColumn("arrival", late)
    jobs.stream_windows_on_arrival(events, f"{root}/table", f"{root}/checkpoint", LONG, STEP, "arrival").awaitTermination()
    return scan_windows(spark, f"{root}/table")


@query("I2 I3 I4 I5 I7", f"WITH {DET}, {RECENT} SELECT {WINDOW_COLUMNS} FROM win")
def stream_windows_to_the_end(spark, sf_dir):
    """All windows, also those that are open when the feed ends."""
    root = scratch_path(spark, "ended")
    events = jobs.classify_events(event_stream(spark, sf_dir))
    for _ in range(2):
        jobs.stream_windows(jobs.with_end(events, f"{root}/end"), f"{root}/table", f"{root}/checkpoint", LONG, STEP).awaitTermination()
        jobs.end_feed(events, f"{root}/end")
    return scan_windows(spark, f"{root}/table")


# ---- live status, and a model that changes while the stream runs

@query("A14", LATEST)
def stream_latest_status(spark, sf_dir):
    """The table of the newest snapshots after the last micro-batch."""
    root = scratch_path(spark, "status")
    events = jobs.classify_events(event_stream(spark, sf_dir)).drop("confianza", "metodo")
    jobs.stream_latest_status(events, f"{root}/table", f"{root}/checkpoint").awaitTermination()
    return history.status_rows(scan_live(spark, f"{root}/table"), known_cameras(spark, sf_dir)).select(*STATUS)


def _certain(spark, sf_dir, state):
    """A forest of one leaf: features without any difference, and states of which two in three are ``state``."""
    other = "FLUIDO" if state != "FLUIDO" else "DENSO"
    same = [F.lit(0.0).alias(name) for name in FEATURES]
    rows = detections(spark, sf_dir).select(*same, F.when(F.col("event_id") % 3 == 0, other).otherwise(state).alias("estado"), F.lit(1.0).alias("sample_weight"))
    return ml.pipeline(trees=1, depth=1).fit(rows)


_HALF = "half AS (SELECT make_timestamp((epoch_us(min(ts)) + epoch_us(max(ts))) // 2) AS mid FROM det)"


@query("I6 A11 J8", f"""WITH {DET}, {RECENT}, {_HALF}, sw AS (SELECT max(ts) - INTERVAL 1 MINUTE AS until FROM det WHERE ts <= (SELECT mid FROM half))
  SELECT camera_id, window_end, n_samples, CASE WHEN window_end <= (SELECT until FROM sw) THEN 'DENSO' ELSE 'COLAPSO' END AS estado_modelo,
    CASE WHEN window_end <= (SELECT until FROM sw) THEN 1 ELSE 2 END AS modelo_version FROM win WHERE {_CLOSED}""")
def stream_model_versions(spark, sf_dir):
    """The first half of the events is scored by one model, the rest by one that is published in between."""
    root = scratch_path(spark, "versions")
    counts = raw_counts(spark.read.parquet(f"{sf_dir}/events.parquet"))
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = counts.agg(F.min(us), F.max(us)).first()
    first = us <= F.lit(((low or 0) + (high or 0)) // 2)
    feed, finish = None, jobs.versioned_scorer(f"{root}/model")
    for half, state in ((first, "DENSO"), (~first, "COLAPSO")):
        ml.publish_model(_certain(spark, sf_dir, state), f"{root}/model")
        counts.where(half).write.mode("append").parquet(f"{root}/in")
        feed = feed or spark.readStream.schema(counts.schema).parquet(f"{root}/in")
        events = jobs.classify_events(feed).withColumn("is_rush_hour", F.col("is_rush_hour").cast("int"))
        events = events.withColumns({name: F.lit(0.0) for name in VISUAL_FEATURES})
        jobs.stream_windows(events, f"{root}/table", f"{root}/checkpoint", LONG, STEP, last_sample=FEATURES, finish=finish).awaitTermination()
    return scan_batches(spark, f"{root}/table").select("camera_id", "window_end", "n_samples", "estado_modelo", "modelo_version")
