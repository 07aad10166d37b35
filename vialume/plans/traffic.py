"""Queries over detections and windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from vialume.functions.calendar import is_peak_hour
from vialume.functions.states import congestion_score, threshold_class
from vialume.functions.parsing import safe_int
from vialume.operators import alerts, dedup, forecast, history, windows
from vialume.plans.registry import query
from vialume.plans.standins import (
    CAMERA_FRAMES, DET, SCORE, WINDOW_COLUMNS, camera_frames, detections, raw_counts, table, windows_sql,
)
from vialume.session import scratch_path
from vialume.sources.tables import batch_sink, scan_batches, scan_detections, write_detections

NOW = dt.datetime(2024, 1, 20, 12, 0)
FIRST, LAST = "2024-01-10", "2024-01-12"
LONG, STEP = 7200, 1800
RECENT = windows_sql(LONG, STEP)
_IN_RANGE = f"ts >= TIMESTAMP '{FIRST}' AND ts < TIMESTAMP '{LAST}' + INTERVAL 1 DAY"


def long_windows(spark, sf_dir):
    return windows.sliding_windows(detections(spark, sf_dir), LONG, STEP)


# ---- filters and projections

@query("B8 B9 B10 B11", f"""WITH {DET} SELECT event_id, weekday, hour, minute, is_rush_hour,
  CAST(hour BETWEEN 11 AND 16 AS INTEGER) AS is_peak_hour, {SCORE} AS congestion_hour_score FROM det""")
def calendar_features(spark, sf_dir):
    det = detections(spark, sf_dir)
    return det.select(
        "event_id", "weekday", "hour", "minute", "is_rush_hour",
        is_peak_hour(F.col("hour")).alias("is_peak_hour"),
        congestion_score(F.col("hour")).alias("congestion_hour_score"),
    )


@query("B12", f"WITH {DET} SELECT event_id, vehicle_count, estado, 1.0::DOUBLE AS confianza, 'umbral' AS metodo FROM det")
def threshold_states(spark, sf_dir):
    counts = raw_counts(table(spark, sf_dir, "events"))
    return counts.select("event_id", "vehicle_count", threshold_class(F.col("vehicle_count")).alias("c")).select(
        "event_id", "vehicle_count", "c.*"
    )


_TEXT = """CASE event_id % 7 WHEN 0 THEN CAST(round(value, 2) AS VARCHAR) WHEN 1 THEN 'True' WHEN 2 THEN '' WHEN 3 THEN 'NaN'
  WHEN 4 THEN event_type WHEN 5 THEN 'Infinity' ELSE NULL END"""


@query("B1", """SELECT event_id, CAST(CASE event_id % 7 WHEN 0 THEN trunc(round(value, 2)) WHEN 1 THEN 1 ELSE 0 END AS INTEGER) AS n FROM events""")
def safe_ints(spark, sf_dir):
    text = F.expr(_TEXT.replace("VARCHAR", "STRING"))
    return table(spark, sf_dir, "events").select("event_id", safe_int(text).alias("n"))


@query("B3", f"""WITH {DET} SELECT ts, event_id, vehicle_count, estado FROM det
  WHERE ts > TIMESTAMP '{NOW}' - INTERVAL 1440 MINUTE""")
def history_minutes(spark, sf_dir):
    recent = history.history_minutes(detections(spark, sf_dir), NOW, 5000, max_minutes=1440)
    return recent.select("ts", "event_id", "vehicle_count", "estado")


@query("B4 F2", f"""WITH {DET} SELECT ts, event_id, vehicle_count, estado, hour, weekday FROM det
  WHERE {_IN_RANGE} ORDER BY ts, event_id LIMIT 5000""")
def history_range(spark, sf_dir):
    rows = history.history_range(detections(spark, sf_dir), FIRST, LAST, limit=5000, order=("ts", "event_id"))
    return rows.select("ts", "event_id", "vehicle_count", "estado", "hour", "weekday")


@query("B5", f"WITH {DET} SELECT camera_id, event_id, ts, vehicle_count FROM det WHERE CAST(ts AS DATE) = DATE '{FIRST}'")
def rows_on_day(spark, sf_dir):
    return history.on_day(detections(spark, sf_dir), FIRST).select("camera_id", "event_id", "ts", "vehicle_count")


# ---- aggregates

@query("D1 B5", f"""WITH {DET} SELECT count(*) AS total, avg(vehicle_count) AS avg_vehicles, max(vehicle_count) AS max_vehicles,
  CAST(sum(CASE WHEN estado = 'COLAPSO' THEN 1 END) AS BIGINT) AS colapsos, CAST(sum(CASE WHEN estado = 'DENSO' THEN 1 END) AS BIGINT) AS densos,
  CAST(sum(CASE WHEN estado = 'FLUIDO' THEN 1 END) AS BIGINT) AS fluidos FROM det WHERE CAST(ts AS DATE) = DATE '{FIRST}'""")
def day_stats(spark, sf_dir):
    return history.day_stats(detections(spark, sf_dir), FIRST)


@query("D2", f"""WITH {DET} SELECT estado, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM det), 6) AS share_pct
  FROM det GROUP BY estado""")
def class_distribution(spark, sf_dir):
    shares = history.class_distribution(detections(spark, sf_dir))
    return shares.withColumn("share_pct", F.round("share_pct", 6))


@query("D6", f"""WITH {DET} SELECT hour, CAST(count(*) FILTER (estado <> 'FLUIDO') AS DOUBLE) / count(*) AS congestion_score
  FROM det GROUP BY hour""")
def hourly_congestion(spark, sf_dir):
    return history.hourly_congestion(detections(spark, sf_dir))


@query("D7", f"""WITH {DET} SELECT count(*) AS total, count(*) FILTER (estado = 'FLUIDO') AS FLUIDO, count(*) FILTER (estado = 'DENSO') AS DENSO,
  count(*) FILTER (estado = 'COLAPSO') AS COLAPSO, round(avg(vehicle_count), 1) AS avg, greatest(max(vehicle_count), 0) AS max
  FROM det WHERE {_IN_RANGE}""")
def range_kpis(spark, sf_dir):
    return history.range_kpis(history.in_days(detections(spark, sf_dir), FIRST, LAST))


@query("D8", f"""WITH {DET} SELECT printf('%02dh', hour) AS hour, count(*) FILTER (estado = 'FLUIDO') AS FLUIDO,
  count(*) FILTER (estado = 'DENSO') AS DENSO, count(*) FILTER (estado = 'COLAPSO') AS COLAPSO, count(*) AS total,
  CAST(sum(vehicle_count) AS BIGINT) AS sum_v, round(CAST(sum(vehicle_count) AS DOUBLE) / count(*), 1) AS avg FROM det GROUP BY hour""")
def by_hour(spark, sf_dir):
    return history.by_hour(detections(spark, sf_dir))


@query("D12", f"""WITH {DET}, t AS (SELECT camera_id, hour, count(*) FILTER (estado = 'FLUIDO') AS f,
    count(*) FILTER (estado = 'DENSO') AS d, count(*) FILTER (estado = 'COLAPSO') AS c FROM det GROUP BY camera_id, hour)
  SELECT camera_id, hour, f AS n_fluido, d AS n_denso, c AS n_colapso,
    CASE WHEN c >= d AND c >= f THEN 'COLAPSO' WHEN d >= f THEN 'DENSO' ELSE 'FLUIDO' END AS estado FROM t""")
def state_mode(spark, sf_dir):
    return windows.state_mode(detections(spark, sf_dir), ["camera_id", "hour"])


@query("E8", f"""WITH {DET}, s AS (SELECT camera_id, list_sort(list(vehicle_count)) AS v, count(*) AS n FROM det GROUP BY camera_id)
  SELECT camera_id, n AS n_rows, CASE WHEN n >= 10 THEN v[n * 65 // 100 + 1] ELSE 5 END AS umbral_denso,
    CASE WHEN n >= 10 THEN v[n * 85 // 100 + 1] ELSE 10 END AS umbral_colapso FROM s""")
def adaptive_thresholds(spark, sf_dir):
    return history.adaptive_thresholds(detections(spark, sf_dir))


# ---- ordered

@query("E1", f"""WITH {CAMERA_FRAMES} SELECT camera_id, frame_id, ts, md5 FROM
  (SELECT *, lag(md5) OVER (PARTITION BY camera_id ORDER BY ts, frame_id) AS p FROM cam) WHERE p IS DISTINCT FROM md5""")
def drop_unchanged(spark, sf_dir):
    return dedup.drop_unchanged(camera_frames(table(spark, sf_dir, "events")))


STARTS = """SELECT camera_id, event_id, ts, vehicle_count FROM
  (SELECT *, lag(estado) OVER (PARTITION BY camera_id ORDER BY ts, event_id) AS p FROM det)
  WHERE estado = 'COLAPSO' AND p IS DISTINCT FROM 'COLAPSO'"""


@query("E3", f"WITH {DET} {STARTS}")
def collapse_starts(spark, sf_dir):
    det = detections(spark, sf_dir).select("camera_id", "event_id", "ts", "vehicle_count", "estado")
    return alerts.collapse_starts(det).drop("estado")


EPISODES = """marked AS (
  SELECT *, coalesce(lag(estado) OVER w, '') = 'COLAPSO' AS was FROM det WINDOW w AS (PARTITION BY camera_id ORDER BY ts, event_id)),
changes AS (SELECT *, lead(ts) OVER (PARTITION BY camera_id ORDER BY ts, event_id) AS fin FROM marked WHERE (estado = 'COLAPSO') <> was),
epi AS (SELECT camera_id, ts AS inicio, fin, CAST((epoch_us(fin) - epoch_us(ts)) // 60000000 AS INTEGER) AS duracion_min
  FROM changes WHERE estado = 'COLAPSO')"""


@query("E4", f"WITH {DET}, {EPISODES} SELECT * FROM epi")
def collapse_episodes(spark, sf_dir):
    return alerts.collapse_episodes(detections(spark, sf_dir))


@query("A13", f"""WITH {DET}, {EPISODES} SELECT camera_id, inicio AS ts, 'COLAPSO_INICIO' AS tipo, CAST(NULL AS INTEGER) AS duracion_min, false AS notificado FROM epi
  UNION ALL SELECT camera_id, fin, 'COLAPSO_FIN', duracion_min, false FROM epi WHERE fin IS NOT NULL""")
def alert_table(spark, sf_dir):
    rows = alerts.alert_rows(alerts.collapse_episodes(detections(spark, sf_dir)))
    path = scratch_path(spark, "alerts")
    batch_sink(path)(rows, 0)
    return scan_batches(spark, path)


@query("E7", f"""WITH {DET}, r AS (SELECT *, row_number() OVER (PARTITION BY camera_id ORDER BY ts DESC, event_id DESC) AS rn,
    max(vehicle_count) OVER (PARTITION BY camera_id) AS m FROM det)
  SELECT camera_id, ts, event_id, vehicle_count, estado,
    greatest(10.0::DOUBLE, CAST(vehicle_count AS DOUBLE) / greatest(m, 1) * 100) AS height_pct FROM r WHERE rn <= 20""")
def sparkline(spark, sf_dir):
    return history.sparkline(detections(spark, sf_dir))


# ---- latest

@query("F3", f"WITH {DET} SELECT camera_id, arg_max(estado, (ts, event_id)) AS estado FROM det GROUP BY camera_id")
def last_state(spark, sf_dir):
    return history.last_state(detections(spark, sf_dir))


LATEST = f"""WITH {DET}, n AS (SELECT * FROM det QUALIFY row_number() OVER (PARTITION BY camera_id ORDER BY ts DESC, event_id DESC) = 1),
  cams AS (SELECT DISTINCT user_id % 6 AS camera_id FROM events)
  SELECT cams.camera_id, n.vehicle_count, coalesce(n.estado, 'FLUIDO') AS estado, 'umbral' AS metodo, n.ts, n.camera_id IS NOT NULL AS ready
  FROM cams LEFT JOIN n ON n.camera_id = cams.camera_id"""
STATUS = ["camera_id", "vehicle_count", "estado", "metodo", "ts", "ready"]


def known_cameras(spark, sf_dir):
    return table(spark, sf_dir, "events").select((F.col("user_id") % 6).alias("camera_id")).distinct()


@query("A14", LATEST)
def latest_status(spark, sf_dir):
    return history.latest_status(detections(spark, sf_dir), known_cameras(spark, sf_dir)).select(*STATUS)


# ---- windows

@query("I2 I3 I4 I5 D12 E6", f"WITH {DET}, {RECENT} SELECT {WINDOW_COLUMNS} FROM win")
def sliding_windows(spark, sf_dir):
    return long_windows(spark, sf_dir)


@query("I2 I3 E6", f"WITH {DET}, {windows_sql(300, 30)} SELECT {WINDOW_COLUMNS} FROM win")
def sliding_windows_5min(spark, sf_dir):
    return windows.sliding_windows(detections(spark, sf_dir))


@query("I3", f"WITH {DET}, {RECENT} SELECT camera_id, window_start, avg_vehicles, max_vehicles, n_samples FROM win")
def window_stats(spark, sf_dir):
    return windows.window_stats(detections(spark, sf_dir), LONG, STEP)


@query("I5 D12", f"""WITH {DET}, {RECENT} SELECT camera_id, window_start, f AS n_fluido, d AS n_denso, c AS n_colapso, estado_ventana FROM win""")
def window_state(spark, sf_dir):
    return windows.window_state(detections(spark, sf_dir), LONG, STEP)


@query("E6 I4", f"WITH {DET}, {RECENT} SELECT camera_id, tendencia, count(*) AS n_windows FROM win GROUP BY camera_id, tendencia")
def trend_counts(spark, sf_dir):
    return long_windows(spark, sf_dir).groupBy("camera_id", "tendencia").agg(F.count(F.lit(1)).alias("n_windows"))


_ROLL = "avg(avg_vehicles) OVER (PARTITION BY camera_id ORDER BY window_start ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"
_AHEAD = """CASE tendencia
  WHEN 'SUBIENDO' THEN CASE WHEN estado_ventana = 'FLUIDO' AND m > 3 THEN 'DENSO' WHEN estado_ventana = 'DENSO' THEN 'COLAPSO' ELSE estado_ventana END
  WHEN 'BAJANDO' THEN CASE estado_ventana WHEN 'COLAPSO' THEN 'DENSO' WHEN 'DENSO' THEN 'FLUIDO' ELSE estado_ventana END
  ELSE estado_ventana END"""


@query("E9", f"WITH {DET}, {RECENT} SELECT camera_id, window_start, round({_ROLL}, 6) AS avg_reciente FROM win")
def rolling_mean(spark, sf_dir):
    rows = forecast.rolling_mean(long_windows(spark, sf_dir))
    return rows.select("camera_id", "window_start", F.round("avg_reciente", 6).alias("avg_reciente"))


@query("E5", f"""WITH {DET}, {RECENT}, r AS (SELECT *, {_ROLL} AS m FROM win)
  SELECT camera_id, window_start, tendencia, estado_ventana, {_AHEAD} AS prediccion_10min FROM r""")
def forecast_each_window(spark, sf_dir):
    rows = forecast.forecast_each(long_windows(spark, sf_dir))
    return rows.select("camera_id", "window_start", "tendencia", "estado_ventana", "prediccion_10min")


@query("E5", f"""WITH {DET}, {RECENT}, r AS (SELECT *, {_ROLL} AS m FROM win),
  n AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY camera_id ORDER BY window_start DESC) = 1)
  SELECT camera_id, tendencia, estado_ventana, round(m, 6) AS avg_reciente, {_AHEAD} AS prediccion_10min FROM n""")
def forecast_state(spark, sf_dir):
    now = forecast.forecast_state(long_windows(spark, sf_dir))
    return now.withColumn("avg_reciente", F.round("avg_reciente", 6))


@query("D10", f"""WITH {DET}, {RECENT}, s(estado) AS (VALUES ('FLUIDO'), ('DENSO'), ('COLAPSO'))
  SELECT estado, CAST(round(CAST((SELECT count(*) FROM win WHERE estado_ventana = s.estado) AS DOUBLE) / (SELECT count(*) FROM win) * 100) AS INTEGER) AS pct FROM s""")
def window_state_share(spark, sf_dir):
    return history.window_state_share(long_windows(spark, sf_dir))


@query("F1", f"WITH {DET}, {RECENT} SELECT {WINDOW_COLUMNS} FROM win ORDER BY window_end DESC, camera_id DESC LIMIT 12")
def recent_windows(spark, sf_dir):
    return history.recent_windows(long_windows(spark, sf_dir))


@query("F1", f"WITH {DET}, {RECENT} SELECT {WINDOW_COLUMNS} FROM win WHERE window_end >= TIMESTAMP '{NOW}' - INTERVAL 600 MINUTE")
def recent_windows_minutes(spark, sf_dir):
    return history.recent_windows(long_windows(spark, sf_dir), minutes=600, now=NOW)


@query("F5", f"WITH {DET}, {RECENT} SELECT {WINDOW_COLUMNS} FROM win ORDER BY window_end DESC, camera_id DESC LIMIT 10")
def latest_windows_table(spark, sf_dir):
    return history.latest_windows_table(long_windows(spark, sf_dir))


# ---- stored tables

@query("A7 A9", f"""WITH {DET} SELECT ts, vehicle_count, estado, hour, weekday FROM det WHERE {_IN_RANGE}""")
def stored_detections(spark, sf_dir):
    path = scratch_path(spark, "detections")
    write_detections(detections(spark, sf_dir), path)
    return scan_detections(spark, path, ["ts", "vehicle_count", "estado", "hour", "weekday"], FIRST, LAST)
