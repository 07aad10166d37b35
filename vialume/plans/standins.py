"""The traffic tables as views over the test tables, in Spark and as SQL text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vialume.config import (
    COLLAPSE_FROM, CONGESTION_BY_HOUR, CONGESTION_DEFAULT, DENSE_FROM, MASK_POLYGON, META_FEATURES, RUSH_HOURS, VISUAL_FEATURES, ZONES,
)
from vialume.functions.calendar import is_peak_hour, with_calendar
from vialume.functions.states import congestion_score, threshold_state


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream. The bracket makes the path a pattern, which may match a single file
    as well as a folder; a plain path would have to be a folder."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/[{name[0]}]{name[1:]}.parquet")


# ---- detections: one row per processed frame, four cameras -----------------------------------

def raw_counts(events: DataFrame) -> DataFrame:
    """Camera, time and vehicle count from ``events``."""
    return events.select(
        (F.col("user_id") % 4).alias("camera_id"),
        "event_id",
        "ts",
        F.floor(F.col("value") / 10).cast("int").alias("vehicle_count"),
    )


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = raw_counts(table(spark, sf_dir, "events"))
    return with_calendar(counts).withColumn("estado", threshold_state(F.col("vehicle_count")))


_RUSH = " OR ".join(f"hour(ts) BETWEEN {first} AND {last}" for first, last in RUSH_HOURS)

DET = f"""det AS (
  SELECT *, CASE WHEN vehicle_count >= {COLLAPSE_FROM} THEN 'COLAPSO' WHEN vehicle_count >= {DENSE_FROM} THEN 'DENSO' ELSE 'FLUIDO' END AS estado,
    CAST(isodow(ts) - 1 AS INTEGER) AS weekday, CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute,
    {_RUSH} AS is_rush_hour
  FROM (SELECT user_id % 4 AS camera_id, event_id, ts, CAST(floor(value / 10) AS INTEGER) AS vehicle_count FROM events))"""

SCORE = f"""CASE hour {' '.join(f'WHEN {hour} THEN {share}' for hour, share in CONGESTION_BY_HOUR.items())} ELSE {CONGESTION_DEFAULT} END::DOUBLE"""


def windows_sql(duration: int, slide: int, source: str = "det", name: str = "win") -> str:
    """CTE of the sliding windows, straight from their definition."""
    d, s = duration * 1_000_000, slide * 1_000_000
    copies = -(-duration // slide)
    return f"""{name}_rows AS (
  SELECT t.*, epoch_us(ts) - epoch_us(ts) % {s} - k * {s} AS start FROM {source} t, range({copies}) r(k)
  WHERE epoch_us(ts) - epoch_us(ts) % {s} - k * {s} + {d} > epoch_us(ts)),
{name}_lists AS (
  SELECT camera_id, start, count(*) AS n_samples, sum(vehicle_count) AS total, max(vehicle_count) AS max_vehicles,
    list(vehicle_count ORDER BY ts, event_id) AS counts,
    count(*) FILTER (estado = 'FLUIDO') AS f, count(*) FILTER (estado = 'DENSO') AS d, count(*) FILTER (estado = 'COLAPSO') AS c
  FROM {name}_rows GROUP BY camera_id, start),
{name}_means AS (
  SELECT *, CAST(list_sum(counts[-3:]) AS DOUBLE) / 3 AS recent, CAST(list_sum(counts[1:3]) AS DOUBLE) / 3 AS older FROM {name}_lists),
{name} AS (
  SELECT camera_id, make_timestamp(start) AS window_start, make_timestamp(start + {d}) AS window_end,
    CAST(total AS DOUBLE) / n_samples AS avg_vehicles, max_vehicles,
    CASE WHEN n_samples < 3 THEN 'ESTABLE' WHEN recent > older * 1.2::DOUBLE THEN 'SUBIENDO'
      WHEN recent < older * 0.8::DOUBLE THEN 'BAJANDO' ELSE 'ESTABLE' END AS tendencia,
    CASE WHEN c >= d AND c >= f THEN 'COLAPSO' WHEN d >= f THEN 'DENSO' ELSE 'FLUIDO' END AS estado_ventana,
    CASE WHEN c >= d AND c >= f THEN 'COLAPSO' WHEN d >= f THEN 'DENSO' ELSE 'FLUIDO' END AS estado_predicho,
    n_samples, f, d, c
  FROM {name}_means)"""


WINDOW_COLUMNS = (
    "camera_id, window_start, window_end, avg_vehicles, max_vehicles, tendencia, estado_ventana, estado_predicho, n_samples"
)


# ---- camera frames: time, and a hash that repeats often ---------------------------------------

def camera_frames(events: DataFrame) -> DataFrame:
    return events.select(
        (F.col("user_id") % 4).alias("camera_id"),
        F.col("event_id").alias("frame_id"),
        "ts",
        F.md5(F.col("event_type").cast("binary")).alias("md5"),
    )


CAMERA_FRAMES = """cam AS (
  SELECT user_id % 4 AS camera_id, event_id AS frame_id, ts, md5(event_type) AS md5 FROM events)"""


# ---- boxes ------------------------------------------------------------------------------------

def _box_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn(
        "box_id", F.col("l_partkey") * 100000 + F.col("l_suppkey") * 10 + F.col("l_linenumber")
    )


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes spread over the frame, one frame per order."""
    kind = F.element_at(F.array(*[F.lit(c) for c in (2, 3, 5, 7, 0)]), (F.col("l_partkey") % 5 + 1).cast("int"))
    x1 = (F.col("l_partkey") * 37) % 600
    y1 = F.lit(150) + (F.col("l_suppkey") * 11) % 200
    return _box_base(spark, sf_dir).select(
        F.col("l_orderkey").alias("frame_id"),
        "box_id",
        x1.cast("int").alias("x1"),
        y1.cast("int").alias("y1"),
        (x1 + 20 + F.col("l_quantity")).cast("int").alias("x2"),
        (y1 + 20 + F.col("l_linenumber") * 4).cast("int").alias("y2"),
        kind.alias("cls"),
        (F.lit(0.15) + F.col("l_discount") * 8).alias("conf"),
    )


def dense_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes crowded into one corner, so that many overlap."""
    x1 = (F.col("l_partkey") * 37) % 100
    y1 = (F.col("l_suppkey") * 11) % 50
    return _box_base(spark, sf_dir).select(
        F.col("l_orderkey").alias("frame_id"),
        "box_id",
        x1.cast("int").alias("x1"),
        y1.cast("int").alias("y1"),
        (x1 + 40 + F.col("l_quantity")).cast("int").alias("x2"),
        (y1 + 40 + F.round(F.col("l_tax") * 100)).cast("int").alias("y2"),
        F.when(F.col("l_linenumber") % 2 == 0, 2).otherwise(3).alias("cls"),
        (F.lit(0.15) + F.col("l_discount") * 8).alias("conf"),
    )


def crowded_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The crowded boxes of many orders in one of twenty frames; every fifth has no confidence."""
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    x1 = (F.col("l_partkey") * 37) % 300
    y1 = (F.col("l_suppkey") * 11) % 200
    return table(spark, sf_dir, "lineitem").select(
        (order % 20).alias("frame_id"),
        ((order * 10 + line) * 10**9 + F.col("l_partkey") * 10**4 + F.col("l_suppkey")).alias("box_id"),
        x1.cast("int").alias("x1"),
        y1.cast("int").alias("y1"),
        (x1 + 40 + F.col("l_quantity")).cast("int").alias("x2"),
        (y1 + 40 + F.round(F.col("l_tax") * 100)).cast("int").alias("y2"),
        F.when(line % 2 == 0, 2).otherwise(3).alias("cls"),
        F.when((order + line) % 5 > 0, F.lit(0.15) + F.col("l_discount") * 8).alias("conf"),
    )


def box_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All frames, with or without boxes."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("frame_id"))


BOXES = """boxes AS (
  SELECT frame_id, box_id, CAST(x1 AS INTEGER) AS x1, CAST(y1 AS INTEGER) AS y1, CAST(x1 + 20 + q AS INTEGER) AS x2,
    CAST(y1 + 20 + n * 4 AS INTEGER) AS y2, cls, conf
  FROM (SELECT l_orderkey AS frame_id, l_partkey * 100000 + l_suppkey * 10 + l_linenumber AS box_id,
      (l_partkey * 37) % 600 AS x1, 150 + (l_suppkey * 11) % 200 AS y1, CAST(floor(l_quantity) AS INTEGER) AS q,
      l_linenumber AS n, [2, 3, 5, 7, 0][l_partkey % 5 + 1] AS cls, 0.15::DOUBLE + l_discount * 8 AS conf FROM lineitem))"""

DENSE = """dense AS (
  SELECT frame_id, box_id, CAST(x1 AS INTEGER) AS x1, CAST(y1 AS INTEGER) AS y1, CAST(x1 + 40 + q AS INTEGER) AS x2,
    CAST(y1 + 40 + t AS INTEGER) AS y2, cls, conf
  FROM (SELECT l_orderkey AS frame_id, l_partkey * 100000 + l_suppkey * 10 + l_linenumber AS box_id,
      (l_partkey * 37) % 100 AS x1, (l_suppkey * 11) % 50 AS y1, CAST(floor(l_quantity) AS INTEGER) AS q,
      CAST(round(l_tax * 100) AS INTEGER) AS t, CASE WHEN l_linenumber % 2 = 0 THEN 2 ELSE 3 END AS cls,
      0.15::DOUBLE + l_discount * 8 AS conf FROM lineitem))"""

CROWDED = """crowded AS (
  SELECT l_orderkey % 20 AS frame_id, (l_orderkey * 10 + l_linenumber) * 1000000000 + l_partkey * 10000 + l_suppkey AS box_id, CAST(x1 AS INTEGER) AS x1, CAST(y1 AS INTEGER) AS y1,
    CAST(x1 + 40 + floor(l_quantity) AS INTEGER) AS x2, CAST(y1 + 40 + round(l_tax * 100) AS INTEGER) AS y2,
    CASE WHEN l_linenumber % 2 = 0 THEN 2 ELSE 3 END AS cls, CASE WHEN (l_orderkey + l_linenumber) % 5 > 0 THEN 0.15::DOUBLE + l_discount * 8 END AS conf
  FROM (SELECT *, (l_partkey * 37) % 300 AS x1, (l_suppkey * 11) % 200 AS y1 FROM lineitem))"""

ZONES_SQL = "zones(ord, zone, zx1, zy1, zx2, zy2) AS (VALUES " + ", ".join(
    f"({z.ord}, '{z.name}', {z.x1}, {z.y1}, {z.x2}, {z.y2})" for z in ZONES
) + ")"

EDGES_SQL = "edges(ax, ay, ex, ey) AS (VALUES " + ", ".join(
    f"({ax}, {ay}, {bx}, {by})" for (ax, ay), (bx, by) in zip(MASK_POLYGON, [*MASK_POLYGON[1:], MASK_POLYGON[0]])
) + ")"

CENTER_IN = "(x1 + x2) / 2.0 BETWEEN zx1 AND zx2 AND (y1 + y2) / 2.0 BETWEEN zy1 AND zy2"

RATIO = """(CASE WHEN least(x2, zx2) > greatest(x1, zx1) AND least(y2, zy2) > greatest(y1, zy1)
  THEN CAST((least(x2, zx2) - greatest(x1, zx1)) * (least(y2, zy2) - greatest(y1, zy1)) AS DOUBLE)
    / greatest((x2 - x1) * (y2 - y1), 1) ELSE 0 END)"""


# ---- labels, frames, counts, metadata ----------------------------------------------------------

def _day(doc: Column) -> Column:
    return F.format_string("202401%02d", (doc % 28 + 1).cast("int"))


def _file(doc: Column) -> Column:
    return F.format_string("frame_%010d.jpg", doc)


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label rows as text; some hours are blank, flags are words."""
    doc = F.col("doc_id")
    state = F.when(F.col("toxic") == 1, "COLAPSO").when(F.col("quality") == 1, "FLUIDO").otherwise("DENSO")
    hour = (doc % 24).cast("int")
    return table(spark, sf_dir, "labels").select(
        _day(doc).alias("fecha"),
        _file(doc).alias("filename"),
        F.concat(F.lit("t"), doc.cast("string")).alias("timestamp"),
        (doc % 7).cast("string").alias("weekday"),
        F.concat(F.lit("d"), (doc % 7).cast("string")).alias("weekday_name"),
        F.when(doc % 11 == 0, "").otherwise(hour.cast("string")).alias("hour"),
        (doc % 60).cast("string").alias("minute"),
        F.when(doc % 2 == 0, "True").otherwise("False").alias("is_rush_hour"),
        state.alias("estado"),
    )


LABELS = """lab AS (
  SELECT doc_id, printf('202401%02d', doc_id % 28 + 1) AS fecha, printf('frame_%010d.jpg', doc_id) AS filename, 't' || doc_id AS timestamp,
    CAST(doc_id % 7 AS VARCHAR) AS weekday, 'd' || (doc_id % 7) AS weekday_name,
    CASE WHEN doc_id % 11 = 0 THEN '' ELSE CAST(doc_id % 24 AS VARCHAR) END AS hour, CAST(doc_id % 60 AS VARCHAR) AS minute,
    CASE WHEN doc_id % 2 = 0 THEN 'True' ELSE 'False' END AS is_rush_hour,
    CASE WHEN toxic = 1 THEN 'COLAPSO' WHEN quality = 1 THEN 'FLUIDO' ELSE 'DENSO' END AS estado
  FROM labels)"""


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(_day(doc).alias("fecha"), _file(doc).alias("filename"), "doc_id")


FRAMES = """fra AS (
  SELECT doc_id, printf('202401%02d', doc_id % 28 + 1) AS fecha, printf('frame_%010d.jpg', doc_id) AS filename FROM documents)"""


def _two_in_three(doc: Column) -> Column:
    """The numbers that 3 does not divide, in order: 1, 2, 4, 5, 7."""
    return doc + F.floor(doc / 2) + 1


def stored_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames whose numbers leave out every third."""
    doc = _two_in_three(F.col("doc_id"))
    return table(spark, sf_dir, "documents").select(_day(doc).alias("fecha"), _file(doc).alias("filename"), doc.alias("doc_id"))


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of frames with even numbers; those of the last four days stand in another month."""
    doc = F.col("doc_id") * 2
    day = F.when(doc % 28 < 24, _day(doc)).otherwise(F.format_string("202402%02d", (doc % 28 + 1).cast("int")))
    return table(spark, sf_dir, "documents").select(
        day.alias("fecha"), _file(doc).alias("filename"), (F.col("n_chars") % 15).cast("int").alias("vehicle_count")
    )


COUNTS = """cnt AS (
  SELECT printf('2024%02d%02d', CASE WHEN k % 28 < 24 THEN 1 ELSE 2 END, k % 28 + 1) AS fecha, printf('frame_%010d.jpg', k) AS filename,
    CAST(n_chars % 15 AS INTEGER) AS vehicle_count
  FROM (SELECT doc_id * 2 AS k, n_chars FROM documents))"""

ENRICHED = """enr AS (
  SELECT lab.*, CAST(CASE WHEN lab.fecha IN (SELECT fecha FROM cnt) THEN coalesce(cnt.vehicle_count, 0) END AS INTEGER) AS vehicle_count
  FROM lab LEFT JOIN cnt ON lab.fecha = cnt.fecha AND lab.filename = cnt.filename)"""


def meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of frames whose numbers leave out every third; the weekday name is missing in some."""
    doc = _two_in_three(F.col("doc_id"))
    return table(spark, sf_dir, "documents").select(
        _day(doc).alias("fecha"),
        F.regexp_replace(_file(doc), r"\.jpg$", "").alias("stem"),
        F.concat(F.lit("2024-01-01T00:00:"), (doc % 60).cast("string")).alias("timestamp"),
        (doc % 7).cast("int").alias("weekday"),
        F.when(doc % 5 != 0, F.concat(F.lit("d"), (doc % 7).cast("string"))).alias("weekday_name"),
        (doc % 24).cast("int").alias("hour"),
        (doc % 60).cast("int").alias("minute"),
        (doc % 2 == 0).alias("is_rush_hour"),
    )


META = """met AS (
  SELECT printf('202401%02d', doc_id % 28 + 1) AS fecha, printf('frame_%010d', doc_id) AS stem, '2024-01-01T00:00:' || (doc_id % 60) AS timestamp,
    CAST(doc_id % 7 AS INTEGER) AS weekday, CASE WHEN doc_id % 5 <> 0 THEN 'd' || (doc_id % 7) END AS weekday_name,
    CAST(doc_id % 24 AS INTEGER) AS hour, CAST(doc_id % 60 AS INTEGER) AS minute, doc_id % 2 = 0 AS is_rush_hour
  FROM (SELECT doc_id + doc_id // 2 + 1 AS doc_id FROM documents))"""


def hashed_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as frame contents, a language as a day."""
    return table(spark, sf_dir, "documents").select(
        F.col("lang").alias("fecha"), _file(F.col("doc_id")).alias("filename"), F.col("text").cast("binary").alias("content")
    )


HASHED = """hsh AS (
  SELECT lang AS fecha, printf('frame_%010d.jpg', doc_id) AS filename, md5(text) AS md5 FROM documents)"""


# ---- learning -----------------------------------------------------------------------------------

#: Vectors that are sent to every executor at most; more meet their rows in sorted partitions.
VECTORS_SENT = 20_000


def with_visual(rows: DataFrame, number: str, embeddings: DataFrame) -> DataFrame:
    """Add visual features: those of the embedding whose number equals that of the row, counted round.

    The rows themselves are never sent, small as they may look beside the vectors: their number grows without a bound.
    """
    vectors = max(embeddings.count(), 1)
    visual = [F.col("embedding")[i].cast("double").alias(name) for i, name in enumerate(VISUAL_FEATURES)]
    slim = embeddings.select(F.col("vec_id").alias("__vec"), *visual)
    slim = slim.hint("broadcast" if vectors <= VECTORS_SENT else "merge")
    return rows.withColumn("__vec", F.col(number) % vectors).join(slim, "__vec").drop("__vec")


#: The vector of a row in SQL; ``embeddings`` are numbered from 0 without gaps.
VECTOR_OF = "{} % (SELECT count(*) FROM embeddings) = vec_id"


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meta features of every detection with the visual features of an embedding."""
    rows = with_visual(detections(spark, sf_dir), "event_id", table(spark, sf_dir, "embeddings"))
    hour = F.col("hour")
    metas = {
        "is_rush_hour": F.col("is_rush_hour").cast("int"),
        "congestion_hour_score": congestion_score(hour),
        "is_peak_hour": is_peak_hour(hour),
    }
    return rows.withColumns(metas).select(
        "event_id", "camera_id", F.to_date("ts").alias("fecha"), *META_FEATURES, *VISUAL_FEATURES, "estado"
    )


def frame_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visual features of frames, keyed by day and file name."""
    rows = with_visual(frames(spark, sf_dir), "doc_id", table(spark, sf_dir, "embeddings"))
    return rows.select("fecha", "filename", *VISUAL_FEATURES)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with predictions that are wrong now and then."""
    guess = (F.col("label") + (F.col("vec_id") % 7 == 0).cast("int")) % 10
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("label").cast("double").alias("label"), guess.cast("double").alias("prediction")
    )


PREDICTIONS = """prd AS (
  SELECT vec_id, CAST(label AS DOUBLE) AS label, CAST((label + CASE WHEN vec_id % 7 = 0 THEN 1 ELSE 0 END) % 10 AS DOUBLE) AS prediction
  FROM embeddings)"""

