"""Queries over labels, frames, counts and metadata, and over their files."""

from __future__ import annotations

from pyspark.sql import functions as F

from vialume.config import FEATURES, LABEL_FIELDS
from vialume.operators import catalog, dedup, history, ml
from vialume.plans import standins as s
from vialume.plans.registry import query
from vialume.session import scratch_path
from vialume.sources import frames as frames_of
from vialume.sources import labels as files

LC = f"{s.LABELS}, {s.COUNTS}, {s.ENRICHED}"


def enriched(spark, sf_dir):
    return catalog.enrich_counts(s.labels(spark, sf_dir), s.counts(spark, sf_dir))


# ---- joins

@query("C1", f"WITH {LC} SELECT fecha, filename, estado, vehicle_count FROM enr")
def enrich_counts(spark, sf_dir):
    return enriched(spark, sf_dir).select("fecha", "filename", "estado", "vehicle_count")


@query("C2", f"WITH {s.LABELS}, {s.FRAMES} SELECT fecha, filename, estado FROM lab WHERE EXISTS (SELECT 1 FROM fra WHERE fra.fecha = lab.fecha AND fra.filename = lab.filename AND doc_id % 3 <> 0)")
def labels_with_frames(spark, sf_dir):
    stored = s.stored_frames(spark, sf_dir)
    return catalog.labels_with_frames(s.labels(spark, sf_dir), stored).select("fecha", "filename", "estado")


@query("C3", f"""WITH {s.FRAMES}, {s.META} SELECT fra.fecha, fra.filename, met.timestamp, weekday, weekday_name, hour, minute, is_rush_hour
  FROM fra LEFT JOIN met ON met.fecha = fra.fecha AND met.stem || '.jpg' = fra.filename""")
def frames_with_meta(spark, sf_dir):
    return catalog.frames_with_meta(s.frames(spark, sf_dir).drop("doc_id"), s.meta(spark, sf_dir))


@query("C4", f"WITH {s.LABELS}, {s.FRAMES} SELECT fecha, filename FROM fra WHERE filename NOT IN (SELECT filename FROM lab)")
def unlabelled_frames(spark, sf_dir):
    return catalog.unlabelled_frames(s.frames(spark, sf_dir), s.labels(spark, sf_dir)).select("fecha", "filename")


@query("C5", f"""WITH {s.LABELS} SELECT fecha, filename,
  CASE WHEN doc_id % 6 = 0 THEN 'COLAPSO' WHEN doc_id % 3 = 0 THEN 'DENSO' ELSE estado END AS estado FROM lab""")
def apply_relabels(spark, sf_dir):
    lab = s.labels(spark, sf_dir)
    number = F.regexp_extract("filename", r"(\d+)", 1).cast("bigint")
    first = lab.filter(number % 3 == 0).select("fecha", "filename", F.lit("DENSO").alias("estado"), F.lit(1).alias("seq"))
    second = lab.filter(number % 6 == 0).select("fecha", "filename", F.lit("COLAPSO").alias("estado"), F.lit(2).alias("seq"))
    return catalog.apply_relabels(lab, first.unionByName(second)).select("fecha", "filename", "estado")


# ---- filters and rows

@query("B13", f"WITH {LC} SELECT fecha, filename, vehicle_count FROM enr WHERE estado = 'FLUIDO' AND vehicle_count >= 7")
def suspicious_labels(spark, sf_dir):
    return catalog.suspicious_labels(enriched(spark, sf_dir)).select("fecha", "filename", "vehicle_count")


@query("B18 B13", f"WITH {LC} SELECT fecha, filename, vehicle_count FROM enr WHERE estado = 'FLUIDO' AND vehicle_count >= 3 AND fecha = '20240105'")
def suspicious_labels_of_day(spark, sf_dir):
    rows = catalog.suspicious_labels(enriched(spark, sf_dir), 3, "20240105")
    return rows.select("fecha", "filename", "vehicle_count")


@query("B16", f"""WITH {s.FRAMES}, {s.META} SELECT fra.fecha, fra.filename, coalesce(met.timestamp, replace(fra.filename, '.jpg', '')) AS timestamp,
  coalesce(CAST(weekday AS VARCHAR), '') AS weekday, coalesce(weekday_name, '') AS weekday_name, coalesce(CAST(hour AS VARCHAR), '') AS hour,
  coalesce(CAST(minute AS VARCHAR), '') AS minute, coalesce(CAST(is_rush_hour AS VARCHAR), '') AS is_rush_hour, 'FLUIDO' AS estado
  FROM fra LEFT JOIN met ON met.fecha = fra.fecha AND met.stem || '.jpg' = fra.filename""")
def label_rows(spark, sf_dir):
    return catalog.label_rows(s.frames(spark, sf_dir), s.meta(spark, sf_dir), F.lit("FLUIDO"))


@query("G1 B1 B10 B11 C2", f"""WITH {LC} SELECT fecha, filename, hour, CAST(weekday AS INTEGER) AS weekday, CAST(minute AS INTEGER) AS minute,
    CASE is_rush_hour WHEN 'True' THEN 1 ELSE 0 END AS is_rush_hour, coalesce(vehicle_count, 0) AS vehicle_count, {s.SCORE} AS congestion_hour_score,
    CAST(hour BETWEEN 11 AND 16 AS INTEGER) AS is_peak_hour, estado
  FROM (SELECT * REPLACE (CASE WHEN hour = '' THEN 0 ELSE CAST(hour AS INTEGER) END AS hour) FROM enr) WHERE doc_id % 3 <> 0""")
def build_catalog(spark, sf_dir):
    stored = s.stored_frames(spark, sf_dir)
    return catalog.build_catalog(enriched(spark, sf_dir), stored)


_FIRST, _LAST = "tramo1_rotonda_brightness_mean", FEATURES[-1]


@query("J9 G1 D3", f"""WITH {LC}, cat AS (SELECT fecha, filename, doc_id, CASE WHEN hour = '' THEN 0 ELSE CAST(hour AS INTEGER) END AS hour,
    coalesce(vehicle_count, 0) AS vehicle_count, estado FROM enr WHERE doc_id % 3 <> 0 AND doc_id IN (SELECT doc_id FROM documents)),
  row AS (SELECT fecha, filename, hour, vehicle_count, CAST(embedding[1] AS DOUBLE) AS {_FIRST}, CAST(embedding[15] AS DOUBLE) AS {_LAST}, estado
    FROM cat JOIN embeddings ON {s.VECTOR_OF.format('doc_id')})
  SELECT *, round(CAST((SELECT count(*) FROM row) AS DOUBLE) / ((SELECT count(DISTINCT estado) FROM row) * count(*) OVER (PARTITION BY estado)), 9) AS sample_weight FROM row""")
def training_table(spark, sf_dir):
    """Label files to catalogue to features to weights: the rows a model learns from."""
    known = catalog.build_catalog(enriched(spark, sf_dir), s.stored_frames(spark, sf_dir))
    rows = ml.with_class_weights(catalog.training_rows(known, s.frame_features(spark, sf_dir)))
    return rows.select("fecha", "filename", "hour", "vehicle_count", _FIRST, _LAST, "estado", F.round("sample_weight", 9).alias("sample_weight"))


@query("J9 J3 J6 G2")
def catalogue_forest(spark, sf_dir):
    """Confusion, on the newest day, of a forest fitted on the training table of the other days."""
    known = catalog.build_catalog(enriched(spark, sf_dir), s.stored_frames(spark, sf_dir))
    rows = ml.with_class_weights(catalog.training_rows(known, s.frame_features(spark, sf_dir)))
    train, test = ml.temporal_split(rows)
    return ml.confusion_matrix(ml.fit(train).transform(test))


@query("G1", f"""WITH {LC} SELECT fecha, filename, estado, vehicle_count FROM enr""")
def union_of_days(spark, sf_dir):
    rows = enriched(spark, sf_dir)
    with_count = rows.filter(F.col("vehicle_count").isNotNull()).select("fecha", "filename", "vehicle_count", "estado")
    without = rows.filter(F.col("vehicle_count").isNull()).select("estado", "filename", "fecha")
    return catalog.union_days([with_count, without]).select("fecha", "filename", "estado", "vehicle_count")


# ---- aggregates

@query("D11", f"""WITH {LC} SELECT fecha, count(*) AS n_rows, count(*) FILTER (vehicle_count IS NULL) AS n_errors,
  CAST(sum(vehicle_count) AS DOUBLE) / greatest(count(*), 1) AS avg_vehicles FROM enr GROUP BY fecha""")
def enrich_summary(spark, sf_dir):
    return history.enrich_summary(enriched(spark, sf_dir), errors=F.col("vehicle_count").isNull())


@query("D18", f"WITH {s.LABELS} SELECT DISTINCT fecha FROM lab")
def distinct_days(spark, sf_dir):
    return history.distinct_days(s.labels(spark, sf_dir))


@query("G3", "SELECT 'f' || (doc_id // 28) AS filename, CAST(arg_max(n_chars % 15, doc_id % 28) AS INTEGER) AS vehicle_count FROM documents GROUP BY doc_id // 28")
def merge_counts(spark, sf_dir):
    doc = F.col("doc_id")
    per_day = s.table(spark, sf_dir, "documents").select(
        (doc % 28).alias("fecha"), F.concat(F.lit("f"), F.floor(doc / 28).cast("string")).alias("filename"),
        (F.col("n_chars") % 15).cast("int").alias("vehicle_count"),
    )
    return catalog.merge_counts(per_day)


# ---- copies

@query("E2", f"""WITH {s.HASHED} SELECT fecha, filename, md5, min(filename) OVER (PARTITION BY fecha, md5) AS kept_name,
  filename <> min(filename) OVER (PARTITION BY fecha, md5) AS is_duplicate FROM hsh""")
def dedup_content(spark, sf_dir):
    return dedup.dedup_content(dedup.store_md5(s.hashed_frames(spark, sf_dir), scratch_path(spark, "hashes")))


@query("E2", f"WITH {s.HASHED} SELECT fecha, min(filename) AS filename, md5 FROM hsh GROUP BY fecha, md5")
def unique_frames(spark, sf_dir):
    return dedup.unique_frames(dedup.with_md5(s.hashed_frames(spark, sf_dir)))


@query("D14", f"WITH {s.HASHED} SELECT fecha, count(DISTINCT md5) AS n_unique, count(*) - count(DISTINCT md5) AS n_duplicates FROM hsh GROUP BY fecha")
def dedup_report(spark, sf_dir):
    return dedup.dedup_report(dedup.with_md5(s.hashed_frames(spark, sf_dir)))


# ---- files

@query("A1 A10", f"""WITH {LC} SELECT filename, timestamp, weekday, weekday_name, hour, minute, is_rush_hour, estado,
  coalesce(vehicle_count, 0) AS vehicle_count, fecha FROM enr""")
def labels_from_csv(spark, sf_dir):
    """Days with and without the count column, written and read back."""
    rows = enriched(spark, sf_dir)
    root = scratch_path(spark, "labels")
    files.write_labels(rows.filter(F.col("vehicle_count").isNotNull()), root, mode="append")
    short = rows.filter(F.col("vehicle_count").isNull()).select("fecha", *LABEL_FIELDS[:-1])
    short.hint("rebalance", "fecha").write.partitionBy("fecha").mode("append").csv(root, header=True)
    back = files.read_labels(spark, root, "fecha=*/*.csv")
    return back.select(*[F.coalesce(c, F.lit("")).alias(c) for c in LABEL_FIELDS[:-1]], "vehicle_count", "fecha")


_TWO_DAYS = ("20240103", "20240110")


@query("A10 C5", f"""WITH {LC}, new AS (SELECT fecha, filename, CASE WHEN fecha IN {_TWO_DAYS} AND hour = '' THEN 'COLAPSO'
    WHEN fecha IN {_TWO_DAYS} AND minute::INTEGER % 3 = 0 THEN 'DENSO' ELSE estado END AS estado, coalesce(vehicle_count, 0) AS vehicle_count FROM enr)
  SELECT *, 'csv' AS copy FROM new UNION ALL SELECT *, 'json' AS copy FROM new""")
def relabel_in_place(spark, sf_dir):
    """Two days are relabelled where they are stored; the CSV and the JSON copy stay in step."""
    root = scratch_path(spark, "catalogue")
    rows = enriched(spark, sf_dir).withColumn("vehicle_count", F.coalesce("vehicle_count", F.lit(0)))
    files.rewrite_days(rows, root)
    some = rows.filter(F.col("fecha").isin(*_TWO_DAYS))
    third = some.filter(F.col("minute").cast("int") % 3 == 0).select("fecha", "filename", F.lit("DENSO").alias("estado"), F.lit(1).alias("seq"))
    blank = some.filter(F.col("hour") == "").select("fecha", "filename", F.lit("COLAPSO").alias("estado"), F.lit(2).alias("seq"))
    files.relabel_in_place(spark, root, third.unionByName(blank))
    csv = files.read_labels(spark, f"{root}/csv", "fecha=*/*.csv").withColumn("copy", F.lit("csv"))
    lines = files.read_labels_json(spark, f"{root}/json", "fecha=*/*.json", lines=True).withColumn("copy", F.lit("json"))
    lines = lines.withColumn("vehicle_count", F.col("vehicle_count").cast("int"))
    columns = ["fecha", "filename", "estado", "vehicle_count", "copy"]
    return csv.select(*columns).unionByName(lines.select(*columns))


@query("A4 A10", f"WITH {LC} SELECT fecha, filename, estado, hour, CAST(vehicle_count AS VARCHAR) AS vehicle_count FROM enr")
def labels_from_json(spark, sf_dir):
    root = scratch_path(spark, "labels-json")
    files.write_labels(enriched(spark, sf_dir), root, fmt="json")
    back = files.read_labels_json(spark, root, "fecha=*/*.json", lines=True)
    return back.select("fecha", "filename", "estado", "hour", "vehicle_count")


@query("A2", f"WITH {s.COUNTS} SELECT * FROM cnt")
def counts_from_maps(spark, sf_dir):
    root = scratch_path(spark, "counts")
    files.write_counts(s.counts(spark, sf_dir), root)
    return files.read_counts(spark, root, "fecha=*/*.txt", lines=True)


@query("A3", f"""WITH {s.META} SELECT stem, CASE WHEN NOT bad THEN timestamp END AS timestamp, CASE WHEN NOT bad THEN hour END AS hour,
  CASE WHEN NOT bad THEN weekday_name END AS weekday_name, CASE WHEN NOT bad THEN is_rush_hour END AS is_rush_hour
  FROM (SELECT *, minute % 9 = 0 AS bad FROM met)""")
def parse_frame_meta(spark, sf_dir):
    text = F.to_json(F.struct("timestamp", "weekday", "weekday_name", "hour", "minute", "is_rush_hour"))
    broken = F.concat(F.lit("{"), text, F.lit("x"))
    texts = s.meta(spark, sf_dir).select("stem", F.when(F.col("minute") % 9 == 0, broken).otherwise(text).alias("value"))
    return files.parse_meta(texts).select("stem", "timestamp", "hour", "weekday_name", "is_rush_hour")


@query("A5", f"""WITH {s.FRAMES} SELECT fra.fecha, fra.filename, md5(coalesce(text, '') || chr(10)) AS md5, fra.filename IN (SELECT filename FROM fra WHERE doc_id % 2 = 0) AS even
  FROM fra JOIN documents USING (doc_id)""")
def frame_files(spark, sf_dir):
    """Frames as files in day folders: found by name, and read for their hash."""
    root = scratch_path(spark, "frames")
    texts = s.table(spark, sf_dir, "documents").select("doc_id", F.concat(F.coalesce("text", F.lit("")), F.lit("\n")).cast("binary").alias("content"))
    frames_of.write_frames(s.frames(spark, sf_dir).join(texts, "doc_id"), root)
    found = frames_of.read_frames(spark, root).select("fecha", "filename", F.md5("content").alias("md5"))
    listed = frames_of.list_frames(spark, root).select("filename")
    even = listed.where(F.regexp_extract("filename", r"(\d)\.jpg$", 1).cast("int") % 2 == 0).withColumn("even", F.lit(True))
    return found.join(even, "filename", "left").select("fecha", "filename", "md5", F.coalesce("even", F.lit(False)).alias("even"))
