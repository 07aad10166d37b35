"""Queries of the classifier: weights, split, training, evaluation, scoring."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from vialume.config import FEATURES
from vialume.operators import ml
from vialume.plans.registry import query
from vialume.plans.standins import DET, PREDICTIONS, SCORE, VECTOR_OF, detections, feature_rows, predictions
from vialume.session import scratch_path

WEIGHTS = """wei AS (SELECT estado, CAST((SELECT count(*) FROM det) AS DOUBLE) / ((SELECT count(DISTINCT estado) FROM det) * count(*)) AS sample_weight
  FROM det GROUP BY estado)"""


@query("D3", f"WITH {DET}, {WEIGHTS} SELECT estado, round(sample_weight, 9) AS sample_weight FROM wei")
def class_weights(spark, sf_dir):
    weights = ml.class_weights(detections(spark, sf_dir))
    return weights.select("estado", F.round("sample_weight", 9).alias("sample_weight"))


@query("D3", f"WITH {DET}, {WEIGHTS} SELECT event_id, estado, round(sample_weight, 9) AS sample_weight FROM det JOIN wei USING (estado)")
def with_class_weights(spark, sf_dir):
    rows = ml.with_class_weights(detections(spark, sf_dir).select("event_id", "estado"))
    return rows.withColumn("sample_weight", F.round("sample_weight", 9))


@query("D4", f"WITH {PREDICTIONS} SELECT label, prediction, count(*) AS n FROM prd GROUP BY label, prediction")
def confusion_matrix(spark, sf_dir):
    return ml.confusion_matrix(predictions(spark, sf_dir))


@query("D5", f"""WITH {PREDICTIONS}, c AS (SELECT DISTINCT label AS c FROM prd), n AS (SELECT c,
    (SELECT count(*) FROM prd WHERE label = c) AS t, (SELECT count(*) FROM prd WHERE prediction = c) AS p,
    (SELECT count(*) FROM prd WHERE label = c AND prediction = c) AS h FROM c),
  m AS (SELECT t, h, CASE WHEN p > 0 THEN CAST(h AS DOUBLE) / p ELSE 0 END AS pr, CAST(h AS DOUBLE) / t AS re FROM n)
  SELECT round(CAST(sum(h) AS DOUBLE) / sum(t), 9) AS accuracy, round(sum(pr * t) / sum(t), 9) AS "weightedPrecision",
    round(sum(re * t) / sum(t), 9) AS "weightedRecall", round(sum(CASE WHEN h > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END * t) / sum(t), 9) AS f1 FROM m""")
def classification_metrics(spark, sf_dir):
    row = ml.classification_metrics(predictions(spark, sf_dir))
    return row.select(*[F.round(c, 9).alias(c) for c in row.columns])


@query("G2", f"""WITH {DET} SELECT event_id, CASE WHEN CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM det) THEN 'test' ELSE 'train' END AS part FROM det""")
def temporal_split(spark, sf_dir):
    train, test = ml.temporal_split(detections(spark, sf_dir).withColumn("fecha", F.to_date("ts")))
    parts = [df.select("event_id", F.lit(name).alias("part")) for df, name in ((train, "train"), (test, "test"))]
    return parts[0].unionByName(parts[1])


@query("J1", f"""WITH {DET}, o AS (SELECT estado, CAST(row_number() OVER (ORDER BY count(*) DESC, estado) - 1 AS DOUBLE) AS label FROM det GROUP BY estado)
  SELECT event_id, estado, label FROM det JOIN o USING (estado)""")
def label_index(spark, sf_dir):
    det = detections(spark, sf_dir).select("event_id", "estado")
    return ml.label_indexer().fit(det).transform(det)


_ROW = f"""fea AS (SELECT event_id, hour, CAST(vehicle_count AS DOUBLE) AS vehicle_count, {SCORE} AS score, CAST(embedding[15] AS DOUBLE) AS last
  FROM det JOIN embeddings ON {VECTOR_OF.format('event_id')})"""


@query("J2", f"""WITH {DET}, {_ROW} SELECT event_id, 22 AS n, CAST(hour AS DOUBLE) AS first, vehicle_count AS count, last FROM fea WHERE event_id % 5 <> 0""")
def assembled_features(spark, sf_dir):
    rows = feature_rows(spark, sf_dir)
    gaps = rows.withColumn(FEATURES[-1], F.when(F.col("event_id") % 5 != 0, F.col(FEATURES[-1])))
    arrays = ml.feature_assembler().transform(gaps).select("event_id", vector_to_array("features").alias("v"))
    return _ends(arrays)


@query("B17", f"""WITH {DET}, {_ROW} SELECT event_id, 22 AS n, CAST(hour AS DOUBLE) AS first, vehicle_count AS count,
  CASE WHEN event_id % 5 <> 0 THEN last ELSE 0 END AS last FROM fea""")
def feature_vectors(spark, sf_dir):
    rows = feature_rows(spark, sf_dir)
    gaps = rows.withColumn(FEATURES[-1], F.when(F.col("event_id") % 5 != 0, F.col(FEATURES[-1])))
    return _ends(ml.feature_vector(gaps).select("event_id", vector_to_array("features").alias("v")))


def _ends(arrays):
    v = F.col("v")
    return arrays.select("event_id", F.size(v).alias("n"), v[0].alias("first"), v[4].alias("count"), v[21].alias("last"))


@query("J8 B12", f"WITH {DET} SELECT event_id, estado, 1.0::DOUBLE AS confianza, 'umbral' AS metodo FROM det")
def score_without_model(spark, sf_dir):
    return ml.score(detections(spark, sf_dir), None).select("event_id", "estado", "confianza", "metodo")


# ---- fits: no SQL can give these

def _training(spark, sf_dir):
    return ml.with_class_weights(feature_rows(spark, sf_dir))


@query("J3 J6 G2")
def forest_confusion(spark, sf_dir):
    """Confusion of the forest on the newest day."""
    train, test = ml.temporal_split(_training(spark, sf_dir))
    return ml.confusion_matrix(ml.fit(train).transform(test))


@query("J4 J5")
def cross_validation(spark, sf_dir):
    train, _ = ml.temporal_split(_training(spark, sf_dir))
    return ml.cv_report(ml.cross_validate(train), spark)


@query("F4 J6")
def top_features(spark, sf_dir):
    train, _ = ml.temporal_split(_training(spark, sf_dir))
    return ml.top_features(ml.fit(train), spark)


@query("J7 J8 A11")
def refit_and_score(spark, sf_dir):
    """Refit on all rows, store, load, score; rows with a gap are answered by the thresholds."""
    path = scratch_path(spark, "model")
    rows = _training(spark, sf_dir)
    ml.refit(rows, {"trees": ml.TREES, "depth": ml.DEPTH}, path)
    gaps = rows.withColumn(FEATURES[-1], F.when(F.col("event_id") % 5 != 0, F.col(FEATURES[-1])))
    return ml.score(gaps, ml.load_model(path)).select("event_id", "estado", "confianza", "metodo")


# ---- what can be said of the fits without repeating them: facts that SQL knows

_SPLIT = """prt AS (SELECT *, CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM det) AS tst FROM det)"""


def _small_forest(spark, sf_dir):
    """A small forest of the rows before the newest day, and the rows of that day."""
    train, test = ml.temporal_split(_training(spark, sf_dir))
    return ml.fit(train, trees=20, depth=6), test


@query("J3 J6 G2 J1", f"""WITH {DET}, {_SPLIT}, o AS (SELECT estado, CAST(row_number() OVER (ORDER BY count(*) DESC, estado) - 1 AS DOUBLE) AS label
    FROM prt WHERE NOT tst GROUP BY estado)
  SELECT label, count(*) AS n_rows, true AS mostly_right FROM prt JOIN o USING (estado) WHERE tst GROUP BY label""")
def forest_facts(spark, sf_dir):
    """Rows of the newest day by label number. The state follows the count, so the forest gets nine of ten of each label right."""
    model, test = _small_forest(spark, sf_dir)
    cells = ml.confusion_matrix(model.transform(test))
    right = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
    return cells.groupBy("label").agg(F.sum("n").alias("n_rows"), (right >= 0.9 * F.sum("n")).alias("mostly_right"))


@query("J3 D5", "SELECT 'accuracy' AS measure, true AS good UNION ALL SELECT 'weightedPrecision', true UNION ALL SELECT 'weightedRecall', true UNION ALL SELECT 'f1', true")
def forest_measures(spark, sf_dir):
    """The four measures of the forest on the newest day: all above 0.9 and none above 1."""
    model, test = _small_forest(spark, sf_dir)
    found = ml.classification_metrics(model.transform(test))
    rows = found.select(F.explode(F.create_map(*[x for c in found.columns for x in (F.lit(c), F.col(c))])).alias("measure", "value"))
    return rows.select("measure", F.col("value").between(0.9, 1.0).alias("good"))


@query("J4 J5", """SELECT t AS num_trees, d AS max_depth, true AS plausible, true AS one_best
  FROM (VALUES (2), (4)) a(t), (VALUES (2), (5)) b(d)""")
def search_facts(spark, sf_dir):
    """Every setting of a small search once, its accuracy a share; the best is the one with the highest."""
    train, _ = ml.temporal_split(_training(spark, sf_dir))
    report = ml.cv_report(ml.cross_validate(train, trees=(2, 4), depths=(2, 5), folds=2), spark)
    best = report.agg(F.max("avg_accuracy").alias("top"), F.sum(F.col("is_best").cast("int")).alias("n"))
    joined = report.join(F.broadcast(best))  # one row
    one = (F.col("n") == 1) & (~F.col("is_best") | (F.col("avg_accuracy") == F.col("top")))
    return joined.select("num_trees", "max_depth", F.col("avg_accuracy").between(0.5, 1.0).alias("plausible"), one.alias("one_best"))


@query("F4 J6", "SELECT 'vehicle_count' AS feature, true AS first, true AS whole")
def top_feature_facts(spark, sf_dir):
    """The count decides the state, so it leads; the shares of all features make one."""
    model, _ = _small_forest(spark, sf_dir)
    shares = ml.top_features(model, spark, n=len(FEATURES))
    whole = shares.agg((F.abs(F.sum("importance") - 1) < 1e-9).alias("whole"), F.max("importance").alias("top"))
    return shares.join(F.broadcast(whole)).where("feature = 'vehicle_count'").select(
        "feature", (F.col("importance") == F.col("top")).alias("first"), "whole")


@query("J7 J8 A11", f"""WITH {DET} SELECT CASE WHEN event_id % 5 = 0 THEN 'umbral' ELSE 'randomforest' END AS metodo, count(*) AS n_rows, true AS mostly_right
  FROM det GROUP BY ALL""")
def refit_facts(spark, sf_dir):
    """Refit, store, load and score: rows with a gap are answered by the thresholds, the others by the stored forest."""
    path = scratch_path(spark, "model")
    rows = _training(spark, sf_dir)
    ml.refit(rows, {"trees": 20, "depth": 6}, path)
    gaps = rows.withColumn(FEATURES[-1], F.when(F.col("event_id") % 5 != 0, F.col(FEATURES[-1]))).withColumn("known", F.col("estado"))
    scored = ml.score(gaps, ml.load_model(path))
    right = F.avg((F.col("known") == F.col("estado")).cast("double"))
    return scored.groupBy("metodo").agg(F.count(F.lit(1)).alias("n_rows"), (right >= 0.9).alias("mostly_right"))
