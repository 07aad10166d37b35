import datetime as dt
import random
import threading
from types import SimpleNamespace

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from vialume.config import FEATURES
from vialume.operators import ml
from vialume.plans import standins

# Published confusion counts and measures: they must come out of the same counts.
CONFUSION = [
    ("FLUIDO", "FLUIDO", 193), ("FLUIDO", "DENSO", 7), ("DENSO", "FLUIDO", 18), ("DENSO", "DENSO", 132),
    ("DENSO", "COLAPSO", 5), ("COLAPSO", "DENSO", 8), ("COLAPSO", "COLAPSO", 25),
]
PUBLISHED = {"accuracy": 0.9021, "weightedPrecision": 0.9011, "weightedRecall": 0.9021, "f1": 0.9008}


def test_published_measures(spark):
    rows = [(t, p) for t, p, n in CONFUSION for _ in range(n)]
    preds = spark.createDataFrame(rows, "label string, prediction string")
    assert {(r.label, r.prediction, r.n) for r in ml.confusion_matrix(preds).collect()} == set(CONFUSION)
    got = ml.classification_metrics(preds).first().asDict()
    assert {k: round(v, 4) for k, v in got.items()} == PUBLISHED


def test_published_class_weights(spark):
    rows = [(s,) for s, n in (("FLUIDO", 1326), ("DENSO", 989), ("COLAPSO", 277)) for _ in range(n)]
    df = spark.createDataFrame(rows, "estado string")
    got = {r.estado: round(r.sample_weight, 4) for r in ml.class_weights(df).collect()}
    assert got == {"FLUIDO": 0.6516, "DENSO": 0.8736, "COLAPSO": 3.1191}
    total = ml.with_class_weights(df).agg(F.sum("sample_weight")).first()[0]
    assert total == pytest.approx(2592)


def test_a_missing_label_weighs_one_but_counts_as_a_class(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "estado string")
    got = {r.estado: r.sample_weight for r in ml.with_class_weights(df).collect()}
    assert got == {"a": 4 / (3 * 2), "b": 4 / 3, None: 1.0}


def test_split_by_day(spark):
    df = spark.createDataFrame([(d, i) for d in ("1", "2", "3") for i in range(10)], "fecha string, x int")
    train, test = ml.temporal_split(df)
    assert train.count() == 20 and {r.fecha for r in test.collect()} == {"3"}
    train, test = ml.temporal_split(df.filter("fecha = '1'"))
    assert train.count() + test.count() == 10 and train.count() > test.count()


def test_feature_vector_fills_gaps(spark):
    df = spark.createDataFrame([(1, None)], "a int, b double")
    row = ml.feature_vector(df, ["b", "missing", "a"]).select(vector_to_array("features").alias("v")).first()
    assert row.v == [0.0, 0.0, 1.0]


@pytest.fixture(scope="module")
def samples(spark):
    """Rows whose state follows the vehicle count."""
    rng = random.Random(4)
    rows = []
    for i in range(240):
        count = rng.randrange(15)
        state = "COLAPSO" if count >= 10 else "DENSO" if count >= 5 else "FLUIDO"
        values = {f: float(rng.random()) for f in FEATURES}
        values["vehicle_count"] = float(count)
        rows.append((dt.date(2024, 1, 1 + i % 3), state, *[values[f] for f in FEATURES]))
    schema = "fecha date, estado string, " + ", ".join(f"{f} double" for f in FEATURES)
    return ml.with_class_weights(spark.createDataFrame(rows, schema))


def test_train_store_load_score(spark, samples, tmp_path):
    train, test = ml.temporal_split(samples)
    model = ml.refit(train, {"trees": 20, "depth": 5}, str(tmp_path / "model"))
    loaded = ml.load_model(str(tmp_path / "model"))
    assert ml.feature_order(loaded) == list(FEATURES)
    measures = ml.evaluate(loaded, test)
    assert measures["accuracy"] > 0.7
    own = ml.classification_metrics(loaded.transform(test)).first().asDict()
    assert own == pytest.approx(measures)
    assert ml.top_features(model, spark, 3).first().feature == "vehicle_count"

    gaps = test.drop("estado").withColumn("minute", F.when(F.col("weekday") > 0.5, F.col("minute")))
    scored = ml.score(gaps, loaded).collect()
    assert len(scored) == test.count()
    assert {r.metodo for r in scored} == {"randomforest", "umbral"}
    for r in scored:
        assert (r.metodo == "umbral") == (r.minute is None)
        assert r.confianza == 1.0 if r.metodo == "umbral" else 1 / 3 < r.confianza <= 1.0


def test_without_a_model_the_thresholds_answer(spark, samples):
    assert {r.metodo for r in ml.score(samples, None).collect()} == {"umbral"}


def test_search_reports_every_setting(spark, samples):
    found = ml.cross_validate(samples, trees=(3, 5), depths=(2,), folds=2)
    report = ml.cv_report(found, spark).collect()
    assert {(r.num_trees, r.max_depth) for r in report} == {(3, 2), (5, 2)}
    assert sum(r.is_best for r in report) == 1
    best = next(r for r in report if r.is_best)
    assert ml.best_params(found) == {"trees": best.num_trees, "depth": 2}


def test_a_search_measures_what_a_cross_validator_measures(spark, samples):
    """The same folds, fits, means and choice, whatever order the fits end in."""
    rows, learner = samples.persist(), ml.forest(seed=7)
    grid = ParamGridBuilder().addGrid(learner.numTrees, [1, 4]).addGrid(learner.maxDepth, [1, 3]).build()
    parts = Pipeline(stages=[ml.label_indexer(), ml.feature_assembler(), learner])
    setting = {"estimator": parts, "estimatorParamMaps": grid, "numFolds": 3, "seed": 5, "parallelism": 4,
               "evaluator": MulticlassClassificationEvaluator(metricName="accuracy")}
    ours, plain = ml.FoldSearch(**setting), CrossValidator(**setting)
    ours._resetUid(plain.uid)
    got, want = ours.fit(rows), plain.fit(rows)
    assert got.avgMetrics == want.avgMetrics and got.stdMetrics == want.stdMetrics and len(set(got.avgMetrics)) > 1
    assert ml.best_params(got) == ml.best_params(want)
    assert got.bestModel.stages[-1].toDebugString == want.bestModel.stages[-1].toDebugString.replace(
        want.bestModel.stages[-1].uid, got.bestModel.stages[-1].uid)
    rows.unpersist()


def test_a_fold_does_not_wait_for_the_fold_before(spark, samples, monkeypatch):
    """One setting and two folds: both fits run at the same time."""
    plain, both, begun = Pipeline.fit, threading.Barrier(2), []

    def fit(self, dataset, params=None):
        begun.append(params)
        if len(begun) <= 2:
            both.wait(60)
        return plain(self, dataset, params)

    monkeypatch.setattr(Pipeline, "fit", fit)
    ml.cross_validate(samples, trees=(2,), depths=(2,), folds=2)
    assert len(begun) == 3 and not both.broken


def test_trees_in_groups_make_one_forest(spark, samples, tmp_path, monkeypatch):
    """Many rows: no fit holds more rows times trees than allowed; the forest has all trees, all unlike, and is stored and read as others are."""
    sizes, plain = [], RandomForestClassifier._fit

    def fit(self, dataset):
        sizes.append((self.getNumTrees(), self.getSeed()))
        return plain(self, dataset)

    monkeypatch.setattr(RandomForestClassifier, "_fit", fit)
    monkeypatch.setattr(ml.GroupedForest, "pairs", 240 * 6)
    model = ml.refit(samples, {"trees": 20, "depth": 5}, str(tmp_path / "model"))
    assert [n for n, _ in sizes] == [5, 5, 5, 5] and len({seed for _, seed in sizes}) == 4
    forest = model.stages[-1]
    assert forest.getNumTrees == 20 and len({t.toDebugString.split("\n", 1)[1] for t in forest.trees}) > 15
    assert sum(forest.featureImportances.toArray()) == pytest.approx(1)
    loaded = ml.load_model(str(tmp_path / "model"))
    assert loaded.stages[-1].getNumTrees == 20 and ml.best_params(SimpleNamespace(bestModel=loaded)) == {"trees": 20, "depth": 5}
    order = ["fecha", *FEATURES]
    got, again = (m.transform(samples).select(*order, vector_to_array("probability").alias("p")).orderBy(*order).collect() for m in (model, loaded))
    assert got == again
    assert ml.evaluate(loaded, samples)["accuracy"] > 0.8
    sizes.clear()
    monkeypatch.setattr(ml.GroupedForest, "pairs", 240 * 20)
    ml.fit(samples, trees=20, depth=5)
    assert sizes == [(20, ml.SEED)]


@pytest.mark.parametrize(("parts", "most", "want"), [(8, 100, 8), (40, 100, 20), (3, 100, 20), (40, 5_000, 1)])
def test_many_rows_are_not_dealt_again(spark, monkeypatch, parts, most, want):
    """Rows that lie in enough tasks stay where they are, in too many are put together; few rows and few tasks are dealt as ever."""
    monkeypatch.setattr(ml, "FIT_ROWS_MOST", most)
    rows = spark.range(0, 2_000, numPartitions=parts).withColumn("x", F.rand(1))
    with ml.kept_rows(rows) as kept:
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "InMemoryTableScan" in plan and kept.distinct().count() == 2_000
        assert ("RoundRobin" in plan) == (parts < 8)
        assert want == 1 or kept.rdd.getNumPartitions() == want
    assert not rows.is_cached


def test_a_fit_is_dealt_to_the_cores(spark):
    """Rows of one small file fill one task; a fit of many rows takes more, one of few rows stays as it is."""
    rows = spark.range(3 * ml.FIT_ROWS).coalesce(1)
    spread = ml.spread_rows(rows)
    assert spread.rdd.getNumPartitions() == 3 and spread.distinct().count() == 3 * ml.FIT_ROWS
    few = spark.range(ml.FIT_ROWS).coalesce(1)
    assert ml.spread_rows(few) is few


@pytest.mark.parametrize("vectors", [40, 20_001])
def test_rows_are_never_sent_to_meet_their_vectors(spark, tmp_path, vectors):
    """Few rows beside more vectors: the vectors are sent if their number is small, the rows never."""
    spark.range(30).write.parquet(str(tmp_path / "rows"))
    vector = F.array(*[(F.col("vec_id") + i).cast("float") for i in range(16)])
    spark.range(vectors).select(F.col("id").alias("vec_id"), vector.alias("embedding")).write.parquet(str(tmp_path / "vectors"))
    found = standins.with_visual(spark.read.parquet(str(tmp_path / "rows")), "id", spark.read.parquet(str(tmp_path / "vectors")))
    got = sorted((r["id"], r[standins.VISUAL_FEATURES[3]]) for r in found.collect())
    assert got == [(i, i + 3.0) for i in range(30)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BuildLeft" not in plan and ("BuildRight" in plan) == (vectors == 40)
