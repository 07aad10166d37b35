"""Training, evaluation and use of the state classifier."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vialume.config import FEATURES
from vialume.functions.states import threshold_class

# The settings of the forest and of its search.
TREES, DEPTH, SEED = 200, 12, 42
GRID_TREES, GRID_DEPTHS, FOLDS = (100, 200), (8, 12), 5
TRAIN_SHARE = 0.8

FOREST = "randomforest"

# Rows that a task takes at least and at most when a forest is fitted.
FIT_ROWS, FIT_ROWS_MOST = 5_000, 500_000

# Pairs of a row and a tree that all fits at one time hold. MLlib stores some 16 bytes for each: the row's weight in the sample
# of the tree, and its node in three versions.
FIT_PAIRS = 400_000_000


def feature_vector(df: DataFrame, names: Sequence[str] = FEATURES, out: str = "features") -> DataFrame:
    """Assemble the features in order; missing columns and nulls become 0."""
    filled = {n: F.coalesce(F.col(n).cast("double"), F.lit(0.0)) if n in df.columns else F.lit(0.0) for n in names}
    prepared = df.withColumns({f"__f{i}": c for i, c in enumerate(filled.values())})
    vector = VectorAssembler(inputCols=[f"__f{i}" for i in range(len(names))], outputCol=out)
    return vector.transform(prepared).select(*df.columns, out)


def class_weights(df: DataFrame, label: str = "estado") -> DataFrame:
    """Balanced weight of each label: rows over (labels x rows with the label).

    A missing label counts as one of the labels.
    """
    counted = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy(F.lit(0))  # over the few label rows
    weight = F.sum("n").over(everything) / (F.count(F.lit(1)).over(everything) * F.col("n"))
    return counted.withColumn("sample_weight", weight)


def with_class_weights(df: DataFrame, label: str = "estado") -> DataFrame:
    """Add ``sample_weight``; rows without a label weigh 1.

    The broadcast side has a row per class, and the forest takes a hundred classes at most.
    """
    weights = class_weights(df, label).select(label, "sample_weight")
    joined = df.join(F.broadcast(weights), label, "left")
    return joined.select(*df.columns, F.coalesce("sample_weight", F.lit(1.0)).alias("sample_weight"))


def temporal_split(df: DataFrame, day: str = "fecha") -> tuple[DataFrame, DataFrame]:
    """(train, test): the newest day is the test; a single day is split at random, 80 to 20."""
    first, last = df.agg(F.min(day), F.max(day)).first()
    if first == last:
        train, test = df.randomSplit([TRAIN_SHARE, 1 - TRAIN_SHARE], seed=SEED)
        return train, test
    return df.filter(F.col(day) != last), df.filter(F.col(day) == last)


def label_indexer(col: str = "estado", out: str = "label") -> StringIndexer:
    """Label numbers by falling frequency."""
    return StringIndexer(inputCol=col, outputCol=out, stringOrderType="frequencyDesc")


def feature_assembler(names: Sequence[str] = FEATURES, out: str = "features") -> VectorAssembler:
    """Feature vector in order; rows with a null or NaN are skipped."""
    return VectorAssembler(inputCols=list(names), outputCol=out, handleInvalid="skip")


class GroupedForest(RandomForestClassifier):
    """A random forest whose trees are grown in groups if the rows are many.

    MLlib grows all trees at once and stores a weight and nodes for every row and tree. The trees of a forest do not know of
    each other, so a group of them is a forest of its own, with its own seed, and what a group stored is gone before
    the next one begins. All trees make one model. ``pairs`` is the number of rows times trees in a group.
    """

    pairs = FIT_PAIRS

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        trees = self.getNumTrees()
        groups = min(trees, -(-trees * dataset.count() // self.pairs))
        if groups <= 1:
            return super()._fit(dataset)
        jvm, found = dataset.sparkSession.sparkContext._jvm, []
        for k in range(groups):
            size = trees * (k + 1) // groups - trees * k // groups
            part = self.copy({self.numTrees: size, self.seed: self.getSeed() + 1_000_003 * k})
            found.append(super(GroupedForest, part)._fit(dataset))
            jvm.System.gc()  # the files of a shuffle stay until the driver has collected the garbage of its job
        return self._copyValues(joined_forest(found))


def joined_forest(parts: Sequence[RandomForestClassificationModel]) -> RandomForestClassificationModel:
    """One forest of the trees of several that were fitted to the same rows."""
    context = SparkSession.active().sparkContext
    kinds = context._jvm.org.apache.spark.ml.classification
    trees = [tree for part in parts for tree in part._java_obj.trees()]
    array = context._gateway.new_array(kinds.DecisionTreeClassificationModel, len(trees))
    for i, tree in enumerate(trees):
        array[i] = tree
    first = parts[0]
    return RandomForestClassificationModel(kinds.RandomForestClassificationModel(first.uid, array, first.numFeatures, first.numClasses))


def forest(trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> RandomForestClassifier:
    """Weighted random forest."""
    return GroupedForest(
        labelCol="label", featuresCol="features", weightCol="sample_weight",
        numTrees=trees, maxDepth=depth, featureSubsetStrategy="sqrt", seed=seed, cacheNodeIds=True,
    )


def pipeline(names: Sequence[str] = FEATURES, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> Pipeline:
    return Pipeline(stages=[label_indexer(), feature_assembler(names), forest(trees, depth, seed)])


def spread_rows(df: DataFrame, cores: int | None = None, rows: int | None = None) -> DataFrame:
    """Training rows dealt to the cores. A fit takes long for its few bytes, so it has more tasks than the size of its rows asks for.

    Not to many more: every task of a fit sends the counts of all open nodes. Few rows stay as they are. ``cores`` is what
    one of several fits at a time may take.
    """
    rows = df.count() if rows is None else rows
    cores = cores or df.sparkSession.sparkContext.defaultParallelism
    tasks = max(min(cores, -(-rows // FIT_ROWS)), -(-rows // FIT_ROWS_MOST))
    return df.repartition(tasks) if tasks > 1 else df


@contextmanager
def kept_rows(df: DataFrame, cores: int | None = None) -> Iterator[DataFrame]:
    """Training rows, made once and kept for the stages that read them.

    They are dealt to the cores, but for many rows that lie in enough tasks already: dealing these would sort and store them all once more.
    """
    rows, every = df.count(), df.sparkSession.sparkContext.defaultParallelism
    kept, found = None, 0
    if rows > every * FIT_ROWS_MOST:
        kept = df.persist()
        found = kept.rdd.getNumPartitions()
    if found >= every:
        most = -(-rows // FIT_ROWS_MOST)
        spread = kept.coalesce(most) if found > most else kept
    else:
        if kept:
            kept.unpersist()
        kept = spread = spread_rows(df, cores, rows).persist()
    try:
        yield spread
    finally:
        kept.unpersist()


def fit(df: DataFrame, names: Sequence[str] = FEATURES, trees: int = TREES, depth: int = DEPTH) -> PipelineModel:
    """Fit the forest; its input is made once and kept while the stages read it."""
    with kept_rows(df) as rows:
        return pipeline(names, trees, depth).fit(rows)


class FoldSearch(CrossValidator):
    """A cross validation whose fits of all folds wait in one line, the longest first.

    Folds, fits, measures and the choice are those of ``CrossValidator``. That one begins a fold when the last fit of the fold
    before has ended, and most cores idle meanwhile. The folds are read from the kept input and not stored once more.
    """

    def _fit(self, dataset: DataFrame) -> CrossValidatorModel:
        learner, judge, grid = self.getEstimator(), self.getEvaluator(), self.getEstimatorParamMaps()
        folds = self._kFold(dataset)
        found = np.zeros((len(folds), len(grid)))

        def measure(job: tuple[int, int]) -> None:
            (train, held_out), setting = folds[job[0]], grid[job[1]]
            found[job] = judge.evaluate(learner.fit(train, setting).transform(held_out))

        def length(job: tuple[int, int]) -> int:
            values = {p.name: v for p, v in grid[job[1]].items()}
            return values["numTrees"] * values["maxDepth"]

        jobs = sorted(np.ndindex(found.shape), key=length, reverse=True)
        with ThreadPool(min(self.getParallelism(), len(jobs))) as pool:
            pool.map(inheritable_thread_target(dataset.sparkSession)(measure), jobs, chunksize=1)
        metrics, spread = self._gen_avg_and_std_metrics(found.tolist())
        best = learner.fit(dataset, grid[np.argmax(metrics) if judge.isLargerBetter() else np.argmin(metrics)])
        return self._copyValues(CrossValidatorModel(best, metrics, None, spread))


def cross_validate(
    df: DataFrame,
    names: Sequence[str] = FEATURES,
    trees: Sequence[int] = GRID_TREES,
    depths: Sequence[int] = GRID_DEPTHS,
    folds: int = FOLDS,
    parallelism: int = 4,
) -> CrossValidatorModel:
    """Search trees and depth by accuracy over the folds. The input is kept for the many fits."""
    learner = forest()
    learner.pairs = FIT_PAIRS // parallelism
    grid = ParamGridBuilder().addGrid(learner.numTrees, list(trees)).addGrid(learner.maxDepth, list(depths)).build()
    search = FoldSearch(
        estimator=Pipeline(stages=[label_indexer(), feature_assembler(names), learner]),
        estimatorParamMaps=grid,
        evaluator=MulticlassClassificationEvaluator(metricName="accuracy"),
        numFolds=folds, seed=SEED, parallelism=parallelism,
    )
    share = max(2, df.sparkSession.sparkContext.defaultParallelism // parallelism)
    with kept_rows(df, share) as rows:
        return search.fit(rows)


def cv_report(model: CrossValidatorModel, spark: SparkSession) -> DataFrame:
    """Mean accuracy of each setting, and which one is best. One row per setting."""
    best = max(range(len(model.avgMetrics)), key=model.avgMetrics.__getitem__)
    rows = []
    for i, (setting, metric) in enumerate(zip(model.getEstimatorParamMaps(), model.avgMetrics)):
        values = {p.name: v for p, v in setting.items()}
        rows.append((int(values["numTrees"]), int(values["maxDepth"]), float(metric), i == best))
    return spark.createDataFrame(rows, "num_trees int, max_depth int, avg_accuracy double, is_best boolean")


def best_params(model: CrossValidatorModel) -> dict[str, int]:
    learner = model.bestModel.stages[-1]
    return {"trees": learner.getNumTrees, "depth": learner.getOrDefault("maxDepth")}


def confusion_matrix(preds: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return preds.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n")).orderBy(label, prediction)


def classification_metrics(preds: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy and the three measures weighted by the true class sizes.

    All follow from the confusion counts; the predictions are reduced to these first.
    """
    cells = preds.groupBy(F.col(label).alias("t"), F.col(prediction).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("t").alias("c"), F.col("n").alias("true"), F.lit(0).cast("long").alias("pred"), hit.cast("long").alias("hit")),
        F.struct(F.col("p").alias("c"), F.lit(0).cast("long").alias("true"), F.col("n").alias("pred"), F.lit(0).cast("long").alias("hit")),
    )
    per_class = cells.select(F.inline(sides)).groupBy("c").agg(*[F.sum(x).alias(x) for x in ("true", "pred", "hit")])
    recall = F.when(F.col("true") > 0, F.col("hit") / F.col("true")).otherwise(0.0)
    precision = F.when(F.col("pred") > 0, F.col("hit") / F.col("pred")).otherwise(0.0)
    f1 = F.when(F.col("hit") > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0)
    total = F.sum("true")
    return per_class.agg(
        (F.sum("hit") / total).alias("accuracy"),
        (F.sum(precision * F.col("true")) / total).alias("weightedPrecision"),
        (F.sum(recall * F.col("true")) / total).alias("weightedRecall"),
        (F.sum(f1 * F.col("true")) / total).alias("f1"),
    )


def evaluate(model: PipelineModel, test: DataFrame) -> dict[str, float]:
    """The four metrics of a model on a test set, from its confusion counts."""
    return classification_metrics(model.transform(test)).first().asDict()


def top_features(model: PipelineModel, spark: SparkSession, n: int = 10, names: Sequence[str] = FEATURES) -> DataFrame:
    """The ``n`` most important features."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = spark.createDataFrame([(f, float(w)) for f, w in zip(names, weights)], "feature string, importance double")
    return rows.orderBy(F.desc("importance"), "feature").limit(n)


def refit(df: DataFrame, params: dict[str, int], path: str, names: Sequence[str] = FEATURES) -> PipelineModel:
    """Fit the chosen setting on all rows and store it."""
    model = fit(df, names, params["trees"], params["depth"])
    save_model(model, path)
    return model


def save_model(model: PipelineModel, path: str) -> None:
    """Store the pipeline; it holds the label order and the feature order."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def publish_model(model: PipelineModel, root: str) -> int:
    """Store a model as the next version under ``root``; it counts from the moment its line is written."""
    spark = SparkSession.active()
    version = published_version(spark, root) + 1
    model.write().overwrite().save(f"{root}/version={version}")
    spark.createDataFrame([(version,)], "version int").coalesce(1).write.mode("overwrite").json(f"{root}/published/n={version}")
    return version


def published_version(spark: SparkSession, root: str) -> int:
    """The newest published version; 0 before the first one."""
    try:
        return spark.read.schema("version int").json(f"{root}/published").agg(F.max("version")).first()[0] or 0
    except AnalysisException:  # no such folder
        return 0


def load_version(root: str, version: int) -> PipelineModel | None:
    """A published model; none for version 0, so that the thresholds answer."""
    return load_model(f"{root}/version={version}") if version else None


def feature_order(model: PipelineModel) -> list[str]:
    return list(model.stages[1].getInputCols())


def score(df: DataFrame, model: PipelineModel | None = None, count: str = "vehicle_count") -> DataFrame:
    """Add state, confidence and method.

    The model answers for rows that have all its features. The thresholds answer for the others,
    and for all rows when there is no model.
    """
    outputs = ("estado", "confianza", "metodo")
    base = df.drop(*outputs)
    rule = threshold_class(F.col(count))
    if model is None:
        return base.withColumn("__c", rule).select(*base.columns, "__c.*")
    names, labels = feature_order(model), list(model.stages[0].labels)
    complete = F.lit(True)
    for n in names:
        value = F.col(n).cast("double") if n in base.columns else F.lit(None).cast("double")
        complete = complete & value.isNotNull() & ~F.isnan(value)
    learner = model.stages[-1]
    vector = feature_vector(base.withColumn("__complete", complete), names, learner.getFeaturesCol())
    scored = learner.transform(vector)
    state = F.element_at(F.array(*[F.lit(s) for s in labels]), F.col(learner.getPredictionCol()).cast("int") + 1)
    certainty = F.array_max(vector_to_array(learner.getProbabilityCol()))
    learned = F.struct(state.alias("estado"), certainty.alias("confianza"), F.lit(FOREST).alias("metodo"))
    choice = F.when(F.col("__complete"), learned).otherwise(rule)
    return scored.withColumn("__c", choice).select(*base.columns, "__c.*")
