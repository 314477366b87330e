"""Model training, selection, evaluation and batch scoring with Spark ML.

Indexers and the assembler are fitted once, on the training rows only, and
applied to both sides (the indexer's label list is the only driver-side
state; its size is the column's cardinality, so only low-cardinality string
columns are indexed).  Metrics are computed as grouped aggregates of the
confusion counts, which equal the MLlib evaluators and have a SQL twin.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkdesk.operators.binned_forest import BinnedForestRegressor

# The metric names the classification reports log.
CLF_METRICS = ("f1", "weightedPrecision", "weightedRecall", "accuracy")


def hash_split(df: DataFrame, weights: Sequence[float], seed: int = 42,
               cols: Sequence[str] | None = None) -> list[DataFrame]:
    """Split rows by a seeded hash of ``cols`` (default: all columns).

    Unlike ``randomSplit`` there is no per-partition sort, and a row's side
    depends only on its values: the same on every run, under any partitioning
    and after a task retry.  Equal rows go to the same side.
    """
    cols = list(cols or df.columns)
    u = F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in cols]), F.lit(1 << 30)) / F.lit(float(1 << 30))
    total = float(sum(weights))
    out, lo = [], 0.0
    for i, w in enumerate(weights):
        hi = 1.0 if i == len(weights) - 1 else lo + w / total
        out.append(df.where((u >= F.lit(lo)) & (u < F.lit(hi))) if i < len(weights) - 1
                   else df.where(u >= F.lit(lo)))
        lo = hi
    return out


#: Partitions of a training frame: a parameter of the model, since trees depend on it.
TRAIN_PARTITIONS = 16


#: Training partitions up to which candidates are fitted side by side.
SIDE_BY_SIDE_PARTITIONS = 16


def spread(df: DataFrame, partitions: int = TRAIN_PARTITIONS) -> DataFrame:
    """Deal a training frame into a fixed number of partitions by a hash of the row, in a
    fixed order within each: fitted trees depend on the partitioning, so it must not
    follow the machine or the input's size.  Pass more ``partitions`` for a larger frame."""
    row = F.xxhash64(*df.columns)
    return df.withColumn("__row", row).repartition(partitions, "__row").sortWithinPartitions("__row").drop("__row")


def indexers(cols: Sequence[str], handle_invalid: str = "error") -> list[StringIndexer]:
    """``<col>_index`` by descending frequency, ties alphabetical.  ``handle_invalid``:
    'error' (unseen label fails), 'keep' (extra index) or 'skip' (drop the row)."""
    return [StringIndexer(inputCol=c, outputCol=f"{c}_index", stringOrderType="frequencyDesc",
                          handleInvalid=handle_invalid) for c in cols]


def assembler(features: Sequence[str], handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid=handle_invalid)


def learner(kind: str, label: str, seed: int = 42, **params):
    cls = {"rf_classifier": RandomForestClassifier, "rf_regressor": RandomForestRegressor,
           "gbt_classifier": GBTClassifier}[kind]
    return cls(labelCol=label, featuresCol="features", seed=seed, **params)


def pipeline(categorical: Sequence[str], features: Sequence[str], model) -> Pipeline:
    return Pipeline(stages=[*indexers(categorical), assembler(features), model])


def grid(model, values: Mapping[str, Sequence]) -> list:
    """Cross product of parameter values, e.g. ``{"maxDepth": [2, 3], "maxBins": [8, 16]}``."""
    b = ParamGridBuilder()
    for name, vals in values.items():
        b = b.addGrid(model.getParam(name), list(vals))
    return b.build()


def select_model(estimator, model, values: Mapping[str, Sequence], evaluator, train: DataFrame,
                 train_ratio: float = 0.8, seed: int = 42, parallelism: int = 2):
    """One train/validation split over the grid, best candidate refitted on all
    of ``train``.  ``train`` should be cached by the caller when the grid is large."""
    tvs = TrainValidationSplit(estimator=estimator, estimatorParamMaps=grid(model, values),
                               evaluator=evaluator, trainRatio=train_ratio, seed=seed,
                               parallelism=parallelism)
    return tvs.fit(train)


def select_on_features(feature_stages: Sequence, model, values: Mapping[str, Sequence], evaluator,
                       train: DataFrame, train_ratio: float = 0.8, seed: int = 42,
                       parallelism: int = 4, partitions: int = TRAIN_PARTITIONS):
    """Grid selection with the feature stages outside the grid.

    The indexers and the assembler are fitted once on ``train``; only the
    ``(label, features)`` columns are kept and cached, and every candidate
    fits just the learner on them (TrainValidationSplit caches its own
    80/20 split of that narrow frame).  Returns ``(pipeline_model, tvs_model)``:
    the feature stages followed by the best learner, refitted on all of ``train``.

    ``parallelism`` holds for up to ``SIDE_BY_SIDE_PARTITIONS``.  A larger frame fills the cluster with
    one candidate's tasks, and each forest keeps its own bagged copy of all rows while it is
    fitted: side by side these copies would push each other out of memory.

    Candidates of a regression forest share one pass over the rows (``binned_forest``).
    """
    if isinstance(model, RandomForestRegressor):
        model = BinnedForestRegressor.of(model)
    parallelism = parallelism if partitions <= SIDE_BY_SIDE_PARTITIONS else 1
    feats = Pipeline(stages=list(feature_stages)).fit(train)
    narrow = spread(feats.transform(train).select(model.getLabelCol(), "features"), partitions) \
        .persist(StorageLevel.MEMORY_AND_DISK)
    try:
        tvs = select_model(model, model, values, evaluator, narrow, train_ratio, seed, parallelism)
    finally:
        narrow.unpersist()
    return PipelineModel(stages=[*feats.stages, tvs.bestModel]), tvs


def classifier_evaluator(label: str, metric: str = "f1") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName=metric)


def regression_evaluator(label: str, metric: str = "rmse") -> RegressionEvaluator:
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName=metric)


def classification_metrics(pred: DataFrame, label: str, prediction: str = "prediction",
                           scale: int = 10) -> DataFrame:
    """``(metric, value)`` rows: accuracy, weightedPrecision, weightedRecall, f1.

    Same definitions as MLlib's multiclass metrics: per true class c with n_c
    rows, precision_c = tp_c / predicted_c (0 when nothing was predicted c),
    recall_c = tp_c / n_c, weights n_c / N.  Two small aggregates over the
    confusion counts (classes x classes rows), no collect.
    """
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    conf = pred.groupBy(y.alias("y"), p.alias("p")).agg(F.count(F.lit(1)).alias("n"))
    truth = conf.groupBy(F.col("y").alias("c")).agg(F.sum("n").alias("n_c"),
                                                      F.sum(F.when(F.col("y") == F.col("p"), F.col("n"))
                                                            .otherwise(0)).alias("tp"))
    guessed = conf.groupBy(F.col("p").alias("c")).agg(F.sum("n").alias("pred_c"))
    per = truth.join(guessed, "c", "left").fillna(0, ["pred_c"])
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("pred_c").cast("double")), F.lit(0.0))
    rec = F.col("tp").cast("double") / F.col("n_c").cast("double")
    f1 = F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0))
    w = F.col("n_c").cast("double")
    agg = per.agg((F.sum("tp").cast("double") / F.sum("n_c").cast("double")).alias("accuracy"),
                  (F.sum(w * prec) / F.sum(w)).alias("weightedPrecision"),
                  (F.sum(w * rec) / F.sum(w)).alias("weightedRecall"),
                  (F.sum(w * f1) / F.sum(w)).alias("f1"))
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.round(F.col(m), scale).alias("value"))
        for m in CLF_METRICS[::-1]])).alias("m")).select("m.*")


def rmse(pred: DataFrame, label: str, prediction: str = "prediction", scale: int = 6) -> DataFrame:
    """One row ``(metric='rmse', value)`` in double; rows where either side is NULL count
    neither as an error nor as a row.  NULL without any row."""
    d = F.col(label).cast("double") - F.col(prediction).cast("double")
    return pred.agg(F.round(F.sqrt(F.avg(d * d)), scale).alias("value")).select(F.lit("rmse").alias("metric"), "value")


def model_report(spark: SparkSession, model: PipelineModel, metrics: Mapping[str, float] | None = None,
                 run_id: str = "run") -> DataFrame:
    """Chosen parameters and run metrics as a ``(run_id, kind, name, value)`` table
    (what a tracking server would log): stages, input columns, features, the
    learner's depth/bins/iterations, and the given metrics."""
    rows = []
    for i, st in enumerate(model.stages):
        rows.append(("param", f"stage_{i}", type(st).__name__))
        if st.hasParam("inputCols") and st.isDefined("inputCols"):
            rows.append(("param", f"stage_{i}_inputs", ",".join(st.getOrDefault("inputCols"))))
        elif st.hasParam("inputCol") and st.isDefined("inputCol"):
            rows.append(("param", f"stage_{i}_input", st.getOrDefault("inputCol")))
    last = model.stages[-1]
    for name in ("maxDepth", "maxBins", "maxIter", "numTrees", "minInfoGain"):
        if last.hasParam(name) and last.isDefined(name):
            rows.append(("param", name, str(last.getOrDefault(name))))
    for name, val in (metrics or {}).items():
        rows.append(("metric", name, repr(float(val))))
    return spark.createDataFrame([(run_id, *r) for r in rows], "run_id string, kind string, name string, value string")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def score(model_path: str, data: DataFrame, id_cols: Sequence[str]) -> DataFrame:
    """Load a saved pipeline and keep ``id_cols + [prediction]`` (one scan, no shuffle)."""
    model = PipelineModel.load(model_path)
    return model.transform(data).select(*id_cols, "prediction")
