"""ML jobs on lineitem: classification, price regression, train/validation selection over the
whole grids, save/load scoring and the metric reports.

The label is the line's net quantity, l_quantity * (1 - l_discount): itself for the
regression, and whether it exceeds ``LARGE`` for the classification, so the features can tell
it.  The split is plain arithmetic on the row's key.  Each job gives one summary row, whose
SQL twin knows the held-out rows, the number of candidates and the error of the best constant
prediction: a model that does no better than the constant by a stated margin fails.

Classifiers are fitted on a bounded sample of the labelled rows (``LABELLED_ROWS``), the
regressor on all of them; all held-out rows are predicted.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sparkdesk.operators import learning as ml
from sparkdesk.plans.registry import query
from sparkdesk.session import scratch_path, write_scratch
from sparkdesk.sources.tables import table

SEED = 42
IDS = ["l_orderkey", "l_linenumber"]
CATEGORICAL = ["l_linestatus"]
FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linestatus_index", "l_linenumber"]
CLF_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus_index", "l_linenumber"]
CLF_LABEL, REG_LABEL = "is_large", "net"
#: A line is large above this net quantity: somewhat less than half of them are.
LARGE = 25
#: Most labelled rows that a classifier is fitted on: the smallest by a hash of the key.
LABELLED_ROWS = 20_000
HELD_OUT = "(l_orderkey * 7 + l_linenumber * 3) % 10 >= 8"
TWO_INDEXED = ["l_linestatus", "l_shipmode_group"]
#: Training partitions of a bounded sample, and rows that one holds in a larger table.
SAMPLE_PARTITIONS, ROWS_A_PARTITION = 4, 50_000
#: What a model must leave of the best constant's error, at most.
SHARE_OF_CONSTANT = 0.5


def frame(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    net = F.col("l_quantity") * (1 - F.col("l_discount"))
    group = F.concat(F.lit("g"), (F.col("l_linenumber") % 3).cast("string"))
    return li.select(*IDS, "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus",
                     group.alias("l_shipmode_group"), net.alias(REG_LABEL), (net > LARGE).cast("double").alias(CLF_LABEL))


def split(spark, sf_dir, bounded=True):
    """(rows to fit on, all held-out rows, training partitions); the bound is for classifiers."""
    rows, test = frame(spark, sf_dir), F.expr(HELD_OUT)
    train = rows.where(~test)
    if bounded:
        return train.orderBy(F.xxhash64(*IDS), *IDS).limit(LABELLED_ROWS), rows.where(test), SAMPLE_PARTITIONS
    return train, rows.where(test), max(SAMPLE_PARTITIONS, -(-train.count() // ROWS_A_PARTITION))


def _summary(pred, label, **more):
    """One row: held-out rows, their label sum, whether predictions lie where the label can, and
    whether their error is at most ``SHARE_OF_CONSTANT`` of the best constant's."""
    p, y = F.col("prediction"), F.col(label)
    if label == CLF_LABEL:
        fits, error = p.isin(0.0, 1.0), F.avg((p != y).cast("double"))
        constant = F.least(F.avg(y), 1 - F.avg(y))
    else:
        fits, error = p.between(0.0, 100.0), F.sqrt(F.avg(F.pow(y - p, F.lit(2))))
        constant = F.stddev_pop(y)
    return pred.agg(F.count("*").alias("test_rows"), F.round(F.sum(y), 2).alias("label_sum"), F.round(constant, 6).alias("constant_error"),
                    F.bool_and(fits).alias("in_domain"), (error <= SHARE_OF_CONSTANT * constant).alias("beats_constant"),
                    *[F.lit(v).alias(k) for k, v in more.items()])


def _summary_sql(label, more=""):
    net = "(l_quantity * (1 - l_discount))"
    y = f"({net} > {LARGE})::INT::DOUBLE" if label == CLF_LABEL else net
    constant = f"least(avg({y}), 1 - avg({y}))" if label == CLF_LABEL else f"stddev_pop({y})"
    return f"""
SELECT count(*) AS test_rows, round(sum({y}), 2) AS label_sum, round({constant}, 6) AS constant_error, true AS in_domain,
       true AS beats_constant{more}
FROM lineitem WHERE {HELD_OUT}
"""


@query("features_encode", sql="""
WITH f AS (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment),
     r AS (SELECT c_mktsegment,
                  CAST(row_number() OVER (ORDER BY n DESC, c_mktsegment) - 1 AS DOUBLE) AS c_mktsegment_index
           FROM f)
SELECT c.c_custkey, c.c_mktsegment, r.c_mktsegment_index, CAST(c.c_nationkey AS INTEGER) AS c_nationkey
FROM customer c JOIN r ON c.c_mktsegment = r.c_mktsegment
""")
def features_encode(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment",
                                                  F.col("c_nationkey").cast("int").alias("c_nationkey"))
    idx = ml.indexers(["c_mktsegment"])[0].fit(cust)
    return idx.transform(cust).select("c_custkey", "c_mktsegment", "c_mktsegment_index", "c_nationkey")


VECTOR_COLUMNS = [f"x{i}" for i in range(len(CLF_FEATURES))]


@query("features_vector", sql="""
WITH f AS (SELECT l_linestatus, count(*) AS n FROM lineitem GROUP BY l_linestatus),
     r AS (SELECT l_linestatus, CAST(row_number() OVER (ORDER BY n DESC, l_linestatus) - 1 AS DOUBLE) AS i FROM f)
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS x0, CAST(l_extendedprice AS DOUBLE) AS x1,
       CAST(l_discount AS DOUBLE) AS x2, CAST(l_tax AS DOUBLE) AS x3, r.i AS x4, CAST(l_linenumber AS DOUBLE) AS x5
FROM lineitem JOIN r USING (l_linestatus)
""")
def features_vector(spark, sf_dir):
    """The assembled vector, given as one column for each element."""
    df = frame(spark, sf_dir)
    p = ml.Pipeline(stages=[*ml.indexers(CATEGORICAL), ml.assembler(CLF_FEATURES)]).fit(df)
    x = vector_to_array("features")
    return p.transform(df).select(*IDS, *[x[i].alias(c) for i, c in enumerate(VECTOR_COLUMNS)])


def _fit_predict(spark, sf_dir, kind, label, features, **params):
    train, test, partitions = split(spark, sf_dir, bounded=label == CLF_LABEL)
    # indexer fit, assembler and the tree learner each pass over the training rows
    train = ml.spread(train, partitions).persist(StorageLevel.MEMORY_AND_DISK)
    model = ml.pipeline(CATEGORICAL, features, ml.learner(kind, label, seed=SEED, **params)).fit(train)
    train.unpersist()
    return model, model.transform(test).select(*IDS, label, "prediction")


@query("rf_classify", sql=_summary_sql(CLF_LABEL))
def rf_classify(spark, sf_dir):
    return _summary(_fit_predict(spark, sf_dir, "rf_classifier", CLF_LABEL, CLF_FEATURES, maxDepth=5)[1], CLF_LABEL)


@query("rf_regress", sql=_summary_sql(REG_LABEL))
def rf_regress(spark, sf_dir):
    return _summary(_fit_predict(spark, sf_dir, "rf_regressor", REG_LABEL, FEATURES, maxDepth=7)[1], REG_LABEL)


@query("gbt_classify", sql=_summary_sql(CLF_LABEL))
def gbt_classify(spark, sf_dir):
    return _summary(_fit_predict(spark, sf_dir, "gbt_classifier", CLF_LABEL, CLF_FEATURES, maxIter=20, maxDepth=3)[1], CLF_LABEL)


#: The grids of the four selection jobs.
GRID_CLASSIFY = {"maxDepth": [2, 3, 4, 5], "maxBins": [2, 3, 4]}
GRID_REGRESS = {"maxDepth": [5, 6, 7, 8, 9], "maxBins": [4, 5, 6, 7]}
GRID_THREE = {"maxDepth": [2, 3, 4], "maxBins": [4, 5, 6], "minInfoGain": [0.05, 0.1, 0.15]}
GRID_BOOSTED = {"maxDepth": [3, 5], "maxIter": [20, 30], "maxBins": [16, 32]}


def _select(spark, sf_dir, kind, label, features, grid, evaluator, categorical=CATEGORICAL):
    train, test, partitions = split(spark, sf_dir, bounded=label == CLF_LABEL)
    best, tvs = ml.select_on_features([*ml.indexers(categorical), ml.assembler(features)], ml.learner(kind, label, seed=SEED),
                                      grid, evaluator, train, seed=SEED, partitions=partitions)
    return best, len(tvs.getEstimatorParamMaps()), best.transform(test)


def _select_job(spark, sf_dir, kind, label, features, grid, evaluator, categorical=CATEGORICAL):
    best, candidates, pred = _select(spark, sf_dir, kind, label, features, grid, evaluator, categorical)
    chosen = best.stages[-1]
    inside = all(chosen.getOrDefault(name) in values for name, values in grid.items())
    return _summary(pred, label, candidates=candidates, chosen_in_grid=inside)


def _select_sql(label, candidates):
    return _summary_sql(label, f", {candidates} AS candidates, true AS chosen_in_grid")


@query("select_rf_classify", sql=_select_sql(CLF_LABEL, 12))
def select_rf_classify(spark, sf_dir):
    return _select_job(spark, sf_dir, "rf_classifier", CLF_LABEL, CLF_FEATURES, GRID_CLASSIFY, ml.classifier_evaluator(CLF_LABEL, "f1"))


@query("select_rf_regress", sql=_select_sql(REG_LABEL, 20))
def select_rf_regress(spark, sf_dir):
    """The regressor's depth and bins by held-out rmse, on all training rows."""
    return _select_job(spark, sf_dir, "rf_regressor", REG_LABEL, FEATURES, GRID_REGRESS, ml.regression_evaluator(REG_LABEL))


@query("select_rf_three", sql=_select_sql(CLF_LABEL, 27))
def select_rf_three(spark, sf_dir):
    """Three parameters, two indexed columns."""
    return _select_job(spark, sf_dir, "rf_classifier", CLF_LABEL, [*CLF_FEATURES, "l_shipmode_group_index"], GRID_THREE,
                       ml.classifier_evaluator(CLF_LABEL, "f1"), categorical=TWO_INDEXED)


@query("select_gbt", sql=_select_sql(CLF_LABEL, 8))
def select_gbt(spark, sf_dir):
    return _select_job(spark, sf_dir, "gbt_classifier", CLF_LABEL, CLF_FEATURES, GRID_BOOSTED, ml.classifier_evaluator(CLF_LABEL, "f1"))


@query("train_report", sql="""
SELECT 'param' AS kind, unnest(['maxBins', 'maxDepth', 'minInfoGain', 'numTrees', 'stage_0', 'stage_0_input', 'stage_1', 'stage_1_inputs', 'stage_2']) AS name,
       true AS as_expected
UNION ALL SELECT 'metric', unnest(['accuracy', 'f1', 'weightedPrecision', 'weightedRecall']), true
""")
def train_report(spark, sf_dir):
    """What a tracked run logs, of the selection over a whole grid: each parameter against what
    the job was given, each metric against that of the best constant prediction."""
    best, _, pred = _select(spark, sf_dir, "rf_classifier", CLF_LABEL, CLF_FEATURES, GRID_CLASSIFY, ml.classifier_evaluator(CLF_LABEL, "f1"))
    pred = write_scratch(pred.select(CLF_LABEL, "prediction"), "run_predictions")
    metrics = {r["metric"]: r["value"] for r in ml.classification_metrics(pred, CLF_LABEL).collect()}
    report = ml.model_report(spark, best, metrics, run_id="tvs_rf")
    share = pred.agg(F.greatest(F.avg(CLF_LABEL), 1 - F.avg(CLF_LABEL))).first()[0]
    given = {**{k: [str(v) for v in vs] for k, vs in GRID_CLASSIFY.items()}, "minInfoGain": ["0.0"], "numTrees": ["20"],
             "stage_0": ["StringIndexerModel"], "stage_0_input": CATEGORICAL, "stage_1": ["VectorAssembler"],
             "stage_1_inputs": [",".join(CLF_FEATURES)], "stage_2": ["RandomForestClassificationModel"]}
    allowed = F.create_map(*[x for k, vs in given.items() for x in (F.lit(k), F.array(*[F.lit(v) for v in vs]))])
    value = F.col("value").try_cast("double")
    good = F.when(F.col("kind") == "metric", value.between(1 - SHARE_OF_CONSTANT * (1 - share), 1.0)).otherwise(
        F.coalesce(F.array_contains(allowed[F.col("name")], F.col("value")), F.lit(False)))
    return report.select("kind", "name", good.alias("as_expected"))


@query("score_batch", sql=_summary_sql(CLF_LABEL, ", true AS same_as_fitted"))
def score_batch(spark, sf_dir):
    """The held-out rows scored by a model that was saved and loaded, against the fitted one."""
    model, _ = _fit_predict(spark, sf_dir, "rf_classifier", CLF_LABEL, CLF_FEATURES, maxDepth=5)
    path = scratch_path(spark, "rf_model")
    ml.save_model(model, path)
    test = split(spark, sf_dir)[1]
    fitted = model.transform(test).select(*test.columns, F.col("prediction").alias("fitted"))
    both = write_scratch(ml.score(path, fitted, [*IDS, CLF_LABEL, "fitted"]), "scored")
    return _summary(both, CLF_LABEL, same_as_fitted=both.where("prediction <> fitted").isEmpty())


RULE_SQL = """
SELECT CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS DOUBLE) AS y,
       CAST(CASE WHEN l_discount >= 0.05 THEN 0 WHEN l_quantity > 25 THEN 1 ELSE 2 END AS DOUBLE) AS p
FROM lineitem
"""


def rule_predictions(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    y = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    p = F.when(F.col("l_discount") >= 0.05, 0).when(F.col("l_quantity") > 25, 1).otherwise(2)
    return li.select(y.cast("double").alias("y"), p.cast("double").alias("prediction"))


@query("clf_metrics", sql=f"""
WITH t AS ({RULE_SQL}),
conf AS (SELECT y, p, count(*) AS n FROM t GROUP BY y, p),
truth AS (SELECT y AS c, CAST(sum(n) AS DOUBLE) AS n_c,
                 CAST(sum(CASE WHEN y = p THEN n ELSE 0 END) AS DOUBLE) AS tp FROM conf GROUP BY y),
guessed AS (SELECT p AS c, CAST(sum(n) AS DOUBLE) AS pred_c FROM conf GROUP BY p),
per AS (SELECT t.n_c, t.tp, coalesce(t.tp / nullif(g.pred_c, 0), 0.0) AS prec, t.tp / t.n_c AS rec
        FROM truth t LEFT JOIN guessed g ON t.c = g.c),
per2 AS (SELECT *, coalesce(2 * prec * rec / nullif(prec + rec, 0), 0.0) AS f1 FROM per),
agg AS (SELECT sum(tp) / sum(n_c) AS accuracy, sum(n_c * prec) / sum(n_c) AS wp,
               sum(n_c * rec) / sum(n_c) AS wr, sum(n_c * f1) / sum(n_c) AS f1 FROM per2)
SELECT 'accuracy' AS metric, round(accuracy, 10) AS value FROM agg
UNION ALL SELECT 'weightedPrecision', round(wp, 10) FROM agg
UNION ALL SELECT 'weightedRecall', round(wr, 10) FROM agg
UNION ALL SELECT 'f1', round(f1, 10) FROM agg
""")
def clf_metrics(spark, sf_dir):
    return ml.classification_metrics(rule_predictions(spark, sf_dir), "y")


@query("reg_metrics", sql="""
SELECT 'rmse' AS metric,
       round(sqrt(CAST(sum((CAST(l_extendedprice AS DECIMAL(18,2)) - CAST(l_quantity * 2000.0 AS DECIMAL(18,2)))
                           * (CAST(l_extendedprice AS DECIMAL(18,2)) - CAST(l_quantity * 2000.0 AS DECIMAL(18,2))))
                       AS DOUBLE) / CAST(count(*) AS DOUBLE)), 6) AS value
FROM lineitem
""")
def reg_metrics(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    pred = li.select("l_extendedprice", (F.col("l_quantity") * F.lit(2000.0)).alias("prediction"))
    return ml.rmse(pred, "l_extendedprice")
