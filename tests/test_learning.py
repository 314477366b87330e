import math

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator

from sparkdesk.operators import learning as ml


def test_classification_metrics_equal_evaluator(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 3, 400).astype(float)
    p = np.where(rng.random(400) < 0.6, y, rng.integers(0, 4, 400)).astype(float)  # class 3 never true
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "label double, prediction double")
    got = {r.metric: r.value for r in ml.classification_metrics(df, "label", scale=12).collect()}
    for m in ml.CLF_METRICS:
        ev = MulticlassClassificationEvaluator(labelCol="label", metricName=m).evaluate(df)
        assert math.isclose(got[m], ev, abs_tol=1e-10), m


def test_rmse_equals_evaluator(spark):
    df = spark.createDataFrame([(10.25, 9.5), (3.0, 4.75), (100.0, 90.01)], "y double, prediction double")
    got = ml.rmse(df, "y", scale=12).first().value
    assert math.isclose(got, RegressionEvaluator(labelCol="y").evaluate(df), rel_tol=1e-12)


def test_string_indexer_frequency_then_alphabetical(spark):
    df = spark.createDataFrame([("m",), ("f",), ("f",), ("m",), ("x",)], "sex string")
    idx = ml.indexers(["sex"])[0].fit(df)
    assert idx.labels == ["f", "m", "x"]


def test_fit_save_load_score_same_predictions(spark, tmp_dir):
    from sparkdesk.plans import learning as L
    model, pred = L._fit_predict(spark, "/root/testdata/sf0.001", "rf_classifier", L.CLF_LABEL,
                                 L.CLF_FEATURES, numTrees=3, maxDepth=3)
    ml.save_model(model, tmp_dir + "/m")
    # (l_orderkey, l_linenumber) is not unique in lineitem: compare multisets of rows
    test_rows = L.split(spark, "/root/testdata/sf0.001")[1]
    again = ml.score(tmp_dir + "/m", test_rows.drop(L.CLF_LABEL), [*L.IDS, "l_quantity", "l_extendedprice"])
    first = model.transform(test_rows).select(*L.IDS, "l_quantity", "l_extendedprice", "prediction")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, first.collect()))
    assert set(pred.columns) == {*L.IDS, L.CLF_LABEL, "prediction"}


def test_selection_report(spark):
    from sparkdesk.plans import learning as L
    rows = L.train_report(spark, "/root/testdata/sf0.001").collect()
    assert {"maxDepth", "maxBins", "accuracy", "f1", "stage_1_inputs"} <= {r.name for r in rows}
    assert all(r.as_expected for r in rows)


def test_constant_predictions_fail_the_checks(spark):
    from pyspark.sql import functions as F

    from sparkdesk.plans import learning as L
    test = L.split(spark, "/root/testdata/sf0.001")[1]
    mean = test.agg(F.avg(L.REG_LABEL)).first()[0]
    assert not L._summary(test.withColumn("prediction", F.lit(mean)), L.REG_LABEL).first().beats_constant
    for value in (0.0, 1.0):
        assert not L._summary(test.withColumn("prediction", F.lit(value)), L.CLF_LABEL).first().beats_constant


def test_hash_split_is_partition_independent_and_complete(spark):
    from sparkdesk.operators.learning import hash_split
    df = spark.range(0, 5000).selectExpr("id", "id % 7 AS g")
    a1, b1 = hash_split(df, [0.8, 0.2], seed=7)
    a2, b2 = hash_split(df.repartition(13), [0.8, 0.2], seed=7)
    ids = lambda d: sorted(r.id for r in d.select("id").collect())
    assert ids(a1) == ids(a2) and ids(b1) == ids(b2)
    assert sorted(ids(a1) + ids(b1)) == list(range(5000))
    assert 0.75 < len(ids(a1)) / 5000 < 0.85
    parts = hash_split(df, [1, 1, 2], seed=3)
    assert sum(p.count() for p in parts) == 5000


@pytest.mark.parametrize("partitions, side_by_side", [(4, 3), (ml.SIDE_BY_SIDE_PARTITIONS + 1, 1)])
def test_large_frames_fit_one_candidate_at_a_time(spark, monkeypatch, partitions, side_by_side):
    """A forest's bagged copy of a large frame has the cluster's memory to itself; all candidates are fitted."""
    asked, select = [], ml.select_model
    monkeypatch.setattr(ml, "select_model", lambda *a: asked.append(a[-1]) or select(*a))
    train = spark.createDataFrame([(float(i % 5), float(i % 5 > 2)) for i in range(100)], "x double, y double")
    _, tvs = ml.select_on_features([ml.assembler(["x"])], ml.learner("rf_regressor", "y", numTrees=2), {"maxDepth": [1, 2, 3]},
                                   ml.regression_evaluator("y"), train, parallelism=3, partitions=partitions)
    assert asked == [side_by_side] and len(tvs.validationMetrics) == 3
