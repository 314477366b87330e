import numpy as np
import pytest
from pyspark.ml.wrapper import JavaEstimator

from sparkdesk.operators import binned_forest as bf
from sparkdesk.operators import learning as ml


@pytest.fixture(scope="module")
def rows(spark):
    """Label and vector of 2,000 rows: a number with as many values as rows, one with five, a category; some rows twice."""
    rng = np.random.default_rng(5)
    a, b, c = rng.normal(size=2000), rng.integers(0, 5, 2000), rng.integers(0, 4, 2000)
    y = np.round(10 * a + np.array([3, -5, 7, 0])[c] * b) + rng.integers(0, 3, 2000)
    data = [(float(p), float(q), f"c{r}", float(z)) for p, q, r, z in zip(a, b, c, y)]
    df = spark.createDataFrame(data + data[:50], "a double, b double, c string, y double").repartition(3, "a")
    feats = ml.Pipeline(stages=[*ml.indexers(["c"]), ml.assembler(["a", "b", "c_index"])]).fit(df)
    return feats.transform(df).select("y", "features").cache()


def trees(model):
    return model.toDebugString.split("\n", 1)[1]


@pytest.mark.parametrize("how", [dict(maxDepth=6, maxBins=7), dict(maxDepth=3), dict(maxDepth=0),
                                 dict(maxDepth=9, maxBins=5, minInstancesPerNode=20, minInfoGain=0.5, minWeightFractionPerNode=0.03)])
def test_trees_without_bootstrap_equal_mllib(rows, how):
    model = ml.learner("rf_regressor", "y", numTrees=1, bootstrap=False, **how)
    want, got = model.fit(rows), bf.BinnedForestRegressor.of(model).fit(rows)
    assert trees(got) == trees(want) and got.totalNumNodes == want.totalNumNodes
    assert np.allclose(got.featureImportances.toArray(), want.featureImportances.toArray())
    assert got.getMaxDepth() == how["maxDepth"] and got.numFeatures == 3 and got.getNumTrees == 1


def test_forest_is_as_good_as_mllib(rows):
    model, rmse = ml.learner("rf_regressor", "y", maxDepth=7), ml.regression_evaluator("y")
    want, got = (rmse.evaluate(m.fit(rows).transform(rows)) for m in (model, bf.BinnedForestRegressor.of(model)))
    assert abs(got / want - 1) < 0.1


def test_candidates_of_one_pass_equal_those_fitted_alone(rows):
    model = bf.BinnedForestRegressor.of(ml.learner("rf_regressor", "y", numTrees=4))
    maps = ml.grid(model, {"maxDepth": [2, 5], "maxBins": [4, 6]})
    together = dict(model.fitMultiple(rows, maps))
    assert sorted(together) == [0, 1, 2, 3]
    for i, m in enumerate(maps):
        alone = model.fit(rows, m)
        assert trees(together[i]) == trees(alone)
        assert together[i].getMaxDepth() == alone.getMaxDepth() == m[model.maxDepth] and together[i].getMaxBins() == m[model.maxBins]


def test_draws_do_not_follow_the_tasks(rows, monkeypatch):
    """Tasks and steps of any size, of partitions of any size, give the same forest; trees differ."""
    model = bf.BinnedForestRegressor.of(ml.learner("rf_regressor", "y", numTrees=3, maxDepth=4))
    want = trees(model.fit(rows))
    monkeypatch.setattr(bf, "ROWS_A_TASK", 500)
    monkeypatch.setattr(bf, "ROWS_A_STEP", 1)
    assert trees(model.fit(rows)) == want
    assert len(set(want.split("Tree ")[1:])) == 3 and trees(model.fit(rows, {model.seed: 7})) != want


def test_every_row_is_drawn_for_every_tree(spark):
    """Counts by tree are Poisson counts of all rows, in the sums of one task as of several."""
    import pyarrow as pa

    n = 30_000
    x = np.arange(n, dtype=float) % 10
    batches = [pa.RecordBatch.from_arrays([pa.array(np.full(e - s, s // 20_000, np.int32)), pa.array(2 * x[s:e]),
                                           pa.array(x[s:e, None].tolist())], names=["part", "y", "x"]) for s, e in ((0, 5000), (5000, 25_000), (25_000, n))]
    binning = bf.Binning(x[:, None], {}, 32)
    out = pa.Table.from_batches(bf._add([binning], 20, 42, 1.0, 1)(iter(batches))).to_pandas()
    assert (out.groupby("tree").n.sum() / n - 1).abs().max() < 0.05 and len(out) == 200
    assert (out.s == 2 * out.cell * out.n).all() and (out.q == 4 * out.cell ** 2 * out.n).all()
    plain = pa.Table.from_batches(bf._add([binning], 2, 42, None, 1)(iter(batches))).to_pandas()
    assert (plain.n == 3000).all()


def test_trees_without_rows(spark):
    df = ml.assembler(["x"]).transform(spark.createDataFrame([(1.0, 2.0)], "x double, y double"))
    got = bf.BinnedForestRegressor.of(ml.learner("rf_regressor", "y", numTrees=30)).fit(df)
    lines = trees(got)
    assert got.totalNumNodes == 30 and "Predict: 0.0" in lines and "Predict: 2.0" in lines


@pytest.mark.parametrize("why", ["weights", "cells"])
def test_mllib_fits_what_cells_cannot(rows, monkeypatch, why):
    from pyspark.sql import functions as F

    more = {}
    if why == "weights":
        rows, more = rows.withColumn("w", F.lit(2.0)), {"weightCol": "w"}
    else:
        monkeypatch.setattr(bf, "MOST_SUMS", 10)
    model = ml.learner("rf_regressor", "y", numTrees=2, maxDepth=3, **more)
    assert trees(bf.BinnedForestRegressor.of(model).fit(rows)) == trees(model.fit(rows))


@pytest.mark.parametrize("label", [None, float("nan")])
def test_missing_labels_fail(spark, label):
    df = ml.assembler(["x"]).transform(spark.createDataFrame([(1.0, label), (2.0, 1.0)], "x double, y double"))
    with pytest.raises(Exception, match="labels must not be|null"):
        bf.BinnedForestRegressor.of(ml.learner("rf_regressor", "y")).fit(df)


def test_selection_reads_rows_once_for_all_candidates(rows, monkeypatch):
    """MLlib reads all rows once a level of each candidate; here it fits none of them."""
    fitted, fit = [], JavaEstimator._fit_java
    monkeypatch.setattr(JavaEstimator, "_fit_java", lambda self, d: fitted.append(type(self).__name__) or fit(self, d))
    train = rows.selectExpr("y", "features AS x")
    stage = ml.VectorAssembler(inputCols=["x"], outputCol="features")
    best, tvs = ml.select_on_features([stage], ml.learner("rf_regressor", "y", numTrees=3), {"maxDepth": [2, 4, 6], "maxBins": [4, 8]},
                                      ml.regression_evaluator("y"), train, partitions=2)
    assert not [name for name in fitted if "Forest" in name]
    assert len(tvs.validationMetrics) == 6 and best.stages[-1].getOrDefault("maxDepth") in (2, 4, 6)
    assert min(tvs.validationMetrics) < 0.7 * max(tvs.validationMetrics)


def test_looked_up_predictions_equal_the_trees(spark, rows, tmp_dir):
    """For rows on both sides of every threshold and for unknown categories, before and after it is saved."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import RandomForestRegressionModel

    model = bf.BinnedForestRegressor.of(ml.learner("rf_regressor", "y", numTrees=3, maxDepth=6)).fit(rows, {})
    cuts = model._binning.cuts[0]
    values = [*cuts, *np.nextafter(cuts, np.inf), -1e9, 1e9, float("nan")]
    at = [([float(v), float(b), float(c)],) for v in values for b in (0, 0.5, 3, 9) for c in (0, 3, 4, -1, 0.5)]
    df = spark.createDataFrame(at, "x array<double>").select("x", array_to_vector("x").alias("features")).repartition(2)
    model.write().overwrite().save(tmp_dir + "/m")
    plain = RandomForestRegressionModel.load(tmp_dir + "/m")
    want, got = ({repr(r.x): r.prediction for r in m.transform(df).select("x", "prediction").collect()} for m in (plain, model))
    assert type(plain) is RandomForestRegressionModel and got == want and len(set(want.values())) > 20
    assert model.transform(df).columns == plain.transform(df).columns
