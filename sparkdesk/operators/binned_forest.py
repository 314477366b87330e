"""Random-forest regression from bootstrap sums by cell, for many candidates at once.

A tree sees a row only through its bins: rows with the same bin in every feature (a cell) take
the same path, and there are at most ``maxBins ** features`` cells, whatever the values are.
MLlib keeps a bagged copy of all rows for each candidate and reads it once a level.  Here every
row draws its Poisson count for each tree, as in MLlib, and is added to its cell's count, sum
and sum of squares.  One pass serves the trees of all candidates, and growing them takes no
further look at the rows.  Splits, gains, stopping rules and pruning are MLlib's, and so is the
model: a ``RandomForestRegressionModel``, loaded from Spark's own format.

Where the cells are too many (``MOST_SUMS``), or rows are weighted, MLlib does the fitting.
"""

from __future__ import annotations

import json
import math
import time
from collections import defaultdict
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.base import _FitMultipleIterator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkdesk.session import scratch_path, write_scratch

#: Most (cell, tree) pairs a task holds sums of, 24 bytes each.
MOST_SUMS = 1_000_000
#: Rows of a task (its output does not grow with them) and of one step inside it.
ROWS_A_TASK, ROWS_A_STEP = 500_000, 65_536
#: Rows that MLlib looks for thresholds in, at least.
SPLIT_ROWS = 10_000
#: Models read back at a time.
BUILDERS = 8
EPSILON = float(np.finfo(float).eps)

SUMS = "bins int, tree int, cell int, n double, s double, q double"
NODES = ("candidate int, tree int, id int, prediction double, impurity double, stats array<double>, raw long, gain double, "
         "left int, right int, feature int, value array<double>, categories int")
#: Parameters that may differ between candidates of one pass; all others decide what a row draws.
GROWTH = ("maxDepth", "maxBins", "minInstancesPerNode", "minInfoGain", "minWeightFractionPerNode", "featureSubsetStrategy")


def thresholds(values: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds between at most ``bins`` bins of about equal rows, as MLlib's ``findSplits``."""
    found, counts = np.unique(values, return_counts=True)
    middle = (found[:-1] + found[1:]) / 2.0
    if len(middle) < bins:
        return middle
    stride = len(values) / bins
    out, seen, target = [], int(counts[0]), stride
    for i in range(1, len(found)):
        before, seen = seen, seen + int(counts[i])
        if abs(before - target) < abs(seen - target):
            out.append(middle[i - 1])
            target += stride
    return np.array(out)


def arities(frame, col: str) -> dict[int, int]:
    """Number of categories by index, of the vector's categorical elements."""
    attrs = frame.schema[col].metadata.get("ml_attr", {}).get("attrs", {})
    return {a["idx"]: len(a["vals"]) if "vals" in a else a.get("num_vals", 0) for a in attrs.get("nominal", [])} \
        | {a["idx"]: 2 for a in attrs.get("binary", [])}


def subset_size(strategy: str, features: int, trees: int) -> int:
    """Features that a node may split by."""
    named = {"auto": features if trees == 1 else math.ceil(features / 3), "all": features, "onethird": math.ceil(features / 3),
             "sqrt": math.ceil(math.sqrt(features)), "log2": max(1, math.ceil(math.log2(features)))}
    if strategy in named:
        return named[strategy]
    return min(int(strategy), features) if strategy.isdigit() else math.ceil(float(strategy) * features)


class Binning:
    """Bins of each feature: thresholds, or the categories themselves."""

    def __init__(self, sample: np.ndarray, categories: dict[int, int], bins: int):
        self.categories = categories
        self.cuts = [None if f in categories else thresholds(sample[:, f], bins) for f in range(sample.shape[1])]
        self.sizes = [max(1, categories[f]) if cut is None else len(cut) + 1 for f, cut in enumerate(self.cuts)]
        self.cells = math.prod(self.sizes)

    def cell(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), dtype=np.int64)
        for f, (cut, size) in enumerate(zip(self.cuts, self.sizes)):
            if cut is None:
                b = x[:, f].astype(np.int64)
                if ((b != x[:, f]) | (b < 0) | (b >= size)).any():
                    raise ValueError(f"feature {f} has values outside its {size} categories")
            else:
                b = sum((x[:, f] > c for c in cut), np.zeros(len(x), dtype=np.int64))
            out = out * size + b
        return out

    def cell_of(self, x: str) -> Column:
        """``cell`` of an array column; NULL for values outside the categories."""
        out = F.lit(0)
        for f, (cut, size) in enumerate(zip(self.cuts, self.sizes)):
            v = F.col(x)[f]
            if cut is None:
                b = F.when((v >= 0) & (v < size) & (v == F.floor(v)), v.cast("int"))
            else:
                b = sum(((v > float(c)).cast("int") for c in cut), F.lit(0))
            out = out * size + b
        return out

    def examples(self) -> np.ndarray:
        """A vector of each cell, in their order: a bin ends with its threshold."""
        ends = [np.arange(size, dtype=float) if cut is None else np.append(cut, np.nextafter(cut[-1], np.inf) if len(cut) else 0.0)
                for cut, size in zip(self.cuts, self.sizes)]
        return np.stack([g.ravel() for g in np.meshgrid(*ends, indexing="ij")], axis=1)


def _read(batch: pa.RecordBatch, features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(partition, label, features) of the rows; as in MLlib, none may be missing or infinite."""
    y, x = batch.column("y"), batch.column("x")
    if y.null_count or x.null_count:
        raise ValueError("labels and vectors must not be null")
    y, flat = y.to_numpy(zero_copy_only=False), x.flatten().to_numpy(zero_copy_only=False)
    if np.isnan(y).any() or not np.isfinite(flat).all():
        raise ValueError("labels must not be NaN, vector values not NaN or infinite")
    return batch.column("part").to_numpy(zero_copy_only=False), y, flat.reshape(-1, features)


def _add(binnings, trees, seed, rate, features):
    """The function of a task: rows to sums by binning, tree and cell."""

    def add(batches):
        total = [np.zeros((trees, b.cells, 3)) for b in binnings]
        draws, held, rows = {}, [], 0

        def step():
            y, x, k = (np.concatenate(c) for c in zip(*held))
            x = np.asfortranarray(x)  # features are read one by one
            cells, k = [b.cell(x) for b in binnings], np.ascontiguousarray(k.T, dtype=float)
            for t in range(trees):
                weights = k[t], k[t] * y, k[t] * y * y
                for out, cell in zip(total, cells):
                    for j, w in enumerate(weights):
                        out[t, :, j] += np.bincount(cell, w, out.shape[1])

        for batch in batches:
            part, y, x = _read(batch, features)
            # draws follow the row's partition and place in it, not the task that reads several of them
            ends = [*(np.flatnonzero(np.diff(part)) + 1), len(part)] if len(part) else []
            for start, end in zip([0, *ends], ends):
                p = int(part[start])
                if rate is None:
                    k = np.ones((end - start, trees))
                else:
                    k = draws.setdefault(p, np.random.default_rng([seed % 2**63, p])).poisson(rate, (end - start, trees))
                held.append((y[start:end], x[start:end], k))
            rows += len(part)
            if rows >= ROWS_A_STEP:
                step()
                held, rows = [], 0
        if held:
            step()
        for i, out in enumerate(total):
            keep = out[:, :, 0] > 0
            keep[:, 0] = True  # a tree without any row is a tree too
            tree, cell = np.nonzero(keep)
            n, s, q = out[tree, cell].T
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(tree), i, np.int32)), pa.array(tree.astype(np.int32)),
                                              pa.array(cell.astype(np.int32)), pa.array(n), pa.array(s), pa.array(q)],
                                             names=["bins", "tree", "cell", "n", "s", "q"])

    return add


def _impurity(h: np.ndarray) -> np.ndarray:
    """Variance of (count, sum, sum of squares) along the last axis; 0 without rows."""
    n = np.where(h[..., 0] > 0, h[..., 0], 1.0)
    return np.where(h[..., 0] > 0, (h[..., 2] - h[..., 1] * h[..., 1] / n) / n, 0.0)


def grow(sums: np.ndarray, bins: np.ndarray, binning: Binning, rng, depth: int, subset: int, least_rows: float, least_weight: float,
         least_gain: float) -> list[dict]:
    """The nodes of one tree, from the sums of its cells and their bins, level by level."""
    sizes, features = binning.sizes, bins.shape[1]
    stats = sums.sum(axis=0)
    nodes = [{"stats": stats, "impurity": float(_impurity(stats)), "gain": -1.0, "left": -1, "right": -1}]
    at, cell_node, level = [0], np.zeros(len(sums), dtype=np.int64), 0
    while at and level < depth:
        m = len(at)
        total = np.array([nodes[i]["stats"] for i in at])
        impurity = np.array([nodes[i]["impurity"] for i in at])
        allowed = np.zeros((m, features), dtype=bool)
        np.put_along_axis(allowed, rng.random((m, features)).argsort(axis=1)[:, :subset], True, axis=1)
        best, feature = np.full(m, -np.inf), np.zeros(m, dtype=np.int64)
        cut, left = np.zeros(m, dtype=np.int64), np.zeros((m, 3))
        goes_left = np.zeros((m, max(sizes)), dtype=bool)
        for f, size in enumerate(sizes):
            if size == 1:
                continue
            key = cell_node * size + bins[:, f]
            h = np.stack([np.bincount(key, sums[:, j], m * size) for j in range(3)], axis=-1).reshape(m, size, 3)
            rank = np.broadcast_to(np.arange(size), (m, size))
            if f in binning.categories:  # categories are split in the order of their means
                some = h[..., 0] > 0
                mean = np.where(some, h[..., 1] / np.where(some, h[..., 0], 1.0), np.inf)
                order = mean.argsort(axis=1, kind="stable")
                rank, h = order.argsort(axis=1), np.take_along_axis(h, order[..., None], axis=1)
            lefts = h.cumsum(axis=1)[:, :-1]
            rights = total[:, None] - lefts
            ln, rn, n = lefts[..., 0], rights[..., 0], np.maximum(total[:, None, 0], 1.0)
            gain = impurity[:, None] - ln / n * _impurity(lefts) - rn / n * _impurity(rights)
            few = (np.minimum(ln, rn) < least_rows) | (np.minimum(ln, rn) < least_weight) | (gain < least_gain)
            gain = np.where(few, -np.inf, gain)
            i = gain.argmax(axis=1)
            g = gain[np.arange(m), i]
            better = allowed[:, f] & (g > best)
            best, feature, cut = np.where(better, g, best), np.where(better, f, feature), np.where(better, i, cut)
            left[better] = lefts[better, i[better]]
            goes_left[better] = False
            goes_left[better, :size] = rank[better] <= i[better, None]
        below, place = [], np.full((m, 2), -1)
        for j in np.flatnonzero(best > 0):
            f, node = int(feature[j]), nodes[at[j]]
            node |= {"gain": float(best[j]), "feature": f, "left": len(nodes), "right": len(nodes) + 1}
            if f in binning.categories:
                node |= {"value": np.flatnonzero(goes_left[j]).astype(float).tolist(), "categories": binning.categories[f]}
            else:
                node |= {"value": [float(binning.cuts[f][cut[j]])]}
            for side, child in enumerate((left[j], total[j] - left[j])):
                spread = float(_impurity(child))
                if abs(spread) >= EPSILON:
                    place[j, side] = len(below)
                    below.append(len(nodes))
                nodes.append({"stats": child, "impurity": spread, "gain": -1.0, "left": -1, "right": -1})
        to_left = goes_left[cell_node, bins[np.arange(len(bins)), feature[cell_node]]]
        cell_node = place[cell_node, np.where(to_left, 0, 1)]
        stay = cell_node >= 0
        sums, bins, cell_node, at, level = sums[stay], bins[stay], cell_node[stay], below, level + 1
    return _pruned(nodes)


def _pruned(nodes: list[dict]) -> list[dict]:
    """Siblings that predict the same are merged into their parent; numbers without gaps."""
    for node in nodes:
        n, s, _ = node["stats"]
        node["prediction"] = float(s / n) if n else 0.0
    for node in reversed(nodes):
        if node["left"] >= 0:
            a, b = nodes[node["left"]], nodes[node["right"]]
            if a["left"] < 0 and b["left"] < 0 and a["prediction"] == b["prediction"]:
                node |= {"gain": -1.0, "left": -1, "right": -1}
    kept, number = [0], {0: 0}
    for i in kept:
        for child in (nodes[i]["left"], nodes[i]["right"]):
            if child >= 0:
                number[child] = len(kept)
                kept.append(child)
    return [nodes[i] | {"id": number[i], "left": number.get(nodes[i]["left"], -1), "right": number.get(nodes[i]["right"], -1)} for i in kept]


class BinnedForestModel(RandomForestRegressionModel):
    """The fitted forest; rows look their prediction up by cell (saved and loaded, it is Spark's own class)."""

    @classmethod
    def of(cls, model: RandomForestRegressionModel, binning: Binning, spark) -> BinnedForestModel:
        """The same model, with its prediction for each cell."""
        out = model._copyValues(cls(model._java_obj.copy(model._empty_java_param_map())))  # a Java object has one owner, who frees it
        out._binning = binning
        examples = pa.table({"cell": pa.array(range(binning.cells), pa.int32()), "x": pa.array(list(binning.examples()), pa.list_(pa.float64()))})
        df = spark.createDataFrame(examples).select("cell", array_to_vector("x").alias(model.getFeaturesCol()))
        found = sorted(model.transform(df).select("cell", model.getPredictionCol()).collect())
        out._predictions = ",".join(repr(prediction) for _, prediction in found)
        return out

    def _transform(self, dataset):
        if self.getLeafCol():
            return super()._transform(dataset)
        name, x, cell = self.getPredictionCol(), f"{self.uid}_x", f"{self.uid}_cell"
        by_cell = F.split(F.lit(self._predictions), ",").cast("array<double>")
        known = dataset.withColumn(x, vector_to_array(self.getFeaturesCol())).withColumn(cell, self._binning.cell_of(x))
        # the trees themselves are only asked about values outside the categories
        looked_up = F.when(F.col(cell).isNotNull(), F.get(by_cell, F.col(cell))).otherwise(F.col(name))
        return super()._transform(known).withColumn(name, looked_up).drop(x, cell)


class BinnedForestRegressor(RandomForestRegressor):
    """``RandomForestRegressor`` whose candidates share one pass over the rows."""

    @classmethod
    def of(cls, model: RandomForestRegressor) -> BinnedForestRegressor:
        """The same learner, parameters included."""
        return model._copyValues(cls())

    def fitMultiple(self, dataset, paramMaps):
        candidates = [self.copy(m) for m in paramMaps]
        models = self._grown(dataset, candidates)
        if models is None:
            return super().fitMultiple(dataset, paramMaps)
        return _FitMultipleIterator(models, len(candidates))

    def _fit(self, dataset):
        models = self._grown(dataset, [self])
        return super()._fit(dataset) if models is None else models(0)

    def _draws(self) -> list:
        return sorted((p.name, self.getOrDefault(p)) for p in self.params if self.isDefined(p) and p.name not in GROWTH)

    def _grown(self, dataset, candidates):
        """A function from the number of a candidate to its model; None if MLlib is to fit."""
        if not candidates or any(c._draws() != candidates[0]._draws() for c in candidates):
            return None
        first = candidates[0]
        weighted = first.isDefined("weightCol") and first.getWeightCol()
        rate, bootstrap, trees, seed = first.getSubsamplingRate(), first.getBootstrap(), first.getNumTrees(), first.getSeed()
        if weighted or not (bootstrap or rate == 1.0):
            return None
        col = first.getFeaturesCol()
        categories, n = arities(dataset, col), dataset.count()
        rows = dataset.select(F.spark_partition_id().alias("part"), F.col(first.getLabelCol()).cast("double").alias("y"),
                              vector_to_array(col).alias("x"))
        widest = max(c.getMaxBins() for c in candidates)
        if n == 0 or max(categories.values(), default=0) > min(min(c.getMaxBins() for c in candidates), n):
            return None
        share = max(widest * widest, SPLIT_ROWS) / n
        sample = rows.select("x") if share >= 1 else rows.select("x").sample(False, share, seed)
        sample = np.array([r.x for r in sample.collect()], dtype=float)
        if sample.ndim != 2 or sample.shape[1] == 0 or not np.isfinite(sample).all():
            return None
        widths = sorted({min(c.getMaxBins(), n) for c in candidates})
        binnings = [Binning(sample, categories, w) for w in widths]
        if sum(b.cells for b in binnings) * trees > MOST_SUMS:
            return None
        features = sample.shape[1]
        jobs = defaultdict(list)
        for i, c in enumerate(candidates):
            jobs[widths.index(min(c.getMaxBins(), n))].append(
                (i, dict(depth=c.getMaxDepth(), subset=subset_size(c.getFeatureSubsetStrategy(), features, trees),
                         least_rows=c.getMinInstancesPerNode(), least_weight=c.getMinWeightFractionPerNode() * n,
                         least_gain=c.getMinInfoGain())))
        jobs = dict(jobs)

        def grow_all(key, table):
            b, tree = key[0].as_py(), key[1].as_py()
            order = np.argsort(table.column("cell").to_numpy())
            cell = table.column("cell").to_numpy()[order]
            sums = np.stack([table.column(c).to_numpy()[order] for c in "nsq"], axis=1)
            at = np.stack(np.unravel_index(cell, binnings[b].sizes), axis=1)
            grown = [(i, node) for i, how in jobs[b] for node in grow(sums, at, binnings[b], np.random.default_rng([seed % 2**63, tree]), **how)]
            return pa.table({
                "candidate": pa.array([i for i, _ in grown], pa.int32()), "tree": pa.array([tree] * len(grown), pa.int32()),
                "id": pa.array([v["id"] for _, v in grown], pa.int32()), "prediction": pa.array([v["prediction"] for _, v in grown], pa.float64()),
                "impurity": pa.array([v["impurity"] for _, v in grown], pa.float64()),
                "stats": pa.array([v["stats"].tolist() for _, v in grown], pa.list_(pa.float64())),
                "raw": pa.array([int(v["stats"][0]) for _, v in grown], pa.int64()), "gain": pa.array([v["gain"] for _, v in grown], pa.float64()),
                "left": pa.array([v["left"] for _, v in grown], pa.int32()), "right": pa.array([v["right"] for _, v in grown], pa.int32()),
                "feature": pa.array([v["feature"] if v["left"] >= 0 else -1 for _, v in grown], pa.int32()),
                "value": pa.array([v["value"] if v["left"] >= 0 else [] for _, v in grown], pa.list_(pa.float64())),
                "categories": pa.array([v.get("categories", -1) if v["left"] >= 0 else -1 for _, v in grown], pa.int32())})

        add = _add(binnings, trees, seed, rate if bootstrap else None, features)
        sums = rows.coalesce(-(-n // ROWS_A_TASK)).mapInArrow(add, SUMS).groupBy("bins", "tree", "cell").agg(
            *[F.sum(c).alias(c) for c in "nsq"])
        # a task a tree: growing takes time, not bytes, which adaptive partitions go by
        sums = sums.repartition(len(binnings) * trees, "bins", "tree")
        nodes = write_scratch(sums.groupBy("bins", "tree").applyInArrow(grow_all, NODES), "forest_nodes").persist()
        try:
            build = inheritable_thread_target(dataset.sparkSession)(
                lambda i: candidates[i]._model(nodes.where(F.col("candidate") == i), binnings[widths.index(min(candidates[i].getMaxBins(), n))]))
            with ThreadPool(min(BUILDERS, len(candidates))) as pool:
                models = pool.map(build, range(len(candidates)))
        finally:
            nodes.unpersist()
        return models.__getitem__

    def _model(self, nodes, binning: Binning) -> BinnedForestModel:
        """The model of these nodes, by way of Spark's format of saved forests."""
        spark, trees, now = nodes.sparkSession, self.getNumTrees(), int(time.time() * 1000)
        path = scratch_path(spark, "forest")

        def metadata(kind, uid, known, **more):
            given, default = ({p.name: v for p, v in m.items() if p.name in known} for m in (self._paramMap, self._defaultParamMap))
            return json.dumps({"class": f"org.apache.spark.ml.regression.{kind}", "timestamp": now, "sparkVersion": spark.version, "uid": uid,
                               "paramMap": given, "defaultParamMap": default, **more})

        whole = metadata("RandomForestRegressionModel", self.uid, {p.name for p in self.params}, numFeatures=len(binning.sizes), numTrees=trees)
        known = {p.name for p in DecisionTreeRegressor().params}
        one = [metadata("DecisionTreeRegressionModel", f"{self.uid}_tree_{t}", known) for t in range(trees)]
        spark.createDataFrame(pa.table({"value": [whole]})).coalesce(1).write.text(f"{path}/metadata")
        spark.createDataFrame(pa.table({"_1": pa.array(range(trees), pa.int32()), "_2": one, "_3": [1.0] * trees})).coalesce(1) \
            .write.parquet(f"{path}/treesMetadata")
        split = F.struct(F.col("feature").alias("featureIndex"), F.col("value").alias("leftCategoriesOrThreshold"),
                         F.col("categories").alias("numCategories"))
        node = F.struct("id", "prediction", "impurity", F.col("stats").alias("impurityStats"), F.col("raw").alias("rawCount"), "gain",
                        F.col("left").alias("leftChild"), F.col("right").alias("rightChild"), split.alias("split"))
        nodes.select(F.col("tree").alias("treeID"), node.alias("nodeData")).coalesce(1).write.parquet(f"{path}/data")
        return BinnedForestModel.of(self._copyValues(RandomForestRegressionModel.load(path)), binning, spark)
