"""Gradient-boosted trees and isotonic calibration, fitted by Spark ML and read out for use inside tasks."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class Trees:
    """All trees' nodes in one table: node, then children; a leaf has itself as both children."""

    roots: np.ndarray
    weights: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    levels: np.ndarray
    calibrated: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for root, weight in zip(self.roots, self.weights):
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            total += weight * self.value[at]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability of label 1."""
        raw = 1 / (1 + np.exp(-2 * self.margin(x)))
        return np.clip(np.interp(raw, self.levels, self.calibrated), 0.0, 1.0)


def _constant(value: float) -> Trees:
    one = np.zeros(1, np.int64)
    return Trees(one[:0], np.zeros(0), one, np.zeros(1), one, one, np.zeros(1), 0, np.array([0.0, 1.0]), np.full(2, value))


def _read_out(model) -> Trees:
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def add(node) -> int:
        at = len(feature)
        for column, start in ((feature, 0), (threshold, 0.0), (left, at), (right, at)):
            column.append(start)
        value.append(float(node.prediction()))
        if node.subtreeDepth() > 0:
            split = node.split()
            feature[at], threshold[at] = int(split.featureIndex()), float(split.threshold())
            left[at], right[at] = add(node.leftChild()), add(node.rightChild())
        return at

    for tree in model.trees:
        roots.append(add(tree._java_obj.rootNode()))
    depth = max(t.depth for t in model.trees)
    columns = [np.array(c) for c in (roots, model.treeWeights, feature, threshold, left, right, value)]
    return Trees(*columns, depth, np.array([0.0, 1.0]), np.array([0.0, 1.0]))


def fit(rows: DataFrame, calibrates: Column, rounds: int = 20, depth: int = 3, seed: int = 7) -> Trees:
    """Trees for (``x`` array<double>, ``y`` 0 or 1); rows where ``calibrates`` holds fit the calibration only.

    ``rows`` is written by the caller. With a single label the score is that label; without
    rows it is 0. Should the calibration rows hold a single label, all rows calibrate.
    """
    counted = {r.y: r.n for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counted) < 2:
        return _constant(float(next(iter(counted), 0)))
    data = rows.select(array_to_vector("x").alias("features"), F.col("y").cast("double").alias("label"), "x", calibrates.alias("apart"))
    grow = data.where(~F.col("apart"))
    if grow.select("label").distinct().count() < 2:
        grow = data
    gbt = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.2, maxBins=32, minInstancesPerNode=2, seed=seed)
    trees = _read_out(gbt.fit(grow.select("features", "label")))

    def raw(batches):
        for batch in batches:
            x = np.array(batch["x"].tolist(), float)
            if len(x):
                yield batch.assign(raw=1 / (1 + np.exp(-2 * trees.margin(x))))[["raw", "label"]]

    held = data.where("apart")
    if held.select("label").distinct().count() < 2:
        held = data
    scored = held.select("x", "label").mapInPandas(raw, T.StructType().add("raw", "double").add("label", "double"))
    isotonic = IsotonicRegression(featuresCol="raw", labelCol="label").fit(scored)
    trees.levels, trees.calibrated = isotonic.boundaries.toArray(), isotonic.predictions.toArray()
    return trees
