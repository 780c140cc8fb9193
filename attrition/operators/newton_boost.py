"""Gradient boosting with an L2 term on the leaves, over Spark's regression trees.

A round fits one ``DecisionTreeRegressor`` to the Newton targets -g/h with weights h (g and h the
first and second derivative of the weighted log loss at each row's margin), which splits where the
weighted squared error of the Newton step falls most. The leaves are then set anew by one grouped
sum, value = -G / (H + l2), so a leaf with little curvature is pulled to zero; l2 = 0 leaves the
plain Newton step. Margins are stored every few rounds, which cuts the lineage.

The fitted model holds its trees as one text parameter: it saves, loads and streams like any other
stage. Scoring walks all trees over Arrow batches.
"""

from __future__ import annotations

import json
import re
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasWeightCol
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.schema import SEED_SPLIT, TARGET
from attrition.session import materialize, release

#: Rounds between two stores of the margins.
STORE = 5
#: Least curvature of a row.
TINY = 1e-16
_SPLIT = re.compile(r"If \(feature (\d+) <= (\S+)\)")


def parse_tree(text: str) -> dict:
    """Arrays of a regression tree from its printed form: feature, cut, left, right, leaf (numbered
    from left to right; -1 for inner nodes)."""
    lines = [line.strip() for line in text.splitlines()[1:] if line.strip()]
    tree: dict[str, list] = {"feature": [], "cut": [], "left": [], "right": [], "leaf": []}
    place, leaves = 0, 0

    def grow() -> int:
        nonlocal place, leaves
        at = len(tree["leaf"])
        for column, value in zip(tree.values(), (-1, 0.0, -1, -1, -1)):
            column.append(value)
        line = lines[place]
        place += 1
        if line.startswith("Predict"):
            tree["leaf"][at] = leaves
            leaves += 1
            return at
        split = _SPLIT.match(line)
        if not split:
            raise ValueError(f"not a split on a number: {line}")
        tree["feature"][at], tree["cut"][at] = int(split[1]), float(split[2])
        tree["left"][at] = grow()
        place += 1  # the Else line
        tree["right"][at] = grow()
        return at

    grow()
    return tree


def walk(tree: dict, x: np.ndarray) -> np.ndarray:
    """Leaf number of every row."""
    feature, cut, left, right, leaf = (np.asarray(tree[c]) for c in ("feature", "cut", "left", "right", "leaf"))
    at = np.zeros(len(x), np.int64)
    while True:
        inner = np.flatnonzero(leaf[at] < 0)
        if not len(inner):
            return leaf[at]
        node = at[inner]
        at[inner] = np.where(x[inner, feature[node]] <= cut[node], left[node], right[node])


def leaf_values(sums: dict[int, tuple[float, float]], leaves: int, l2: float) -> list[float]:
    """-G / (H + l2) of every leaf from its sums (G, H); a leaf without rows or curvature stays at 0."""
    out = []
    for leaf in range(leaves):
        g, h = sums.get(leaf, (0.0, 0.0))
        out.append(-g / (h + l2) if h + l2 > 0 else 0.0)
    return out


class _Columns(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasWeightCol):
    stepSize = Param(Params._dummy(), "stepSize", "share of a tree's step that is taken", TypeConverters.toFloat)


class NewtonBoostedTrees(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    maxIter = Param(Params._dummy(), "maxIter", "rounds", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree", TypeConverters.toInt)
    minInstances = Param(Params._dummy(), "minInstances", "least rows of a leaf", TypeConverters.toInt)
    l2 = Param(Params._dummy(), "l2", "L2 term of the leaves", TypeConverters.toFloat)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "share of the rows a round reads", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of the rounds' rows", TypeConverters.toInt)

    def __init__(self, maxIter: int = 100, stepSize: float = 0.1, maxDepth: int = 3, l2: float = 1.0, subsamplingRate: float = 1.0,
                 minInstances: int = 1, seed: int = SEED_SPLIT, labelCol: str = TARGET, featuresCol: str = "features"):
        super().__init__()
        self._set(maxIter=maxIter, stepSize=stepSize, maxDepth=maxDepth, l2=float(l2), subsamplingRate=subsamplingRate,
                  minInstances=minInstances, seed=seed, labelCol=labelCol, featuresCol=featuresCol)

    def setWeightCol(self, value: str) -> "NewtonBoostedTrees":
        return self._set(weightCol=value)

    def _fit(self, df: DataFrame) -> "NewtonBoostedModel":
        of = self.getOrDefault
        weight = F.col(self.getWeightCol()).cast("double") if self.isSet(self.weightCol) else F.lit(1.0)
        rows = materialize(df.select(F.monotonically_increasing_id().alias("row"), F.col(self.getFeaturesCol()).alias("features"),
                                     F.col(self.getLabelCol()).cast("double").alias("y"), weight.alias("w"), F.lit(0.0).alias("margin")), "boost")
        stored, trees = rows, []
        for t in range(of(self.maxIter)):
            p = 1 / (1 + F.exp(-F.col("margin")))
            rows = rows.withColumns({"g": F.col("w") * (p - F.col("y")), "h": F.greatest(F.col("w") * p * (1 - p), F.lit(TINY))})
            used = rows
            if of(self.subsamplingRate) < 1:
                share = F.pmod(F.xxhash64(F.lit(of(self.seed)), F.lit(t), "row"), F.lit(1 << 30)) / float(1 << 30)
                used = rows.where(share < of(self.subsamplingRate))
            # The tree sees the rows that have a weight at all.
            sample = used.where("w > 0").select("features", (-F.col("g") / F.col("h")).alias("target"), "h", "g")
            tree = DecisionTreeRegressor(featuresCol="features", labelCol="target", weightCol="h", maxDepth=of(self.maxDepth),
                                         minInstancesPerNode=of(self.minInstances), seed=of(self.seed)).fit(sample)
            tree.setLeafCol("leaf").setPredictionCol("step")
            arrays = parse_tree(tree.toDebugString)
            sums = {int(r["leaf"]): (r["g"], r["h"]) for r in
                    tree.transform(sample).groupBy("leaf").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()}
            arrays["value"] = leaf_values(sums, max(arrays["leaf"]) + 1, of(self.l2))
            trees.append(arrays)
            step = F.get(F.array(*[F.lit(v) for v in arrays["value"]]), F.col("leaf").cast("int"))
            rows = tree.transform(rows).withColumn("margin", F.col("margin") + F.lit(of(self.stepSize)) * step).select(
                "row", "features", "y", "w", "margin")
            if t % STORE == STORE - 1:
                rows = materialize(rows, "boost")
                release(stored)
                stored = rows
        release(stored)
        return NewtonBoostedModel()._set(trees=json.dumps(trees), stepSize=of(self.stepSize), featuresCol=self.getFeaturesCol())


class NewtonBoostedModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Trees with their leaves' values; ``probability`` and ``prediction`` as Spark's classifiers have them."""

    trees = Param(Params._dummy(), "trees", "arrays of every tree, as JSON", TypeConverters.toString)

    def tree_arrays(self) -> list[dict]:
        return json.loads(self.getOrDefault(self.trees))

    def margin(self, features: Column) -> Column:
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
        trees, step = self.tree_arrays(), self.getOrDefault(self.stepSize)

        def total(column: pa.Array) -> pa.Array:
            x = np.asarray(column.flatten(), np.float64).reshape(len(column), -1)
            out = np.zeros(len(x))
            for tree in trees:
                out += step * np.asarray(tree["value"])[walk(tree, x)]
            return pa.array(out)

        return F.arrow_udf(total, "double")(vector_to_array(features))

    def _transform(self, df: DataFrame) -> DataFrame:
        p = 1 / (1 + F.exp(-F.col("_margin")))
        return (df.withColumn("_margin", self.margin(F.col(self.getFeaturesCol()))).withColumn("_p", p)
                .withColumn(self.getProbabilityCol(), array_to_vector(F.array(1 - F.col("_p"), F.col("_p"))))
                .withColumn(self.getPredictionCol(), (F.col("_p") > 0.5).cast("double")).drop("_margin", "_p"))
