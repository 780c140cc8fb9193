"""Residuals that vanish for a right fit and for no other: evidence about learned models.

Logistic regression: the gradient of its loss, taken from the scores it gives its training rows.
Tree ensembles: a score is a walk to one leaf in each tree; a boosted tree's leaf holds the weighted
mean of the pseudo-residuals of its training rows under the trees before, and their weight.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.operators import explain, imbalance, newton_boost
from attrition.operators.models import positive_probability
from attrition.operators.preprocess import feature_names
from attrition.schema import TARGET


def _with_weight(df: DataFrame, weight_mode: str | None, label: str) -> DataFrame:
    return imbalance.with_class_weight(df, label, weight_mode) if weight_mode else df.withColumn("weight", F.lit(1.0))


def logistic_residual(df: DataFrame, model: PipelineModel, score: str = "p") -> Column:
    """How far a score column is from the model's coefficients times its named features."""
    lr = model.stages[-1]
    margin = F.lit(float(lr.intercept))
    for name, beta in zip(feature_names(model), lr.coefficients.toArray()):
        margin = margin + F.lit(float(beta)) * F.col(f"`{name}`").cast("double")
    return F.abs(F.col(score) - 1 / (1 + F.exp(-margin)))


def logistic_gradient(model: PipelineModel, train: DataFrame, weight_mode: str | None = None, label: str = TARGET) -> DataFrame:
    """``(feature, gradient)`` of the fitted loss on its training rows, the intercept included: zero
    at the fit. One aggregate over the rows' own scores."""
    lr, names = model.stages[-1], feature_names(model)
    scored = _with_weight(model.transform(train), weight_mode, label)
    error = F.col("weight") * (positive_probability() - F.col(label))
    sums = scored.agg(F.sum("weight").alias("_n"), F.sum(error).alias("_b"),
                      *[F.sum(error * F.col(f"`{n}`").cast("double")).alias(f"_{i}") for i, n in enumerate(names)])
    beta = lr.coefficients.toArray()
    reg = lr.getRegParam()
    each = [F.struct(F.lit(n).alias("feature"), (F.col(f"_{i}") / F.col("_n") + F.lit(reg * float(beta[i]))).alias("gradient"))
            for i, n in enumerate(names)]
    each.append(F.struct(F.lit("intercept").alias("feature"), (F.col("_b") / F.col("_n")).alias("gradient")))
    return sums.select(F.explode(F.array(*each)).alias("g")).select("g.*")


def leaves(model, spark) -> tuple[list[list[float]], list[list[float]], list[float]]:
    """Values and covers of each tree's leaves, from left to right, and the trees' weights."""
    trees, weights, _ = explain.tree_tables(model, spark)
    ends = [np.flatnonzero(t["left"] < 0) for t in trees]
    return ([t["value"][e].tolist() for t, e in zip(trees, ends)], [t["cover"][e].tolist() for t, e in zip(trees, ends)], weights)


def _nested(values: list[list[float]]) -> Column:
    return F.array(*[F.array(*[F.lit(float(v)) for v in tree]) for tree in values])


def walked(model: PipelineModel, df: DataFrame) -> DataFrame:
    """df with ``_leaf`` (leaf number in each tree) and ``_value`` (that leaf's value), one array each."""
    ensemble = model.stages[-1].copy()
    ensemble.setLeafCol("_leaves")
    out = PipelineModel(stages=[*model.stages[:-1], ensemble]).transform(df)
    values, _, _ = leaves(model.stages[-1], df.sparkSession)
    out = out.withColumn("_leaf", F.transform(vector_to_array("_leaves"), lambda v: v.cast("int")))
    # A literal of the model's own size, read by index.
    table = _nested(values)
    return out.withColumn("_table", table).withColumn(
        "_value", F.transform("_leaf", lambda leaf, tree: F.get(F.get("_table", tree), leaf))).drop("_table", "_leaves")


def walked_probability(model: PipelineModel, value: str = "_value") -> Column:
    """The ensemble's probability of class 1 from the values of a row's leaves."""
    ensemble = model.stages[-1]
    if type(ensemble).__name__.startswith("GBT"):
        weights = F.array(*[F.lit(float(w)) for w in ensemble.treeWeights])
        total = F.aggregate(F.zip_with(value, weights, lambda v, w: v * w), F.lit(0.0), lambda a, b: a + b)
        return 1 / (1 + F.exp(-2 * total))
    return F.aggregate(value, F.lit(0.0), lambda a, b: a + b) / F.size(value)


def leaf_residuals(model: PipelineModel, train: DataFrame, weight_mode: str | None = None, label: str = TARGET) -> DataFrame:
    """``(tree, leaf, value_gap, cover_gap)`` of a boosted ensemble without subsampling: each leaf's
    stored value and cover against the weighted mean of its rows' pseudo-residuals and their weight.

    The first tree is fitted to labels -1 and 1, a later one to 4y / (1 + exp(2 y F)), F the margin
    of the trees before."""
    spark = train.sparkSession
    values, covers, weights = leaves(model.stages[-1], spark)
    rows = walked(model, _with_weight(train, weight_mode, label)).select(
        (2 * F.col(label) - 1).cast("double").alias("y"), "weight", "_leaf",
        F.zip_with("_value", F.array(*[F.lit(float(w)) for w in weights]), lambda v, w: v * w).alias("_part"))
    before = F.transform("_part", lambda _, i: F.aggregate(F.slice("_part", 1, i), F.lit(0.0), lambda a, b: a + b))
    each = rows.select("y", "weight", F.posexplode(F.arrays_zip(F.col("_leaf").alias("leaf"), before.alias("margin"))).alias("tree", "at"))
    target = F.when(F.col("tree") == 0, F.col("y")).otherwise(4 * F.col("y") / (1 + F.exp(2 * F.col("y") * F.col("at.margin"))))
    sums = each.groupBy("tree", F.col("at.leaf").alias("leaf")).agg(
        F.sum("weight").alias("cover"), (F.sum(F.col("weight") * target) / F.sum("weight")).alias("value"))
    stored = spark.createDataFrame([(t, i, float(v), float(c)) for t, (vs, cs) in enumerate(zip(values, covers))
                                    for i, (v, c) in enumerate(zip(vs, cs))], "tree int, leaf int, stored double, held double")
    return (stored.join(sums, ["tree", "leaf"], "left")
            .select("tree", "leaf", F.abs(F.coalesce("value", F.lit(float("inf"))) - F.col("stored")).alias("value_gap"),
                    F.abs(F.coalesce("cover", F.lit(0.0)) - F.col("held")).alias("cover_gap")))


def newton_gaps(model: PipelineModel, train: DataFrame, l2: float, weight_mode: str | None = None, label: str = TARGET) -> DataFrame:
    """``(tree, leaf, gap)`` of a Newton ensemble without subsampling: each leaf's value against
    -G / (H + l2) of its training rows at the margins of the trees before."""
    boosted = model.stages[-1]
    trees, step = boosted.tree_arrays(), boosted.getOrDefault(boosted.stepSize)
    cloudpickle.register_pickle_by_value(newton_boost)

    def leaves_of(column: pa.Array) -> pa.Array:
        x = np.asarray(column.flatten(), np.float64).reshape(len(column), -1)
        found = np.stack([newton_boost.walk(t, x) for t in trees], 1).astype(np.int32)
        return pa.array(list(found), pa.list_(pa.int32()))

    x = PipelineModel(stages=model.stages[:-1]).transform(_with_weight(train, weight_mode, label))
    table = _nested([t["value"] for t in trees])
    rows = x.select(F.col(label).cast("double").alias("y"), "weight", F.arrow_udf(leaves_of, "array<int>")(vector_to_array("features")).alias("leaf"))
    rows = rows.withColumn("table", table).withColumn("part", F.transform("leaf", lambda leaf, t: step * F.get(F.get("table", t), leaf)))
    before = F.transform("part", lambda _, i: F.aggregate(F.slice("part", 1, i), F.lit(0.0), lambda a, b: a + b))
    each = rows.select("y", "weight", F.posexplode(F.arrays_zip(F.col("leaf"), before.alias("margin"))).alias("tree", "at"))
    p = 1 / (1 + F.exp(-F.col("at.margin")))
    sums = each.groupBy("tree", F.col("at.leaf").alias("leaf")).agg(
        F.sum(F.col("weight") * (p - F.col("y"))).alias("g"), F.sum(F.col("weight") * p * (1 - p)).alias("h"))
    stored = train.sparkSession.createDataFrame([(t, i, float(v)) for t, tree in enumerate(trees) for i, v in enumerate(tree["value"])],
                                                "tree int, leaf int, value double")
    return stored.join(sums, ["tree", "leaf"], "left").select(
        "tree", "leaf", F.abs(F.coalesce(F.col("value") + F.col("g") / (F.col("h") + l2), F.lit(float("inf")))).alias("gap"))
