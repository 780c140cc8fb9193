"""Per-customer explanations as distributed batch jobs.

* Linear models: the exact Shapley values of a linear score with independent
  features are ``coef_j * (x_j - mean_j)`` in log-odds; pure column arithmetic.
* Tree ensembles (Spark GBT, random forest, decision tree): exact
  path-dependent tree SHAP over a packed table of merged paths (see ``paths``).

All explanations come out as one long table
``(CustomerId, feature_idx, feature, value, shap)``; ``base`` is the expected
model output.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (DecisionTreeClassificationModel, GBTClassificationModel,
                                       LogisticRegressionModel,
                                       RandomForestClassificationModel)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attrition.operators import paths
from attrition.operators.preprocess import feature_names
from attrition.schema import KEY, WATERFALL_SHOWN


# ---------------------------------------------------------------- linear
def linear_shap(features: DataFrame, names: list[str], coef: list[float],
                background: DataFrame | None = None, key: str = KEY) -> DataFrame:
    """Long SHAP table for a linear log-odds score over named feature columns.
    ``background`` (default: ``features``) gives the means, in one aggregate."""
    return (linear_shap_arrays(features, names, coef, background, key)
            .select(key, F.explode("factors").alias("s"))
            .select(key, "s.feature_idx", "s.feature", "s.value", "s.shap"))


def linear_shap_arrays(features: DataFrame, names: list[str], coef: list[float],
                       background: DataFrame | None = None, key: str = KEY,
                       carry: list[str] | None = None) -> DataFrame:
    """The same as one row per customer: ``factors``, an array of structs, beside ``carry``."""
    bg = background if background is not None else features
    means = bg.agg(*[F.avg(F.col(f"`{n}`")).alias(f"m{i}") for i, n in enumerate(names)]).first()
    mu = [float(means[f"m{i}"]) for i in range(len(names))]
    return features.select(key, *(carry or []), F.array(*[
        F.struct((F.lit(float(b)) * (F.col(f"`{n}`").cast("double") - F.lit(m))).alias("shap"),
                 F.lit(i).alias("feature_idx"), F.lit(n).alias("feature"),
                 F.col(f"`{n}`").cast("double").alias("value"))
        for i, (n, b, m) in enumerate(zip(names, coef, mu))]).alias("factors"))


def linear_base(intercept: float, coef: list[float], means: list[float]) -> float:
    return float(intercept + sum(b * m for b, m in zip(coef, means)))


def logistic_shap(model: PipelineModel, df: DataFrame, background: DataFrame | None = None,
                  key: str = KEY) -> tuple[DataFrame, float]:
    lr = model.stages[-1]
    assert isinstance(lr, LogisticRegressionModel)
    names = feature_names(model)
    feats = PipelineModel(stages=model.stages[:-1])
    x = feats.transform(df)
    bg = feats.transform(background) if background is not None else x
    coef = [float(c) for c in lr.coefficients.toArray()]
    sel = lambda d: d.select(key, *[F.col(f"`{n}`").cast("double").alias(n) for n in names])
    table = linear_shap(sel(x), names, coef, sel(bg), key)
    means = sel(bg).agg(*[F.avg(F.col(f"`{n}`")) for n in names]).first()
    return table, linear_base(float(lr.intercept), coef, [float(v) for v in means])


# ---------------------------------------------------------------- trees
def _save_dir(spark) -> str:
    from attrition.session import checkpoint_dir
    return os.path.join(checkpoint_dir(spark), f"trees-{uuid.uuid4().hex}")


def save_trees(model, spark) -> tuple[str, list[float], str]:
    """Folder of the model's saved nodes, the weights of its trees and its kind."""
    path = _save_dir(spark)
    model.write().overwrite().save(path)
    if isinstance(model, DecisionTreeClassificationModel):
        return path, [1.0], "forest"
    meta = spark.read.parquet(os.path.join(path, "treesMetadata"))
    if "treeID" not in meta.columns:  # written as (treeID, metadata, weights) tuples
        meta = meta.toDF("treeID", "metadata", "weights")
    weights = [float(r["weights"]) for r in meta.select("treeID", "weights").orderBy("treeID").collect()]
    return path, weights, "boosted" if isinstance(model, GBTClassificationModel) else "forest"


def tree_tables(model, spark) -> tuple[list[dict], list[float], str]:
    """Nodes of every tree from the model's saved data, tree weights and kind; for models whose
    trees the driver can hold."""
    path, weights, kind = save_trees(model, spark)
    nodes = spark.read.parquet(os.path.join(path, "data"))
    tree = F.col("treeID") if "treeID" in nodes.columns else F.lit(0)
    nodes = (nodes.select(tree.alias("treeID"), "nodeData.id", "nodeData.prediction", "nodeData.impurityStats",
                          "nodeData.leftChild", "nodeData.rightChild",
                          "nodeData.split.featureIndex", "nodeData.split.leftCategoriesOrThreshold",
                          "nodeData.split.numCategories").toPandas())
    ids = range(len(weights))
    trees = []
    for tid in ids:
        t = nodes[nodes["treeID"] == tid].sort_values("id")
        stats = [np.asarray(s, dtype=float) for s in t["impurityStats"]]
        if kind == "boosted":
            cover = np.array([s[0] for s in stats])          # weighted count (variance stats)
            value = t["prediction"].to_numpy(dtype=float)
        else:
            cover = np.array([s.sum() for s in stats])       # weighted class counts
            value = np.array([(s[1] / s.sum()) if s.sum() > 0 and len(s) > 1 else 0.0
                              for s in stats])
        trees.append({
            "left": t["leftChild"].to_numpy(dtype=int), "right": t["rightChild"].to_numpy(dtype=int),
            "feature": t["featureIndex"].to_numpy(dtype=int),
            "split": [np.asarray(v, dtype=float) for v in t["leftCategoriesOrThreshold"]],
            "ncat": t["numCategories"].to_numpy(dtype=int),
            "cover": cover, "value": value})
    return trees, weights, kind


def tree_model_of(model):
    return model.stages[-1] if isinstance(model, PipelineModel) else model


def tree_shap(model: PipelineModel, df: DataFrame, key: str = KEY) -> tuple[DataFrame, float]:
    """Long SHAP table for a tree-ensemble pipeline, plus the base value.

    Boosted trees are explained in log-odds (Spark's probability is
    1 / (1 + exp(-2F)), so log-odds = 2F); forests and single trees in
    probability of class 1. See ``paths`` for how.
    """
    clf = tree_model_of(model)
    path, weights, kind = save_trees(clf, df.sparkSession)
    scale = [2.0 * w for w in weights] if kind == "boosted" else [1.0 / len(weights)] * len(weights)
    feats = PipelineModel(stages=model.stages[:-1]).transform(df)
    rows = feats.select(F.col(key).cast("long").alias(key), vector_to_array(F.col("features")).alias("x"))
    return paths.explain(rows, paths.packed(path, kind, scale, df.sparkSession), feature_names(model), key)


def model_shap(model: PipelineModel, df: DataFrame, background: DataFrame | None = None,
               key: str = KEY) -> tuple[DataFrame, float]:
    clf = tree_model_of(model)
    if isinstance(clf, LogisticRegressionModel):
        return logistic_shap(model, df, background, key)
    if isinstance(clf, (GBTClassificationModel, RandomForestClassificationModel,
                        DecisionTreeClassificationModel)):
        return tree_shap(model, df, key)
    raise TypeError(f"no explainer for {type(clf).__name__}")


# ---------------------------------------------------------------- summaries
def mean_abs_shap(shap_long: DataFrame, top: int | None = 10) -> DataFrame:
    """Global importance: mean |shap| per feature, largest first (top-k report)."""
    g = shap_long.groupBy("feature").agg(F.avg(F.abs("shap")).alias("mean_abs_shap"))
    g = g.orderBy(F.col("mean_abs_shap").desc(), F.col("feature"))
    return g.limit(top) if top else g


def waterfall(shap_long: DataFrame, base: float, customer: int, shown: int = WATERFALL_SHOWN,
              key: str = KEY) -> DataFrame:
    """One customer's waterfall: the ``shown - 1`` largest |shap| features, one
    row for the remaining features, a running sum from the base, and f(x)."""
    one = shap_long.where(F.col(key) == F.lit(customer))
    w = Window.partitionBy(key).orderBy(F.abs("shap").desc(), F.col("feature_idx"))
    ranked = one.withColumn("_r", F.row_number().over(w))
    n_other = F.count(F.lit(1))
    top = ranked.where(F.col("_r") < shown).select(
        key, F.col("_r").alias("step"), "feature", "value", "shap")
    rest = (ranked.where(F.col("_r") >= shown).groupBy(key)
            .agg(F.lit(shown).alias("step"),
                 F.concat(n_other.cast("string"), F.lit(" other features")).alias("feature"),
                 F.lit(None).cast("double").alias("value"), F.sum("shap").alias("shap")))
    steps = top.unionByName(rest)
    run = Window.partitionBy(key).orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return steps.withColumn("cumulative", F.lit(float(base)) + F.sum("shap").over(run))
