"""Isotonic probability calibration.

Equal scores are summed first and the sums pooled by ranges (``pooling.blocks``), so neither a
task nor the driver gathers the scores. The blocks' ends become a
``pyspark.ml.regression.IsotonicRegressionModel``, which saves, loads and applies like any other.
Of n rows with labels 0 and 1 there are at most some n^(2/3) blocks: their means are different
fractions whose denominators add up to n.
"""

from __future__ import annotations

from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.operators import pooling
from attrition.session import materialize


def isotonic_blocks(scored: DataFrame, label: str = "y", score: str = "p",
                    weight: str | None = None, digits: int | None = None) -> DataFrame:
    """Pooled blocks ``(lo, hi, value, weight)`` of the isotonic fit of the label on the score.

    Rows are first summed to one row per distinct score (label sum, total weight), map-side,
    which leaves the fit unchanged; ``digits`` rounds scores first (an opt-in approximation)."""
    x = F.col(score).cast("double")
    if digits is not None:
        x = F.round(x, digits)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    return pooling.blocks(scored.select(x.alias("_x"), F.col(label).cast("double").alias("_y"), w.alias("_w"))
                          .groupBy("_x").agg(F.sum(F.col("_y") * F.col("_w")).alias("_s"), F.sum("_w").alias("_w"))
                          .where("_w > 0"))


def fit_isotonic(scored: DataFrame, label: str = "y", score: str = "p",
                 weight: str | None = None, digits: int | None = None) -> IsotonicRegressionModel:
    """Isotonic fit of the label on the score, from the ends of the pooled blocks."""
    blocks = materialize(isotonic_blocks(scored, label, score, weight, digits), "blocks")
    ends = F.when(F.col("lo") < F.col("hi"), F.array("lo", "hi")).otherwise(F.array("hi"))
    rows = (blocks.withColumn("_ends", ends).select(F.explode("_ends").alias("_x"), F.col("value").alias("_y"),
                                                     (F.col("weight") / F.size("_ends")).alias("_w")))
    iso = IsotonicRegression(featuresCol="_x", labelCol="_y", predictionCol="_cal", weightCol="_w",
                             isotonic=True)
    return iso.fit(rows)


def apply_isotonic(model: IsotonicRegressionModel, df: DataFrame, score: str = "p",
                   out: str = "p_cal") -> DataFrame:
    """Piecewise-linear between block boundaries, clamped outside them."""
    scored = model.setFeaturesCol("_x").setPredictionCol(out).transform(
        df.withColumn("_x", F.col(score).cast("double")))
    return scored.drop("_x")


def isotonic_table(model: IsotonicRegressionModel, scored: DataFrame, score: str = "p") -> DataFrame:
    """Fitted value at every distinct training score: ``(p, calibrated)``."""
    distinct = scored.select(F.col(score).cast("double").alias(score)).distinct()
    return apply_isotonic(model, distinct, score, "calibrated")
