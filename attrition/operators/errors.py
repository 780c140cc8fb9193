"""Error analysis: misclassified rows, breakdown by segment, totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.functions.decisions import error_type
from attrition.functions.features import age_group
from attrition.schema import INPUT_COLS, KEY

BREAKDOWN_DIMS = ["Geography", "AgeGroup", "NumOfProducts"]


def error_rows(features: DataFrame, decided: DataFrame, key: str = KEY,
               inputs: list[str] = INPUT_COLS) -> DataFrame:
    """Misclassified rows: the raw inputs beside actual, predicted, probability
    and error_type. Scores and features meet on the key (an equi-join)."""
    joined = features.select(key, *inputs).join(
        decided.select(key, "actual", "predicted", "probability"), key)
    return (joined.withColumn("error_type", error_type("actual", "predicted"))
            .where(F.col("error_type") != "Correct"))


def error_breakdown(errors: DataFrame, dims: list[str] = BREAKDOWN_DIMS) -> DataFrame:
    """Counts per (dimension, value, error_type) over the three segment
    dimensions: one unpivot and one grouping (GROUPING SETS in long form)."""
    df = errors if "AgeGroup" in errors.columns else errors.withColumn("AgeGroup", age_group("Age"))
    long = df.select("error_type", F.explode(F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value"))
        for d in dims])).alias("d")).select("d.*", "error_type")
    return long.groupBy("dimension", "value", "error_type").agg(F.count(F.lit(1)).alias("count"))


def error_totals(decided: DataFrame) -> DataFrame:
    e = error_type("actual", "predicted")
    return decided.agg(F.count(F.when(e != "Correct", 1)).alias("errors"),
                       F.count(F.lit(1)).alias("rows"),
                       (F.count(F.when(e != "Correct", 1)) / F.count(F.lit(1))).alias("error_rate"),
                       F.count(F.when(e == "False Negative", 1)).alias("false_negatives"),
                       F.count(F.when(e == "False Positive", 1)).alias("false_positives"))
