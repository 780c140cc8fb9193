"""Exploratory aggregates: class balance, per-class KDE, churn rate by group,
correlations."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.functions.features import numeric_columns
from attrition.operators.comoments import correlations
from attrition.schema import TARGET

GAUSS_NORM = 1.0 / math.sqrt(2 * math.pi)
#: Terms of a density's expansion, and bandwidths beyond which a cell adds nothing.
TERMS = 20
REACH = 10.0


def class_counts(df: DataFrame, label: str = TARGET) -> DataFrame:
    """``(label, n, percent)``; percent of all rows, total as a scalar subquery."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return (df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("percent", F.col("n").cast("double") * 100 / total))


def rate_by_group(df: DataFrame, dims: list[str], label: str = TARGET) -> DataFrame:
    """Churn rate (percent) per value of each dimension plus the overall rate.

    Long form ``(dimension, value, n, churn_rate, overall_rate)`` built as one
    unpivot and one grouping, i.e. GROUPING SETS over the dimensions.
    """
    long = df.select(F.col(label).alias("_y"), F.explode(F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value"))
        for d in dims])).alias("_d")).select("_d.*", "_y")
    overall = df.agg(F.sum(F.col(label)).cast("double") * 100 / F.count(F.lit(1))).scalar()
    return (long.groupBy("dimension", "value")
            .agg(F.count(F.lit(1)).alias("n"),
                 (F.sum("_y").cast("double") * 100 / F.count(F.lit(1))).alias("churn_rate"))
            .withColumn("overall_rate", overall))


def kde_by_class(df: DataFrame, column: str, label: str = TARGET, grid_size: int = 200,
                 cut: float = 3.0, value_digits: int | None = None) -> DataFrame:
    """Gaussian KDE of ``column`` per class, Scott bandwidth (std * n^-1/5,
    sample std), grid of ``grid_size`` points over [min - cut*bw, max + cut*bw],
    every class normalised on its own.

    The sum of kernels is expanded in Hermite functions: each row adds the powers of its distance
    from the middle of its cell, one bandwidth wide, to that cell's TERMS moments (one grouped sum,
    combined map-side), and a cell adds its expansion to the grid points within REACH bandwidths.
    So the work is the rows once and cells x grid size, whether the column is continuous or not.
    By Cramer's bound |h_k(t)| <= 1.09 * 2^(k/2) * sqrt(k!), with distances of at most 1 / sqrt(8)
    in units of sqrt(2) bandwidths, the cut expansion is off by less than 1e-15 of a kernel's peak;
    beyond REACH a kernel is below 1e-17 of it.

    ``value_digits`` rounds values first. A class with one value only has null densities.
    """
    v = F.col(column).cast("double")
    if value_digits is not None:
        v = F.round(v, value_digits)
    base = df.select(F.col(label).alias("label"), v.alias("v")).where(F.col("v").isNotNull())
    stats = (base.groupBy("label")
             .agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("v").alias("sd"),
                  F.min("v").alias("lo"), F.max("v").alias("hi"))
             .withColumn("bw", F.nullif(F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)), F.lit(0.0)))
             .withColumn("gmin", F.col("lo") - F.col("bw") * cut)
             .withColumn("gmax", F.col("hi") + F.col("bw") * cut).select("label", "n", "bw", "gmin", "gmax"))
    middle = F.col("gmin") + (F.col("cell") + 0.5) * F.col("bw")
    # stats has one row per class (a 0/1 label): bounded, safe to broadcast.
    u = (base.join(F.broadcast(stats.where("bw is not null")), "label")
         .withColumn("cell", F.floor((F.col("v") - F.col("gmin")) / F.col("bw")))
         .withColumn("u", (F.col("v") - middle) / (F.col("bw") * math.sqrt(2))))
    cells = u.groupBy("label", "cell").agg(*[F.sum(F.pow("u", F.lit(float(k)))).alias(f"a{k}") for k in range(TERMS)])
    moments = F.array(*[F.col(f"a{k}") / F.lit(float(math.factorial(k))) for k in range(TERMS)])
    step = (F.col("gmax") - F.col("gmin")) / (grid_size - 1)
    place = lambda d: (middle + d * F.col("bw") - F.col("gmin")) / step
    near = F.sequence(F.greatest(F.lit(0), F.floor(place(-REACH)).cast("int")), F.least(F.lit(grid_size - 1), F.ceil(place(REACH)).cast("int")))
    x = F.col("gmin") + (F.col("gmax") - F.col("gmin")) * F.col("i") / (grid_size - 1)
    t = F.col("t")
    hermite = F.aggregate(
        "moments", F.struct(F.lit(0.0).alias("before"), F.lit(1.0).alias("now"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("k")),
        lambda s, a: F.struct(s["now"].alias("before"), (2 * t * s["now"] - 2 * s["k"] * s["before"]).alias("now"),
                              (s["sum"] + a * s["now"]).alias("sum"), (s["k"] + 1).alias("k")), lambda s: s["sum"])
    sums = (cells.join(F.broadcast(stats), "label").withColumn("moments", moments).withColumn("middle", middle)
            .select("label", "gmin", "gmax", "bw", "moments", "middle", F.explode(near).alias("i"))
            .withColumn("t", (x - F.col("middle")) / (F.col("bw") * math.sqrt(2)))
            .groupBy("label", "i").agg(F.sum(hermite * F.exp(-t * t)).alias("_s")))
    grid = stats.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(grid_size - 1))))
    density = F.coalesce("_s", F.lit(0.0)) * GAUSS_NORM / (F.col("n") * F.col("bw"))
    return grid.join(sums, ["label", "i"], "left").select(
        F.lit(column).alias("column"), "label", F.col("i").alias("grid_index"), x.alias("x"), density.alias("density"))


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pearson r for every pair below the diagonal. ``(row_feature, col_feature, r)`` with col
    before row in ``columns`` order; by default all numeric columns. A pair uses the rows in which
    both are known (see ``comoments``)."""
    return correlations(df, columns or numeric_columns(df))


def high_correlation_pairs(corr: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Pairs with |r| > threshold, names ordered so feature_1 < feature_2."""
    a, b = F.col("row_feature"), F.col("col_feature")
    return corr.where(F.abs("r") > F.lit(threshold)).select(
        F.least(a, b).alias("feature_1"), F.greatest(a, b).alias("feature_2"),
        F.abs("r").alias("abs_r"))
