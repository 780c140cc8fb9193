"""Class imbalance: weight columns and minority oversampling.

Weights: ``balanced`` gives each row n / (2 * n_class); ``positive`` gives
positives n_neg / n_pos and negatives 1. Both are a column expression over the
class counts (one aggregate with one row per label), no join.

Oversampling (SMOTE, ADASYN) makes synthetic minority rows on segments between
a minority row and one of its k nearest minority neighbours; see ``knn`` for
the exact neighbour search. Random choices come from hashes of
``(seed, key, i)``, so the output is repeatable for any partitioning.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attrition.schema import KEY, SEED_SAMPLER
from attrition.session import materialize


def made(key, make: Callable):
    """What ``make`` makes. Callers that resample the same rows more than once pass a function of the same
    form that keeps it by its key, so that samplers share the search among the minority rows."""
    return make()


def label_counts(df: DataFrame, label: str = "Exited") -> dict:
    """Rows per label value: one aggregate, as many rows as labels (two)."""
    return {r[0]: r[1] for r in df.groupBy(label).agg(F.count(F.lit(1))).collect()}


def class_weight_values(counts: dict, mode: str = "balanced") -> tuple[float, float]:
    """Weights of the other rows and of the rows with label 1."""
    n, n0, n1 = float(sum(counts.values())), float(counts.get(0, 0)), float(counts.get(1, 0))
    if mode == "balanced":
        return n / (2.0 * n0) if n0 else 0.0, n / (2.0 * n1) if n1 else 0.0
    if mode == "positive":
        return 1.0, n0 / n1 if n1 else 0.0
    raise ValueError(f"unknown weight mode {mode!r}")


def class_weight_column(df: DataFrame, label: str = "Exited", mode: str = "balanced",
                        counts: dict | None = None) -> Column:
    w0, w1 = class_weight_values(counts if counts is not None else label_counts(df, label), mode)
    return F.when(F.col(label) == 1, F.lit(w1)).otherwise(F.lit(w0))


def with_class_weight(df: DataFrame, label: str = "Exited", mode: str = "balanced",
                      out: str = "weight", counts: dict | None = None) -> DataFrame:
    return df.withColumn(out, class_weight_column(df, label, mode, counts))


def class_weights(df: DataFrame, label: str = "Exited") -> DataFrame:
    """``(label, n, balanced_weight, positive_weight)`` per class."""
    # One grouped count; the totals are windows over its two rows.
    every = Window.partitionBy(F.lit(0))
    c = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    of = lambda y: F.sum(F.when(F.col("label") == y, F.col("n"))).over(every)
    return c.select("label", "n",
                    (F.sum("n").over(every).cast("double") / (F.lit(2.0) * F.col("n"))).alias("balanced_weight"),
                    F.when(F.col("label") == 1, F.try_divide(of(0).cast("double"), of(1))).otherwise(F.lit(1.0))
                    .alias("positive_weight"))


def _u(seed: int, *cols: Column) -> Column:
    """Repeatable uniform [0, 1) from a hash of seed and columns."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in cols]))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / float(16 ** 13)


def _interpolate(base: DataFrame, neigh: DataFrame, features: str, key: str, seed: int,
                 label: str, minority: int) -> DataFrame:
    """One synthetic row per ``(key, i)`` in ``base``: x + u * (neighbour - x)."""
    pick = F.floor(_u(seed, F.col(key), F.col("_i"), F.lit("nb")) * F.col("_k")).cast("int") + 1
    u = _u(seed, F.col(key), F.col("_i"), F.lit("gap"))
    chosen = base.withColumn("_nb_rank", pick).withColumn("_gap", u)
    nb = neigh.select(F.col("query").alias(key), F.col("rank").alias("_nb_rank"),
                      F.col("neighbour_vec").alias("_nv"))
    joined = chosen.join(nb, [key, "_nb_rank"])
    x, v = vector_to_array(F.col(features)), vector_to_array(F.col("_nv"))
    synth = F.zip_with(x, v, lambda a, b: a + F.col("_gap") * (b - a))
    return joined.select(key, array_to_vector(synth).alias(features), F.lit(minority).cast("int").alias(label),
                         F.col("_i").cast("int").alias("i"), F.lit(True).alias("synthetic"))


def _originals(df: DataFrame, key: str, features: str, label: str) -> DataFrame:
    return df.select(key, features, F.col(label).cast("int").alias(label), F.lit(0).alias("i"),
                     F.lit(False).alias("synthetic"))


def _own_neighbours(mino: DataFrame, k: int, key: str, features: str) -> DataFrame:
    """The nearest minority rows of every minority row, stored."""
    from attrition.operators.knn import knn
    return materialize(knn(mino, mino, k=k, key=key, features=features, exclude_self=True)
                       .select("query", "rank", "neighbour_vec"), "neighbours")


def smote(df: DataFrame, label: str = "Exited", features: str = "features", key: str = KEY,
          k: int = 5, seed: int = SEED_SAMPLER, once: Callable = made) -> DataFrame:
    """Add synthetic minority rows until both classes have the same count.

    Minority row j (in seeded hash order) makes ``floor(G / m) + [j < G mod m]``
    rows, G = majority - minority, m = minority count. Result: key, features, label, ``i``,
    ``synthetic``; a synthetic row has the key of the row it starts from and is told apart by
    ``i`` = 1, 2, ... (0 for an original). ``once``: see ``made``.
    """
    counts = label_counts(df, label)
    if len(counts) < 2:
        return _originals(df, key, features, label)
    minority = min(counts, key=lambda c: (counts[c], c))
    m, big = counts[minority], max(counts.values())
    g = big - m
    if g == 0:
        return _originals(df, key, features, label)
    if m < 2:
        raise ValueError("SMOTE needs two rows of the smaller class: one row has no neighbour")
    mino = df.where(F.col(label) == minority).select(key, features)
    neigh = once(("neighbours", minority, k), lambda: _own_neighbours(mino, k, key, features))
    # Position of each minority row in the seeded hash order (distributed rank).
    from attrition.operators.split import stratified_rank
    ranked = stratified_rank(mino.withColumn("_lbl", F.lit(1)), "_lbl", key, seed).drop("_lbl", "_n")
    per = F.lit(g // m) + ((F.col("_rank") - 1) < F.lit(g % m)).cast("int")
    kk = neigh.groupBy(F.col("query").alias(key)).agg(F.max("rank").alias("_k"))
    base = (ranked.withColumn("_cnt", per).where(F.col("_cnt") > 0)
            .join(kk, key)
            .withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_cnt")))))
    synth = _interpolate(base, neigh, features, key, seed, label, minority)
    return _originals(df, key, features, label).unionByName(synth)


def adasyn_allocation(df: DataFrame, label: str = "Exited", features: str = "features",
                      key: str = KEY, k: int = 5, seed: int = SEED_SAMPLER) -> DataFrame:
    """Per minority row: r = share of majority rows among its k nearest
    neighbours over all rows, normalised r / sum(r), and the number of
    synthetic rows ``round(r_norm * G)``."""
    from attrition.operators.knn import knn
    counts = label_counts(df, label)
    minority = min(counts, key=lambda c: (counts[c], c))
    g = max(counts.values()) - counts[minority]
    mino = df.where(F.col(label) == minority).select(key, features)
    everyone = df.select(key, features, label)
    neigh = knn(mino, everyone, k=k, key=key, features=features, exclude_self=True,
                carry=[label])
    r = materialize(neigh.groupBy(F.col("query").alias(key))
                    .agg((F.count(F.when(F.col(label) != minority, 1)) / F.lit(float(k))).alias("r")), "shares")
    total = r.agg(F.sum("r")).first()[0]
    if not total:
        raise ValueError("ADASYN finds no row of the larger class near the smaller one: "
                         "the classes are apart, nothing can be allocated")
    return r.select(key, "r", (F.col("r") / F.lit(total)).alias("r_norm"),
                    F.bround(F.col("r") / F.lit(total) * F.lit(float(g)), 0).cast("int").alias("n_synthetic"))


def adasyn(df: DataFrame, label: str = "Exited", features: str = "features", key: str = KEY,
           k: int = 5, seed: int = SEED_SAMPLER, once: Callable = made) -> DataFrame:
    """ADASYN: allocation by neighbourhood difficulty, then SMOTE interpolation
    towards minority neighbours. ``once``: see ``made``."""
    alloc = adasyn_allocation(df, label, features, key, k, seed)
    counts = label_counts(df, label)
    minority = min(counts, key=lambda c: (counts[c], c))
    mino = df.where(F.col(label) == minority).select(key, features)
    neigh = once(("neighbours", minority, k), lambda: _own_neighbours(mino, k, key, features))
    kk = neigh.groupBy(F.col("query").alias(key)).agg(F.max("rank").alias("_k"))
    base = (mino.join(alloc.where(F.col("n_synthetic") > 0), key).join(kk, key)
            .withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("n_synthetic")))))
    synth = _interpolate(base, neigh, features, key, seed, label, minority)
    return _originals(df, key, features, label).unionByName(synth)
