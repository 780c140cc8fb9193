"""Repeatable stratified splits and folds.

Rows are ordered inside each label by ``md5('<seed>:' || key)``; the first
``floor(test_size * n_label + 0.5)`` rows are the test split and folds are
dealt round-robin along the same order. The order depends only on the key and
the seed, so the result is identical for any partitioning, across runs and
in a SQL engine.

Scale: a window over one label would sort half the data in one task. Rows
are bucketed by the first hex digits of their hash and a small per-bucket
count table (at most ``labels x 16**prefix`` rows, combined map-side) does the
global part:

* the split needs only the cutoff: the count table names the bucket holding
  the last test row, only that bucket's rows are ranked, and every row is then
  marked by a map-only comparison with the cutoff hash (no full shuffle);
* folds need every rank: each bucket's offset comes from the count table and
  the rank inside a bucket from a window partitioned by ``(label, bucket)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attrition.schema import KEY, N_FOLDS, SEED_SPLIT, TARGET, TEST_SIZE

_H, _B = "_split_hash", "_split_bucket"


def seeded_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def hash_uniform(key: str, seed: int) -> Column:
    """A repeatable uniform number in [0, 1) from the seeded key hash."""
    return F.conv(F.substring(seeded_hash(key, seed), 1, 13), 16, 10).cast("double") / float(16 ** 13)


def stratified_rank(df: DataFrame, label: str = TARGET, key: str = KEY,
                    seed: int = SEED_SPLIT, prefix_len: int = 4) -> DataFrame:
    """Add ``_rank`` (1-based position inside the label) and ``_n`` (label size)."""
    hashed = df.withColumn(_H, seeded_hash(key, seed)).withColumn(
        _B, F.substring(F.col(_H), 1, prefix_len))
    per_bucket = hashed.groupBy(label, _B).agg(F.count(F.lit(1)).alias("_cnt"))
    before = (Window.partitionBy(label).orderBy(_B)
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = per_bucket.select(
        label, _B, F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy(label)).alias("_n"))
    inside = Window.partitionBy(label, _B).orderBy(_H, key)
    # offsets has at most labels x 16**prefix_len rows whatever the data size.
    return (hashed.join(F.broadcast(offsets), [label, _B])
            .withColumn("_rank", F.col("_off") + F.row_number().over(inside))
            .drop(_H, _B, "_off"))


def test_count(n: Column, test_size: float) -> Column:
    return F.floor(n * F.lit(test_size) + F.lit(0.5))


def stratified_split(df: DataFrame, label: str = TARGET, key: str = KEY,
                     test_size: float = TEST_SIZE, seed: int = SEED_SPLIT,
                     exact: bool = True) -> DataFrame:
    """Add boolean ``is_test``. ``exact=False`` compares a per-row hash with
    ``test_size`` instead: no shuffle, expected (not exact) split sizes."""
    if not exact:
        return df.withColumn("is_test", hash_uniform(key, seed) < F.lit(test_size))
    # Only the cutoff is needed, not every rank: bucket counts find the bucket
    # holding the last test row, ranking that one bucket finds the exact
    # cutoff, and every row is then marked by a map-only comparison.
    hashed = df.withColumn(_H, seeded_hash(key, seed)).withColumn(_B, F.substring(F.col(_H), 1, 4))
    per_bucket = hashed.groupBy(label, _B).agg(F.count(F.lit(1)).alias("_cnt"))
    upto = Window.partitionBy(label).orderBy(_B).rowsBetween(Window.unboundedPreceding, 0)
    cum = per_bucket.select(label, _B, "_cnt", F.sum("_cnt").over(upto).alias("_cum"),
                            F.sum("_cnt").over(Window.partitionBy(label)).alias("_n"))
    need = test_count(F.col("_n"), test_size)
    # At most one row per label: bounded, broadcast.
    cut = (cum.where((F.col("_cum") - F.col("_cnt") < need) & (F.col("_cum") >= need))
           .select(label, _B, (need - (F.col("_cum") - F.col("_cnt"))).alias("_need")))
    in_bucket = Window.partitionBy(label).orderBy(_H, key)
    cutoff = (hashed.join(F.broadcast(cut), [label, _B])
              .withColumn("_r", F.row_number().over(in_bucket))
              .where(F.col("_r") == F.col("_need"))
              .select(label, F.col(_H).alias("_cut_h"), F.col(key).alias("_cut_k")))
    marked = hashed.join(F.broadcast(cutoff), label, "left").withColumn(
        "is_test", F.coalesce((F.col(_H) < F.col("_cut_h"))
                              | ((F.col(_H) == F.col("_cut_h")) & (F.col(key) <= F.col("_cut_k"))),
                              F.lit(False)))
    return marked.drop(_H, _B, "_cut_h", "_cut_k")


def stratified_folds(df: DataFrame, k: int = N_FOLDS, label: str = TARGET, key: str = KEY,
                     seed: int = SEED_SPLIT, exact: bool = True) -> DataFrame:
    """Add ``fold`` in 0..k-1, dealt round-robin along the seeded order inside
    each label, so every fold has the label mix of the whole."""
    if not exact:
        return df.withColumn("fold", (F.floor(hash_uniform(key, seed) * k)).cast("int"))
    ranked = stratified_rank(df, label, key, seed)
    return ranked.withColumn("fold", ((F.col("_rank") - 1) % k).cast("int")).drop("_rank", "_n")


def split_frames(df: DataFrame, **kw) -> tuple[DataFrame, DataFrame]:
    s = stratified_split(df, **kw)
    return s.where(~F.col("is_test")).drop("is_test"), s.where(F.col("is_test")).drop("is_test")
