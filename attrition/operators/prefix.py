"""Cumulative sums over a globally ordered column without a single-partition window.

A running total over "all rows with a larger score" is a global order. Spark
would run ``Window.orderBy(...)`` without ``partitionBy`` in one task, which does
not survive a billion distinct scores. Instead:

1. cut the value range into quantile buckets (one ``percentile_approx`` pass,
   the bucket edges are a bounded array),
2. total every bucket (at most ``num_buckets`` rows, so broadcasting the
   offsets is safe whatever the data size),
3. run the window inside each bucket and add the bucket's offset.

Each bucket holds about ``1/num_buckets`` of the distinct values, so the work is
spread evenly even when the scores are tie-heavy.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "_pfx_bucket"


def _bucket_edges(df: DataFrame, col: str, num_buckets: int) -> list[float]:
    qs = [i / num_buckets for i in range(1, num_buckets)]
    row = df.agg(F.percentile_approx(F.col(col).cast("double"), qs, 10 * num_buckets)
                 .alias("q")).first()
    inner = sorted({float(v) for v in (row["q"] or []) if v is not None}) or [0.0]
    return [float("-inf"), *inner, float("inf")]


def prefix_sums(df: DataFrame, order_col: str, sum_cols: list[str], *,
                descending: bool = True, suffix: str = "_cum",
                partition_by: list[str] | None = None,
                num_buckets: int | None = None) -> DataFrame:
    """Add ``<col><suffix>`` = sum of ``col`` over rows whose ``order_col`` is
    at or beyond this row's (>= when descending, <= when ascending), ties
    included, separately per ``partition_by`` group (a handful of groups such as
    folds). ``order_col`` should be non-null."""
    rows = bucketed(df, order_col, num_buckets)
    totals = rows.groupBy(*(partition_by or []), BUCKET).agg(*[F.sum(c).alias(c) for c in sum_cols])
    return cumulated(rows, totals, order_col, sum_cols, descending, suffix, partition_by).select(
        *df.columns, *[f"{c}{suffix}" for c in sum_cols])


def bucketed(df: DataFrame, order_col: str, num_buckets: int | None = None) -> DataFrame:
    """Rows with the bucket of ``order_col`` (as double)."""
    if num_buckets is None:
        # As many buckets as the session plans shuffle partitions (x2), so the
        # in-bucket windows use the whole cluster; a cluster sizes that setting
        # to its data.
        shuffle = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
        num_buckets = max(16, 2 * shuffle)
    edges = _bucket_edges(df, order_col, num_buckets)
    return Bucketizer(splits=edges, inputCol=order_col, outputCol=BUCKET,
                      handleInvalid="keep").transform(
        df.withColumn(order_col, F.col(order_col).cast("double")))


def cumulated(rows: DataFrame, totals: DataFrame, order_col: str, sum_cols: list[str],
              descending: bool = True, suffix: str = "_cum",
              partition_by: list[str] | None = None) -> DataFrame:
    """``prefix_sums`` over bucketed rows whose bucket totals are known."""
    parts = list(partition_by or [])
    keys = [*parts, BUCKET]
    # Offsets of whole buckets strictly beyond this one: groups x buckets rows.
    beyond = Window.orderBy(F.col(BUCKET).desc() if descending else F.col(BUCKET))
    if parts:
        beyond = beyond.partitionBy(*parts)
    beyond = beyond.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, *[F.coalesce(F.sum(c).over(beyond), F.lit(0))
                                     .alias(f"_off_{c}") for c in sum_cols])
    within = (Window.partitionBy(*keys)
              .orderBy(F.col(order_col).desc() if descending else F.col(order_col))
              .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    # The offsets table is bounded by groups x num_buckets rows, never by data.
    out = rows.join(F.broadcast(offsets), keys)
    return out.select(*rows.columns, *[(F.sum(c).over(within) + F.col(f"_off_{c}"))
                                       .alias(f"{c}{suffix}") for c in sum_cols])
