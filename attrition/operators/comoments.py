"""Pairwise correlations of many columns from blocked co-moment matrices.

A task turns its rows into a matrix and adds up matrix products only: for every pair of columns
the rows in which both are known, their sums, squares and products, around a value of each column
that is close to its middle. Tasks are merged by adding their rows of the matrices; nothing is
planned per pair. Columns go in blocks, so a task's sums stay bounded; a pass over two blocks reads
only their columns.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns of a block; a pass adds up seven matrices of this many columns squared.
BLOCK = 256
_PARTS = ["both", "sum", "sum_of", "square", "square_of", "product", "odd"]
_SHAPE = "place int, " + ", ".join(f"{p} array<double>" for p in _PARTS)


def _moments(left: int, middle: np.ndarray):
    """Sums over a task's rows; the first ``left`` columns meet the others (all meet all if none are left)."""
    a, b = slice(0, left), slice(left, None) if left < len(middle) else slice(0, left)

    def add(batches):
        total = np.zeros((len(_PARTS), left, len(middle) - left or left))
        for batch in batches:
            x = np.stack([np.asarray(c.fill_null(0.0)) for c in batch.columns], 1)
            known = np.stack([np.asarray(c.is_valid()) for c in batch.columns], 1).astype(float)
            odd = (~np.isfinite(x)).astype(float)
            x = np.where(odd > 0, 0.0, (x - middle) * known)
            total += [known[:, a].T @ known[:, b], x[:, a].T @ known[:, b], known[:, a].T @ x[:, b], (x[:, a] ** 2).T @ known[:, b],
                      known[:, a].T @ x[:, b] ** 2, x[:, a].T @ x[:, b], odd[:, a].T @ known[:, b] + known[:, a].T @ odd[:, b]]
        lists = [pa.array(list(t), pa.list_(pa.float64())) for t in total]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(left, dtype=np.int32)), *lists], names=["place", *_PARTS])
    return add


def _merged(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The tasks' rows of one column, added."""
    out = {"place": pa.array([key[0].as_py()], pa.int32())}
    for p in _PARTS:
        lists = table.column(p).combine_chunks()
        out[p] = pa.array([np.asarray(lists.flatten()).reshape(len(lists), -1).sum(0).tolist()], pa.list_(pa.float64()))
    return pa.table(out)


def correlations(df: DataFrame, columns: list[str], block: int = BLOCK) -> DataFrame:
    """``(row_feature, col_feature, r)`` for every pair of columns, the later one first; each pair over
    the rows that know both. r is null for fewer than two such rows or without variance, and NaN where
    one of them holds a NaN or an infinity."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    quoted = [f"`{c}`" for c in columns]
    finite = lambda c: F.when(~F.isnan(F.col(c).cast("double")) & (F.abs(F.col(c).cast("double")) < float("inf")), F.col(c).cast("double"))
    # A value of the column itself, so that a constant one has exactly no variance.
    of = df.agg(F.count(F.lit(1)), *[F.percentile_approx(finite(c), 0.5, 100).alias(f"m{i}") for i, c in enumerate(quoted)]).first()
    if not of[0]:
        none = [(b, a, None) for i, a in enumerate(columns) for b in columns[i + 1:]]
        return df.sparkSession.createDataFrame(none, "row_feature string, col_feature string, r double")
    middle = np.array([0.0 if m is None else m for m in of[1:]])
    starts = list(range(0, len(columns), block))
    out = None
    for i in starts:
        for j in [k for k in starts if k >= i]:
            one, two = columns[i:i + block], columns[j:j + block] if j > i else []
            both = [*range(i, i + len(one)), *range(j, j + len(two))]
            rows = df.select(*[F.col(quoted[k]).cast("double").alias(f"c{k}") for k in both])
            merged = rows.mapInArrow(_moments(len(one), middle[both]), _SHAPE).groupBy("place").applyInArrow(_merged, _SHAPE)
            names = F.array(*[F.lit(c) for c in (two or one)])
            each = merged.select("place", F.posexplode(F.arrays_zip(*_PARTS)).alias("other", "m")).select("place", "other", "m.*")
            if not two:
                each = each.where("other > place")
            n = F.nullif("both", F.lit(0.0))
            spread, spread_of = (F.col(q) - F.col(s) * F.col(s) / n for q, s in (("square", "sum"), ("square_of", "sum_of")))
            r = (F.col("product") - F.col("sum") * F.col("sum_of") / n) / F.sqrt(spread * spread_of)
            found = each.select(
                F.get(names, F.col("other")).alias("row_feature"), F.get(F.array(*[F.lit(c) for c in one]), F.col("place")).alias("col_feature"),
                F.when(F.col("odd") > 0, F.lit(float("nan"))).when((n >= 2) & (spread > 0) & (spread_of > 0), r).alias("r"))
            out = found if out is None else out.unionByName(found)
    return out
