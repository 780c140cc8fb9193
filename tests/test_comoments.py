"""Blocked co-moments against Spark's own correlation, pair by pair."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from attrition.operators import comoments, eda


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((600, 7)) @ rng.standard_normal((7, 7)) * 10.0 ** np.arange(7) + 1e6
    rows = [[None if rng.random() < 0.1 * (j % 3) else float(v) for j, v in enumerate(r)] for r in x]
    rows = [[*r, 4.25, None if i else 1.0, int(r[0] or 0)] for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, ", ".join(f"`c {j}` double" for j in range(9)) + ", n long").repartition(5)


@pytest.mark.parametrize("block", [256, 4, 3])
def test_pairs(frame, block):
    got = {(r["row_feature"], r["col_feature"]): r["r"] for r in comoments.correlations(frame, frame.columns, block).collect()}
    pairs = [(b, a) for i, a in enumerate(frame.columns) for b in frame.columns[i + 1:]]
    assert set(got) == set(pairs)
    for a, b in pairs:
        both = frame.where(F.col(f"`{a}`").isNotNull() & F.col(f"`{b}`").isNotNull()).select(f"`{a}`", f"`{b}`").toPandas().to_numpy(float)
        if len(both) < 2 or (both.std(0) == 0).any():
            assert got[a, b] is None
        else:
            assert got[a, b] == pytest.approx(np.corrcoef(both.T)[0, 1], abs=1e-9)


def test_many_columns_plan_no_aggregate_per_pair(spark):
    wide = spark.range(300).select(*[(F.sin(F.col("id") * (j + 1)) + F.lit(float(j))).alias(f"x{j}") for j in range(300)])
    out = eda.correlation_matrix(wide)
    assert out.count() == 300 * 299 // 2
    plan = out._jdf.queryExecution().toString()
    assert plan.count("corr(") == 0
    r = out.where("row_feature = 'x5' and col_feature = 'x2'").first()["r"]
    i = np.arange(300)
    assert r == pytest.approx(np.corrcoef(np.sin(i * 6), np.sin(i * 3))[0, 1], abs=1e-9)


def test_odd_values(spark):
    rows = [(1.0, float("nan"), 2.0), (2.0, 1.0, None), (3.0, 5.0, 4.0), (4.0, 2.0, 5.0)]
    frame = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r["row_feature"], r["col_feature"]): r["r"] for r in comoments.correlations(frame, ["a", "b", "c"]).collect()}
    assert math.isnan(got["b", "a"]) and math.isnan(got["c", "b"]) and got["c", "a"] == pytest.approx(np.corrcoef([1, 3, 4], [2, 4, 5])[0, 1])
    empty = comoments.correlations(frame.where("1 = 0"), ["a", "b"]).collect()
    assert [tuple(r) for r in empty] == [("b", "a", None)]
