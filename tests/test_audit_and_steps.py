"""Mergeable audit sketches, the exact audit without Expand, and feature steps that are saved by name."""

import datetime
import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from attrition.operators import audit, models
from attrition.operators.preprocess import feature_names, step
from attrition.schema import NUM_FEATURES
from attrition.sources.profile import customer_profile
from conftest import SF_SMALL


def odd_rows(spark):
    day = datetime.datetime(2024, 10, 27)
    rows = [(1, 0.0, "a", True, day, [1], bytearray(b"x")), (2, -0.0, "a", None, day + datetime.timedelta(hours=1), [1], bytearray(b"x")),
            (None, float("nan"), "", False, day + datetime.timedelta(hours=2), [2], None), (2, float("nan"), None, False, None, None, bytearray(b"y"))]
    return spark.createDataFrame(rows, "i int, `d d` double, s string, b boolean, t timestamp, a array<int>, y binary")


def test_exact_audit_plans_no_expand(spark):
    frame = odd_rows(spark)
    out = audit.column_audit(frame)
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r["column"]: (r["nulls"], r["distinct"]) for r in out.collect()}
    assert got == {"i": (1, 2), "d d": (0, 2), "s": (1, 2), "b": (1, 2), "t": (1, 3), "a": (1, 2), "y": (1, 2)}
    bounds = {r["column"]: (r["min"], r["max"]) for r in out.collect()}
    assert bounds["i"] == (1.0, 2.0) and bounds["s"] == (None, None) and math.isnan(bounds["d d"][1])
    empty = {r["column"]: (r["nulls"], r["distinct"], r["min"]) for r in audit.column_audit(frame.where("1 = 0")).collect()}
    assert set(empty.values()) == {(0, 0, None)}


def test_day_one_and_day_two_make_the_whole(spark, tmp_path):
    whole = spark.range(60_000).select("id", (F.col("id") % 700).alias("few"), F.when(F.col("id") % 3 > 0, F.col("id") / 7).alias("some"),
                                       F.lit(None).cast("string").alias("none"))
    days = [whole.where("id < 35000"), whole.where("id >= 30000")]
    for i, d in enumerate(days):
        audit.column_sketches(d).write.parquet(str(tmp_path / str(i)))
    merged = audit.merge_sketches(*[spark.read.parquet(str(tmp_path / str(i))) for i in (0, 1)])
    got = {r["column"]: r for r in audit.audit_of(merged).collect()}
    exact = {r["column"]: r for r in audit.column_audit(days[0].unionByName(days[1])).collect()}
    assert got.keys() == exact.keys()
    for c, r in exact.items():
        assert (got[c]["position"], got[c]["dtype"], got[c]["nulls"], got[c]["min"], got[c]["max"]) == (r["position"], r["dtype"], r["nulls"], r["min"], r["max"])
        assert abs(got[c]["distinct"] - r["distinct"]) <= 4 * audit.SKETCH_ERROR * r["distinct"]
    assert {r["rows"] for r in merged.collect()} == {65_000}
    assert {r["column"] for r in audit.column_audit(whole, exact=False).collect()} == set(whole.columns)


def wealth(df):
    """A feature step: two columns at once."""
    return df.withColumns({"Wealth": F.col("Balance") + F.col("EstimatedSalary"), "IsOld": (F.col("Age") > 60).cast("int")})


def test_steps_are_saved_by_name(spark, tmp_path):
    profile = customer_profile(spark, SF_SMALL)
    name = f"{wealth.__module__}:wealth"
    m = models.build_pipeline(models.logistic(weighted=True), num_features=[*NUM_FEATURES, "Wealth"], passthrough_features=["IsOld"],
                              weight_mode="balanced", extra_features={"WealthPerAge": "Wealth / (Age + 1)"}, steps=[name]).fit(profile)
    assert {"Wealth", "IsOld", "WealthPerAge"} <= set(feature_names(m))
    m.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert again.stages[0].getOrDefault("steps") == [name]
    a, b = (models.score(x, profile).orderBy("CustomerId").collect() for x in (m, again))
    assert a == b
    with pytest.raises(ValueError, match="module:function"):
        step("wealth")
    with pytest.raises(AttributeError):
        step(f"{wealth.__module__}:missing")
