"""Published outputs of the reference workflow, recomputed by our operators."""

import os

import pytest
from pyspark.sql import functions as F

from attrition.functions import decisions as D
from attrition.functions.features import age_group
from attrition.operators import curves, errors, search
from conftest import REF

PRED = os.path.join(REF, "models/test_predictions.csv")
pytestmark = pytest.mark.skipif(not os.path.exists(PRED), reason="reference outputs absent")


@pytest.fixture(scope="module")
def golden(spark):
    df = (spark.read.schema("actual INT, predicted INT, probability DOUBLE, correct BOOLEAN")
          .option("header", True).csv(PRED))
    return df.select(F.col("actual").alias("y"), F.col("probability").alias("p"),
                     F.monotonically_increasing_id().alias("CustomerId")).cache()


def test_threshold_and_metrics(golden):
    best = curves.best_threshold(golden).first()
    assert best["threshold"] == pytest.approx(0.44155844155844143, abs=1e-15)
    assert best["precision"] == pytest.approx(0.72)
    assert best["recall"] == pytest.approx(0.6176470588235294)
    t = best["threshold"]
    pm = curves.point_metrics(golden, t).first()
    assert (pm["tn"], pm["fp"], pm["fn"], pm["tp"]) == (747, 49, 78, 126)
    assert pm["f1"] == pytest.approx(0.6649076517150396, abs=1e-12)
    assert pm["accuracy"] == pytest.approx(0.873)
    auc = curves.roc_auc(golden).first()["roc_auc"]
    assert auc == pytest.approx(0.8773955562124347, abs=1e-15)
    assert golden.select("p").distinct().count() == 45


def test_targets_status(golden):
    t = curves.best_threshold_value(golden)
    rows = {r["Metric"]: r for r in curves.targets_status(golden, t).collect()}
    assert rows["ROC-AUC"]["Status"] == "PASS" and rows["F1"]["Status"] == "PASS"
    assert rows["Recall"]["Status"] == "PASS" and rows["Precision"]["Status"] == "PASS"
    assert rows["Recall"]["Score"] == pytest.approx(0.6176470588235294)


def test_calibration_bins(golden):
    got = {r["bin"]: r for r in curves.calibration_curve(golden).collect()}
    expect = {0: (577, .041605, .05026), 1: (93, .152576, .129032), 2: (114, .234545, .219298),
              3: (15, .338308, .333333), 4: (67, .432739, .41791), 5: (40, .557138, .55),
              6: (7, .684982, .428571), 7: (15, .79807, .866667), 8: (34, .867236, .911765),
              9: (38, .978797, .947368)}
    assert set(got) == set(expect)
    for b, (n, mp, fy) in expect.items():
        assert got[b]["n"] == n
        assert got[b]["mean_predicted"] == pytest.approx(mp, abs=5e-6)
        assert got[b]["fraction_positive"] == pytest.approx(fy, abs=5e-6)


def test_confidence_and_risk(golden):
    t = curves.best_threshold_value(golden)
    conf = dict(golden.groupBy(D.confidence("p", t).alias("c")).count().collect())
    assert conf == {"Strong": 762, "Moderate": 171, "Borderline": 67}
    single = dict(golden.groupBy(D.risk_label("p", t).alias("r")).count().collect())
    assert single == {"High": 175, "Elevated": 41, "Low": 784}
    batch = dict(golden.groupBy(D.risk_band("p", t).alias("r")).count().collect())
    assert batch == {"High": 134, "Elevated": 82, "Low": 780, None: 4}


def test_error_breakdown(spark):
    path = os.path.join(REF, "reports/error_analysis.csv")
    df = (spark.read.option("header", True).option("inferSchema", True).csv(path)
          .withColumn("AgeGroup", age_group("Age")))
    got = {(r["dimension"], r["value"], r["error_type"]): r["count"]
           for r in errors.error_breakdown(df).collect()}
    fn, fp = "False Negative", "False Positive"
    for geo, (a, b) in {"France": (32, 18), "Germany": (25, 23), "Spain": (21, 8)}.items():
        assert got[("Geography", geo, fn)] == a and got[("Geography", geo, fp)] == b
    assert got[("AgeGroup", "Young", fn)] == 32 and ("AgeGroup", "Young", fp) not in got
    assert got[("AgeGroup", "Middle", fn)] == 41 and got[("AgeGroup", "Middle", fp)] == 45
    assert got[("AgeGroup", "Senior", fn)] == 5 and got[("AgeGroup", "Senior", fp)] == 4
    assert got[("NumOfProducts", "1", fn)] == 53 and got[("NumOfProducts", "1", fp)] == 42


def test_tournament_composite(spark):
    path = os.path.join(REF, "reports/tournament_results.csv")
    df = (spark.read.schema("Model STRING, Strategy STRING, `ROC-AUC` DOUBLE, F1 DOUBLE, "
                            "Recall DOUBLE, Score DOUBLE").option("header", True).csv(path))
    ranked = search.rank_results(df.withColumnRenamed("Score", "published")).collect()
    assert len(ranked) == 18
    for r in ranked:
        assert r["Score"] == pytest.approx(r["published"], abs=1e-12)
    top = [r for r in ranked if r["rank"] == 1][0]
    assert top["Score"] == pytest.approx(0.7067788067, abs=1e-9)
    under = [r for r in ranked if r["Recall"] < 0.60]
    assert len(under) == 12
