"""Hand-written edge rows (FIXTURES.md section 4)."""

import pytest
from pyspark.sql import functions as F

from attrition.functions import decisions as D
from attrition.functions.features import age_group
from attrition.operators import curves, decide, explain, search
from attrition.operators.preprocess import DropFirstOneHot, PopulationScaler


def test_age_bins(spark):
    df = spark.createDataFrame([(a,) for a in [0, 1, 35, 36, 55, 56, 100, 101, None]], "Age int")
    got = [r[0] for r in df.select(age_group("Age")).collect()]
    assert got == ["nan", "Young", "Young", "Middle", "Middle", "Senior", "Senior", "nan", "nan"]


def test_bands_edges(spark):
    t = 0.1  # t < 0.15: the Low band is empty
    ps = [0.0, t - 0.15, t - 0.10, t, t + 0.10, t + 0.25, 1.0]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    band = [r[0] for r in df.select(D.risk_band("p", t)).collect()]
    assert band == [None, None, None, "Elevated", "High", "High", "High"]
    t = 0.5
    df = spark.createDataFrame([(p,) for p in [0.0, 0.35, 0.36, 0.5, 0.6, 1.0]], "p double")
    band = [r[0] for r in df.select(D.risk_band("p", t)).collect()]
    single = [r[0] for r in df.select(D.risk_label("p", t)).collect()]
    assert band == [None, "Low", "Elevated", "Elevated", "High", "High"]
    # |0.35 - 0.5| is 0.15000000000000002 in floating point, as in the app.
    assert single == ["Low", "Low", "Elevated", "High", "High", "High"]


def test_unseen_category_and_flat_column(spark):
    fit = spark.createDataFrame([("France", 1.0), ("Germany", 1.0), ("Spain", 1.0)],
                                "Geography string, x double")
    enc = DropFirstOneHot(["Geography"]).fit(fit)
    assert enc.output_names() == ["Geography_Germany", "Geography_Spain"]
    out = enc.transform(spark.createDataFrame([("Italy",), ("Spain",)], "Geography string"))
    rows = [(r["Geography_Germany"], r["Geography_Spain"]) for r in out.collect()]
    assert rows == [(0.0, 0.0), (0.0, 1.0)]
    sc = PopulationScaler(["x"]).fit(fit)
    assert sc.parameters() == [("x", 1.0, 1.0)]
    assert [r[0] for r in sc.transform(fit).select("x").collect()] == [0.0, 0.0, 0.0]


def test_recall_floor_unreachable_falls_back(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (0, 0.7), (1, 0.1)], "y int, p double")
    best = curves.best_threshold(df, recall_floor=1.1).first()
    # No point meets the floor: best F1 overall, lowest threshold among ties.
    curve = curves.pr_curve(df, with_end_point=False).collect()
    top = max(r["f1"] for r in curve)
    assert best["f1"] == pytest.approx(top) and not best["meets_floor"]


def test_one_class_and_all_negative(spark):
    neg = spark.createDataFrame([(0, 0.2), (0, 0.4)], "y int, p double")
    assert curves.roc_auc(neg).first()["roc_auc"] is None
    pm = curves.point_metrics(neg, 0.3).first()
    assert (pm["precision"], pm["recall"], pm["f1"]) == (0.0, 0.0, 0.0)
    pr = curves.pr_curve(neg).where(F.col("threshold").isNotNull()).collect()
    assert all(r["recall"] == 1.0 for r in pr)


def test_recommendations_edges(spark):
    rows = [(1, 0, "Geography_Germany", 0.0, -0.2), (1, 1, "Balance", 0.0, -0.1),
            (2, 0, "AgeGroup_Young", 0.0, 0.3), (2, 1, "Age", 0.0, 0.2),
            (2, 2, "Unknown", 0.0, 0.5), (3, 0, "Unknown", 0.0, 0.4)]
    shap = spark.createDataFrame(rows, "CustomerId long, feature_idx int, feature string, "
                                       "value double, shap double")
    prob = spark.createDataFrame([(1, 0.9), (2, 0.8), (3, 0.7), (4, 0.1)],
                                 "CustomerId long, probability double")
    got = {}
    for r in decide.recommendations(shap, prob, 0.5).collect():
        got.setdefault(r["CustomerId"], []).append((r["rank"], r["title"], r["feature"]))
    # No positive shap: every feature is a candidate, descending shap.
    assert [t for _, t, _ in sorted(got[1])] == ["Balance re-engagement", "Regional retention action"]
    # AgeGroup_Young matches the key Age first; same title kept once.
    assert sorted(got[2]) == [(1, "Segment-appropriate outreach", "AgeGroup_Young")]
    assert got[3] == [(1, "General retention", None)]
    assert 4 not in got


def test_best_so_far_and_composite(spark):
    trials = spark.createDataFrame([(0, 0.5), (1, 0.5), (2, 0.7), (3, None), (4, 0.6), (5, 0.8)],
                                   "trial int, score double")
    got = [r["trial"] for r in search.best_so_far(trials).orderBy("trial").collect()]
    assert got == [0, 2, 5]
    metrics = spark.createDataFrame(
        [("A", "x", 0.5, 0.7, 0.8), ("B", "y", 0.5, 0.7, 0.8), ("C", "x", 0.6, 0.55, 0.9)],
        "Model string, Strategy string, F1 double, Recall double, `ROC-AUC` double")
    ranked = search.rank_results(metrics).orderBy("rank").collect()
    assert [r["Model"] for r in ranked] == ["A", "B", "C"]
    assert ranked[0]["Score"] == pytest.approx(0.35 * 0.5 + 0.4 * 0.7 + 0.25 * 0.8)
    assert [r["Model"] for r in search.rank_results(metrics, 0.60).collect()] == ["A", "B"]


def test_top_factors_and_mean_abs(spark):
    rows = [(1, i, f"f{i}", 0.0, s) for i, s in enumerate([0.1, -0.5, 0.3, 0.3, -0.05, 0.2])]
    shap = spark.createDataFrame(rows, "CustomerId long, feature_idx int, feature string, "
                                       "value double, shap double")
    top = decide.top_factors(shap).orderBy("rank").collect()
    assert [r["feature"] for r in top] == ["f1", "f3", "f2", "f5", "f0"]
    assert top[0]["direction"] == "Reduces Risk" and top[1]["direction"] == "Increases Risk"
    imp = explain.mean_abs_shap(shap, 2).collect()
    assert [r["feature"] for r in imp] == ["f1", "f2"]
