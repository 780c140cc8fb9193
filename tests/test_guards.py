"""Edges that once stopped a job or gave wrong rows."""

import math
import os
import threading
import uuid

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from attrition.functions.features import engineer
from attrition.operators import calibrate, curves, decide, imbalance, models, search
from attrition.operators.preprocess import feature_names
from attrition.plans.scoring import score_batch
from attrition.plans.training import N_TRIALS, SEARCH_SPACES, comparison_grid
from attrition.session import checkpoint_dir
from attrition.sources import files
from attrition.sources.profile import customer_profile
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def profile(spark):
    return customer_profile(spark, SF_SMALL).cache()


@pytest.fixture(scope="module")
def fitted(profile):
    return models.strategy_pipeline("Logistic Regression", "class_weight").fit(profile)


def test_quotients_by_zero(spark):
    rows = [(1.0, -1.0, 2, -1, 0, 1, 40), (0.0, -1.0, 0, -1, 1, 1, 40), (None, 4.0, 1, 1, 1, 1, 40)]
    got = engineer(spark.createDataFrame(
        rows, "Balance double, EstimatedSalary double, NumOfProducts int, Tenure int, IsActiveMember int, "
              "HasCrCard int, Age int")).select("BalanceSalaryRatio", "ProductsPerYear").collect()
    assert got[0][0] == math.inf and got[0][1] == math.inf
    assert math.isnan(got[1][0]) and math.isnan(got[1][1])
    assert got[2][0] is None and got[2][1] == 0.5


def test_batch_keeps_repeated_keys_without_a_join(profile, fitted):
    twice = profile.unionByName(profile)
    out = score_batch(twice, fitted, 0.5)
    assert out.count() == 2 * profile.count()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan.split("InMemoryRelation")[0]


def test_batch_result_shows_raw_inputs(profile, fitted):
    a = score_batch(profile, fitted, 0.5).select("CustomerId", "Balance").orderBy("CustomerId").collect()
    assert a == profile.select("CustomerId", "Balance").orderBy("CustomerId").collect()


def test_auc_beyond_a_long(spark):
    """Two billion rows a class, as counts: the products leave a 64-bit integer."""
    n = 2_200_000_000
    cum = spark.createDataFrame([(0.9, n, n, 0), (0.1, n, 0, n)], "threshold double, n long, pos long, neg long")
    twice = curves._wide(F.col("pos")) * curves._wide(2 * F.lit(n) + F.col("neg"))
    assert cum.agg(F.sum(twice)).first()[0] == 2 * n * n


def test_one_class_fold(spark):
    df = spark.createDataFrame([(0, 1, 0.9), (0, 0, 0.2), (1, 0, 0.3), (1, 0, 0.1)], "fold int, y int, p double")
    got = {r["fold"]: r for r in curves.metrics_by_fold(df).collect()}
    assert got[0]["roc_auc"] == 1.0 and got[1]["roc_auc"] is None and got[1]["recall"] == 0.0
    assert search.mean_fold_f1(df) == 0.5


def _points(spark, rows):
    return spark.createDataFrame([(k, [float(v) for v in x], y) for k, x, y in rows],
                                 "CustomerId long, a array<double>, Exited int").select(
        "CustomerId", array_to_vector("a").alias("features"), "Exited")


def test_samplers_say_what_is_missing(spark):
    one = _points(spark, [(i, (i, 1), int(i == 0)) for i in range(6)])
    with pytest.raises(ValueError, match="no neighbour"):
        imbalance.smote(one)
    apart = _points(spark, [(i, (i * 0.01 + 100 * (i < 8), 0), int(i < 8)) for i in range(30)])
    with pytest.raises(ValueError, match="apart"):
        imbalance.adasyn_allocation(apart, k=3)


def test_large_and_negative_keys_resample(spark):
    rng = np.random.default_rng(1)
    keys = [10 ** 15 + 7, 10 ** 17, -5, 0, *range(1, 21)]
    df = _points(spark, [(k, rng.normal(size=2), int(i < 4)) for i, k in enumerate(keys)])
    out = imbalance.smote(df, k=2)
    assert out.count() == 40 and out.select("CustomerId", "i").distinct().count() == 40
    assert {r[0] for r in out.where("synthetic").select("CustomerId").collect()} <= set(keys[:4])


def test_saved_pair_is_consistent(spark, profile, fitted):
    scores = models.score(fitted, profile)
    cal = calibrate.fit_isotonic(scores)
    t = curves.best_threshold_value(calibrate.apply_isotonic(cal, scores), "y", "p_cal")
    folder = os.path.join(checkpoint_dir(spark), f"guards-{uuid.uuid4().hex}")
    preds = spark.createDataFrame([(1, 1, 0.7, True)], "actual int, predicted int, probability double, correct boolean")
    failed = []

    def save():  # a worker thread has no active session
        try:
            files.save_model(fitted, t, folder, "lr", cal, preds)
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    worker = threading.Thread(target=save)
    worker.start()
    worker.join()
    assert not failed
    model, t2, name = files.load_model(spark, folder)
    again = calibrate.apply_isotonic(files.load_calibrator(spark, folder, name), models.score(model, profile))
    here = calibrate.apply_isotonic(cal, scores)
    gap = again.join(here.select("CustomerId", F.col("p_cal").alias("q")), "CustomerId").agg(
        F.max(F.abs(F.col("p_cal") - F.col("q")))).first()[0]
    assert t2 == t and gap < 1e-12
    assert files.load_predictions(spark, folder, "lr").count() == 1
    files.save_model(fitted, 0.4, folder, "plain", spark=spark)
    assert files.load_calibrator(spark, folder, "plain") is None


def test_broken_threshold_is_an_error(spark, fitted):
    folder = os.path.join(checkpoint_dir(spark), f"guards-{uuid.uuid4().hex}")
    base = files.save_model(fitted, 0.3, folder, "m", spark=spark)
    bad = os.path.join(base, "threshold")
    for f in os.listdir(bad):
        if f.endswith(".parquet"):
            open(os.path.join(bad, f), "w").write("not parquet")
            open(os.path.join(bad, f".{f}.crc"), "w").write("")
    with pytest.raises(Exception):
        files.load_model(spark, folder)


def test_isotonic_from_counts_equals_rows(spark):
    rng = np.random.default_rng(2)
    p = rng.integers(0, 20, 400) / 20
    y = (rng.random(400) < p).astype(int)
    m = calibrate.fit_isotonic(spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p double"))
    got = dict(zip(m.boundaries.toArray(), m.predictions.toArray()))
    # Pool adjacent violators by hand.
    blocks = [[y[p == v].mean(), float((p == v).sum()), [v]] for v in np.unique(p)]
    done = []
    for b in blocks:
        done.append(b)
        while len(done) > 1 and done[-2][0] >= done[-1][0]:
            (m2, w2, v2), (m1, w1, v1) = done.pop(), done.pop()
            done.append([(m1 * w1 + m2 * w2) / (w1 + w2), w1 + w2, v1 + v2])
    for mean, _, values in done:
        for v in values:
            if v in got:
                assert got[v] == pytest.approx(mean)


def test_extra_features_through_the_pipeline(spark, profile):
    pipe = models.build_pipeline(models.logistic(), extra_features={"AgeBalance": "Age * Balance"})
    m = pipe.fit(profile)
    assert "AgeBalance" in feature_names(m)
    path = os.path.join(checkpoint_dir(spark), f"guards-{uuid.uuid4().hex}")
    m.write().overwrite().save(path)
    loaded = type(m).load(path)
    a = models.score(m, profile).orderBy("CustomerId").collect()
    assert a == models.score(loaded, profile).orderBy("CustomerId").collect()


def test_full_sizes_are_the_default():
    grid = {(f, s): make() for f, s, make in comparison_grid()}
    assert len(grid) == 9 and N_TRIALS == 150
    assert grid["Random Forest", "SMOTE"].classifier.getNumTrees() == 200
    assert grid["Boosted Trees", "SMOTE"].classifier.getMaxIter() == 100
    assert set(SEARCH_SPACES["Random Forest"]) == {"num_trees", "max_depth", "min_instances", "feature_subset"}
    assert models.logistic(penalty=None).getRegParam() == 0.0


def test_weights_and_actions_come_from_the_caller(spark):
    table = spark.createDataFrame([("A", "x", 0.9, 0.1, 0.5), ("B", "x", 0.1, 0.9, 0.5)],
                                  "Model string, Strategy string, F1 double, Recall double, `ROC-AUC` double")
    first = lambda w: search.rank_results(table, weights=w).orderBy("rank").first()["Model"]
    assert first({"F1": 1, "Recall": 0, "ROC-AUC": 0}) == "A" and first({"F1": 0, "Recall": 1, "ROC-AUC": 0}) == "B"
    shap = spark.createDataFrame([(1, 0, "Zeal", 0.0, 0.4)], "CustomerId long, feature_idx int, feature string, value double, shap double")
    prob = spark.createDataFrame([(1, 0.9)], "CustomerId long, probability double")
    got = decide.recommendations(shap, prob, 0.5, actions=[("Zeal", "Own title", "Own text")]).first()
    assert (got["title"], got["text"]) == ("Own title", "Own text")


def test_probabilities_round_half_even(spark):
    from attrition.functions import decisions
    rows = [(x,) for x in (0.00005, 0.00015, 0.00025, 0.12345, 0.12355, 0.99995, 0.123449999)]
    got = [r[0] for r in spark.createDataFrame(rows, "p double").select(decisions.round_probability("p")).collect()]
    assert got == [0.0, 0.0002, 0.0002, 0.1234, 0.1236, 1.0, 0.1234]


def test_correlation_takes_all_numeric_columns(spark):
    from attrition.operators import eda
    df = spark.createDataFrame([(1, 2.0, "x"), (2, 4.1, "y"), (3, None, "z"), (4, 8.2, "x")], "a int, b double, c string")
    got = eda.correlation_matrix(df).collect()
    assert [(r["row_feature"], r["col_feature"]) for r in got] == [("b", "a")]
    assert got[0]["r"] == pytest.approx(np.corrcoef([1, 2, 4], [2.0, 4.1, 8.2])[0, 1])
