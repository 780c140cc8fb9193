"""The batched logistic solver against Spark's own fits, fold by fold, and against a plain search."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler  # noqa: F401
from pyspark.sql import functions as F

from attrition.operators import batch_logistic as B
from attrition.operators import models, search
from attrition.operators.preprocess import feature_names
from attrition.plans.training import SEARCH_SPACES, prepare
from attrition.sources.profile import customer_profile

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folded(spark):
    return prepare(customer_profile(spark, "/root/testdata/sf0.01"))[0].cache()


@pytest.fixture(scope="module")
def of(folded):
    return B.design(folded)


@pytest.mark.parametrize("fit", [B.Fit(None, 1.0, "l2", "balanced"), B.Fit(2, 0.01, "l2", "positive"), B.Fit(4, 30.0, "l2", None),
                                 B.Fit(0, 1.0, None, "balanced")])
def test_coefficients_are_sparks(folded, of, fit):
    mine = B.fit_all(of, [fit, B.Fit(1, 0.5)])[0]
    train = folded.where(F.col("fold") != F.lit(fit.fold if fit.fold is not None else -1)).drop("fold")
    clf = models.logistic(C=fit.C, penalty=fit.penalty, weighted=fit.weight_mode is not None, tol=1e-13, max_iter=2000)
    model = models.build_pipeline(clf, weight_mode=fit.weight_mode).fit(train)
    assert mine.names == feature_names(model) and mine.gradient <= B.TOLERANCE
    theirs = model.stages[-1]
    assert np.abs(mine.coefficients - theirs.coefficients.toArray()).max() < 1e-6
    assert abs(mine.intercept - theirs.intercept) < 1e-6


def test_held_out_scores_are_those_of_each_folds_pipeline(folded, of):
    fits, trials = B.trial_fits(of, [{"C": 0.1}, {"C": 10.0, "penalty": None}])
    scored = B.held_out_scores(of, fits, B.fit_all(of, fits), trials)
    assert scored.count() == 2 * folded.count()
    oof = search.out_of_fold(lambda: models.strategy_pipeline("Logistic Regression", "class_weight", C=0.1, tol=1e-13, max_iter=2000), folded)
    away = (scored.where("trial = 0").join(oof.select(F.col("CustomerId").alias("key"), F.col("p").alias("q")), "key")
            .agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0])
    assert away < 1e-6


def test_search_finds_what_single_fits_find(spark, folded, of):
    space = SEARCH_SPACES["Logistic Regression"]
    trials, best = B.logistic_search(spark, folded, space, 6, of=of)
    mine = {r["trial"]: r["score"] for r in trials.collect()}
    plain, _ = search.random_search(
        spark, folded, lambda **p: models.strategy_pipeline("Logistic Regression", "class_weight", tol=1e-13, max_iter=2000, **p),
        space, 6, objective=search.pooled_objective)
    for r in plain.collect():
        assert mine[r["trial"]] == pytest.approx(r["score"], abs=2e-3)
    assert best == search.draw(space, max(mine, key=lambda t: (mine[t], -t)))


def test_chunks_and_odd_folds(spark, monkeypatch):
    """Small chunks of models change nothing; a category that only one fold has; a constant column."""
    rng = np.random.default_rng(0)
    rows = [(i, float(rng.standard_normal()), 3.0, "z" if i % 5 == 1 and i < 60 else "ab"[i % 2], i % 3 % 2, int(rng.random() < 0.4), i % 5)
            for i in range(400)]
    frame = spark.createDataFrame(rows, "CustomerId long, a double, b double, c string, d int, Exited int, fold int")
    for c in ("Balance", "EstimatedSalary", "NumOfProducts", "Tenure", "IsActiveMember", "HasCrCard", "Age"):
        frame = frame.withColumn(c, F.lit(1))
    of = B.design(frame, ["a", "b"], ["c"], ["d"])
    fits = [B.Fit(k, 1.0, "l2", "balanced") for k in range(5)]
    whole = B.fit_all(of, fits)
    assert "c_z" not in whole[1].names and "c_z" in whole[0].names
    for f in whole:
        assert f.gradient <= B.TOLERANCE and f.coefficients[f.names.index("b")] == pytest.approx(0.0, abs=1e-9)
    monkeypatch.setattr(B, "CHUNK", 1)
    for one, two in zip(whole, B.fit_all(of, fits)):
        assert one.names == two.names and np.abs(one.coefficients - two.coefficients).max() < 1e-9
    assert B.design(frame.withColumn("a", F.lit(1.0)), ["a"], [], []).width == 1
    with pytest.raises(ValueError):
        B.design(frame.withColumn("a", F.when(F.col("a") > 0, F.col("a"))), ["a"], [], [])
