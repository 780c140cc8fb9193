"""Properties of the distributed operators on the small test tables."""

import math
import os
import random
import uuid

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from attrition.operators import calibrate, explain, imbalance, models, search, split
from attrition.operators.knn import knn
from attrition.operators.prefix import prefix_sums
from attrition.plans.scoring import score_batch
from attrition.session import checkpoint_dir
from attrition.sources import files
from attrition.sources.profile import customer_profile
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def profile(spark):
    return customer_profile(spark, SF_SMALL).cache()


def test_profile_matches_fixture_counts(profile):
    assert profile.count() == 150
    rate = profile.agg(F.avg("Exited")).first()[0]
    assert rate == pytest.approx(0.2)
    prods = dict(profile.groupBy("NumOfProducts").count().collect())
    assert prods == {1: 85, 2: 38, 3: 16, 4: 11}


def test_split_exact_and_repeatable(spark, profile):
    s1 = split.stratified_split(profile)
    assert s1.where("is_test").count() == 15
    s2 = split.stratified_split(profile.repartition(7))
    a = {r[0] for r in s1.where("is_test").select("CustomerId").collect()}
    b = {r[0] for r in s2.where("is_test").select("CustomerId").collect()}
    assert a == b
    f = split.stratified_folds(profile, 5)
    sizes = sorted(r[1] for r in f.groupBy("fold").count().collect())
    assert sizes[-1] - sizes[0] <= 2
    approx = split.stratified_split(profile, exact=False)
    assert 0 < approx.where("is_test").count() < 60


def test_prefix_sums_match_cumsum(spark):
    rnd = random.Random(7)
    rows = [(rnd.random(), rnd.randint(0, 3), g) for g in range(2) for _ in range(500)]
    df = spark.createDataFrame(rows, "v double, w long, g int").dropDuplicates(["v", "g"])
    got = prefix_sums(df, "v", ["w"], partition_by=["g"], num_buckets=16).toPandas()
    for g, part in got.groupby("g"):
        part = part.sort_values("v", ascending=False)
        assert (part["w_cum"].to_numpy() == part["w"].cumsum().to_numpy()).all()


def test_knn_exact_against_brute_force(spark):
    rnd = np.random.default_rng(3)
    pts = rnd.normal(size=(120, 4))
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(pts)],
                               "CustomerId long, a array<double>") \
        .select("CustomerId", array_to_vector("a").alias("features"))
    got = knn(df, df, k=5).toPandas()
    d = np.sqrt(((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    for q, part in got.groupby("query"):
        want = np.lexsort((np.arange(len(pts)), d[q]))[:5]
        assert list(part.sort_values("rank")["neighbour"]) == list(want)


def test_smote_balances_on_segments(spark):
    rnd = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rnd.normal(size=3)], 1 if i < 20 else 0) for i in range(80)]
    df = spark.createDataFrame(rows, "CustomerId long, a array<double>, Exited int") \
        .select("CustomerId", array_to_vector("a").alias("features"), "Exited")
    out = imbalance.smote(df, k=3)
    counts = dict(out.groupBy("Exited").count().collect())
    assert counts[0] == counts[1] == 60
    first = out.where("synthetic").orderBy("CustomerId", "i").toPandas()
    again = imbalance.smote(df, k=3).where("synthetic").orderBy("CustomerId", "i").toPandas()
    assert first[["CustomerId", "i"]].equals(again[["CustomerId", "i"]])
    # Each synthetic row lies on a segment from its source to one of the source's 3 nearest.
    mino = np.array([a for _, a, y in rows if y == 1])
    for key, v in zip(first["CustomerId"], first["features"]):
        x, v = mino[key], v.toArray()
        near = np.argsort(np.linalg.norm(mino - x, axis=1), kind="stable")[1:4]
        gaps = [np.linalg.norm(v - x) + np.linalg.norm(mino[n] - v) - np.linalg.norm(mino[n] - x) for n in near]
        assert min(gaps) < 1e-9


@pytest.fixture(scope="module")
def folded(spark, profile):
    train, test = split.split_frames(profile)
    return split.stratified_folds(train, 3).checkpoint(), test


def test_oof_covers_every_row_once(spark, folded):
    f, _ = folded
    oof = search.out_of_fold(lambda: models.strategy_pipeline("Logistic Regression",
                                                              "class_weight"), f)
    assert oof.count() == f.count() == oof.select("CustomerId").distinct().count()
    cv = search.cross_validate(oof).first()
    assert 0.0 <= cv["roc_auc"] <= 1.0 and cv["folds"] == 3


def test_tree_shap_additivity(spark, folded):
    f, test = folded
    train = f.drop("fold")
    for fam, kw in [("Boosted Trees", {"max_iter": 5}), ("Random Forest", {"num_trees": 5})]:
        m = models.strategy_pipeline(fam, "class_weight", **kw).fit(train)
        shap, base = explain.model_shap(m, test)
        pdf = (shap.groupBy("CustomerId").agg(F.sum("shap").alias("s"))
               .join(models.score(m, test), "CustomerId").toPandas())
        target = np.log(pdf.p / (1 - pdf.p)) if fam == "Boosted Trees" else pdf.p
        assert np.max(np.abs(pdf.s + base - target)) < 1e-6


def test_save_load_same_predictions(spark, folded):
    f, test = folded
    m = models.strategy_pipeline("Logistic Regression", "class_weight").fit(f.drop("fold"))
    d = os.path.join(checkpoint_dir(spark), f"m-{uuid.uuid4().hex}")
    files.save_model(m, 0.42, d, "lr")
    loaded, t, name = files.load_model(spark, d)
    assert (t, name) == (0.42, "lr")
    a = models.score(m, test).orderBy("CustomerId").toPandas()
    b = models.score(loaded, test).orderBy("CustomerId").toPandas()
    assert np.allclose(a.p, b.p)
    res = score_batch(test, loaded, t)
    assert res.count() == test.count()
    assert res.columns[:4] == ["CustomerId", "Churn_Probability", "Churn_Prediction", "Risk_Level"]
    with pytest.raises(FileNotFoundError):
        files.load_model(spark, os.path.join(d, "missing"))


def test_isotonic_monotone(spark):
    rnd = random.Random(1)
    rows = [(1 if rnd.random() < p else 0, p) for p in [rnd.random() for _ in range(300)]]
    df = spark.createDataFrame(rows, "y int, p double")
    m = calibrate.fit_isotonic(df)
    tab = calibrate.isotonic_table(m, df).orderBy("p").toPandas()
    assert (np.diff(tab.calibrated) >= -1e-12).all()
    assert tab.calibrated.between(0, 1).all()


def test_search_draws_repeatable():
    space = {"a": ("int", 1, 3), "b": ("logfloat", 1e-3, 1.0), "c": ("cat", ["x", "y"])}
    d1 = [search.draw(space, t) for t in range(20)]
    assert d1 == [search.draw(space, t) for t in range(20)]
    assert all(1 <= d["a"] <= 3 and 1e-3 <= d["b"] <= 1.0 and d["c"] in "xy" for d in d1)
    assert math.isclose(min(d["b"] for d in d1), min(d["b"] for d in d1))


def test_both_samplers_rejected():
    with pytest.raises(ValueError):
        models.build_pipeline(models.logistic(), use_smote=True, use_adasyn=True)


def test_knn_exact_with_a_third_copies(spark):
    rnd = np.random.default_rng(11)
    pts = rnd.normal(size=(90, 3))
    pts[:30] = pts[0]                      # a third of the rows are one point
    pts[30:34] = pts[40]                   # and a small group of copies
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(pts)],
                               "CustomerId long, a array<double>") \
        .select("CustomerId", array_to_vector("a").alias("features"))
    got = knn(df, df, k=4).toPandas()
    d = np.sqrt(((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    assert got["query"].nunique() == 90
    for q, part in got.groupby("query"):
        want = np.lexsort((np.arange(len(pts)), d[q]))[:4]
        assert list(part.sort_values("rank")["neighbour"]) == list(want)
