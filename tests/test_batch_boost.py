"""Boosted trees of many models grown in shared passes, against Spark's own learner."""

import threading
import time

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from attrition.operators import batch_boost as B
from attrition.operators import knn, models, search
from attrition.plans.training import comparison_grid
from attrition.schema import TARGET


def drawn(n: int, seed: int):
    """Rows of the raw inputs whose label hangs on some of them."""
    rng = np.random.default_rng(seed)
    for k in range(n):
        age, balance = int(rng.integers(18, 93)), float(rng.random() * 1e5) * (rng.random() < 0.7)
        yield (k, int(rng.integers(350, 851)), "ABC"[rng.integers(3)], "FM"[rng.integers(2)], age, int(rng.integers(0, 9)), balance,
               int(rng.integers(1, 5)), int(rng.integers(2)), int(rng.integers(2)), float(rng.random() * 1e5),
               int(rng.random() < 0.15 + 0.3 * (age > 50) + 0.2 * (balance > 5e4)))


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(list(drawn(900, 5)), """CustomerId long, CreditScore int, Geography string, Gender string, Age int,
        Tenure int, Balance double, NumOfProducts int, HasCrCard int, IsActiveMember int, EstimatedSalary double, Exited int""").coalesce(1).cache()


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(7)
    x = np.c_[rng.normal(size=(1200, 3)), rng.integers(0, 3, (1200, 1)), np.zeros((1200, 1))]
    y = (x[:, 0] + 0.5 * x[:, 3] + rng.normal(size=1200) > 1).astype(int)
    table = spark.createDataFrame([(v.tolist(), int(k)) for v, k in zip(x, y)], f"x array<double>, {TARGET} int")
    return table.select(array_to_vector("x").alias("features"), TARGET).coalesce(1).cache()


@pytest.mark.parametrize("weights", [(1.0, 1.0), (1.0, 3.7)])
def test_trees_are_those_of_spark(vectors, weights, monkeypatch):
    monkeypatch.setattr(B, "BLOCK", 500)
    monkeypatch.setattr(B, "STORE", 3)
    learner = GBTClassifier(maxIter=8, maxDepth=3, stepSize=0.1, labelCol=TARGET, weightCol="weight")
    weighted = vectors.withColumn("weight", F.when(F.col(TARGET) == 1, weights[1]).otherwise(weights[0]))
    spark_model = learner.fit(weighted)
    n = {r[0]: r[1] for r in vectors.groupBy(TARGET).count().collect()}
    other = GBTClassifier(maxIter=4, maxDepth=2, labelCol=TARGET, seed=3)
    mine, short = B.fit_all([B.Boost(vectors, n, weights, learner), B.Boost(vectors, n, (1.0, 1.0), other)])
    assert len(mine.trees) == 8 and len(short.trees) == 4 and len(mine.cuts[3]) == 2 and not len(mine.cuts[4])
    scored = spark_model.transform(vectors).select(models.positive_probability().alias("a"), B.probability(mine).alias("b"))
    assert scored.agg(F.max(F.abs(F.col("a") - F.col("b")))).first()[0] < 1e-9
    assert scored.select("a").distinct().count() > 50


def test_more_rows_than_candidates(spark, monkeypatch):
    """The thresholds are Spark's when they come from a sample of the rows."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(13_000, 2))
    y = (x[:, 0] + rng.normal(size=13_000) > 1).astype(int)
    table = spark.createDataFrame([(v.tolist(), int(k)) for v, k in zip(x, y)], f"x array<double>, {TARGET} int")
    table = table.select(array_to_vector("x").alias("features"), TARGET).repartition(3).cache()
    n = {r[0]: r[1] for r in table.groupBy(TARGET).count().collect()}
    learner = GBTClassifier(maxIter=2, maxDepth=3, labelCol=TARGET, seed=21)
    mine, = B.fit_all([B.Boost(table, n, (1.0, 1.0), learner)])
    scored = learner.fit(table).transform(table).select(models.positive_probability().alias("a"), B.probability(mine).alias("b"))
    assert scored.agg(F.max(F.abs(F.col("a") - F.col("b")))).first()[0] < 1e-9


def test_one_label_and_bad_features(spark, vectors):
    n = vectors.where(f"{TARGET} = 1").count()
    learner = GBTClassifier(maxIter=2, labelCol=TARGET)
    mine, = B.fit_all([B.Boost(vectors.where(f"{TARGET} = 1"), {1: n}, (1.0, 1.0), learner)])
    assert vectors.select(B.probability(mine).alias("p")).agg(F.min("p")).first()[0] > 0.8
    bad = spark.createDataFrame([([1.0], 0), ([float("nan")], 1), ([2.0], 1)], f"x array<double>, {TARGET} int")
    bad = bad.select(array_to_vector("x").alias("features"), TARGET)
    with pytest.raises(Exception, match="features hold nulls"):
        B.fit_all([B.Boost(bad, {0: 1, 1: 2}, (1.0, 1.0), learner)])


def test_a_comparison_grows_all_boosted_trees_together(spark, rows, monkeypatch):
    """every cell and fold fitted boosted trees of its own, a few jobs a level, and SMOTE and ADASYN
    searched the same minority rows each."""
    folded = rows.withColumn("fold", (F.col("CustomerId") % 2).cast("int")).cache()
    passes, searches, sums, search_knn, own = [], [], B._sums, knn.knn, []
    monkeypatch.setattr(B, "_sums", lambda *a: passes.append(1) or sums(*a))
    monkeypatch.setattr(knn, "knn", lambda *a, **k: searches.append(1) or search_knn(*a, **k))
    fit = GBTClassifier._fit
    monkeypatch.setattr(GBTClassifier, "_fit", lambda self, df: own.append(1) or fit(self, df))
    sizes = {"Boosted Trees": {"max_iter": 4}, "Random Forest": {"num_trees": 2}}
    grid = comparison_grid(families=["Random Forest", "Boosted Trees"], sizes=sizes)
    got = {(r["Model"], r["Strategy"]): r for r in search.compare_models(spark, folded, grid).collect()}
    assert not own and len(passes) == 4 * 3 and len(searches) == 2 * 2 and len(got) == 6
    for model, strategy, fn in grid:
        alone = search.cross_validate(search.out_of_fold(fn, folded)).first()
        one = got[model, strategy]
        assert one["ROC-AUC"] == pytest.approx(alone["roc_auc"], abs=1e-6) and one["F1"] == pytest.approx(alone["f1"], abs=1e-6)
    assert len(own) == 3 * 2


def test_fits_of_many_rows_wait():
    gate, inside, most = search.Gate(10), [], []

    def fit(n):
        with gate.held(n):
            inside.append(n)
            most.append(sum(inside))
            time.sleep(0.05)
            inside.remove(n)

    threads = [threading.Thread(target=fit, args=(n,)) for n in (4, 5, 6, 25, 3)]
    [t.start() for t in threads]
    [t.join(10) for t in threads]
    assert len(most) == 5 and max(m for m in most if m != 25) <= 10 and not inside
