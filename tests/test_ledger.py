"""A search that is stopped midway fits only the rest when it is run again."""

import pytest
from pyspark.sql import functions as F

from attrition.operators import ledger as L
from attrition.operators import models, search
from attrition.plans.training import SEARCH_SPACES, prepare
from attrition.session import materialize
from attrition.sources.profile import customer_profile
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def folded(spark):
    return prepare(customer_profile(spark, SF_SMALL), 3)[0]


class Counting:
    """Pipelines of a search; fits are counted, and one of them dies."""

    def __init__(self, dies_at=None):
        self.fits, self.dies_at = 0, dies_at

    def __call__(self, **params):
        pipeline = models.strategy_pipeline("Logistic Regression", "class_weight", **params)
        plain = pipeline._fit

        def fit(df):
            self.fits += 1
            if self.dies_at and self.fits == self.dies_at:
                raise RuntimeError("the driver died")
            return plain(df)

        pipeline._fit = fit
        return pipeline


SPACE = SEARCH_SPACES["Logistic Regression"]


def test_a_killed_search_fits_only_the_rest(spark, folded, tmp_path):
    book = L.Ledger(spark, str(tmp_path / "ledger"))
    run = lambda make, frame=folded: search.random_search(spark, frame, make, SPACE, 3, ledger=book, name="lr")
    first = Counting(dies_at=5)
    with pytest.raises(RuntimeError):
        run(first)
    kept = book.rows().count()
    assert 0 < kept < 9
    second = Counting()
    trials, best = run(second)
    assert second.fits == 9 - kept and book.rows().count() == 9
    third = Counting()
    again, best_again = run(third)
    assert third.fits == 0 and best == best_again
    plain, best_plain = search.random_search(spark, folded, Counting(), SPACE, 3)
    of = lambda t: {r["trial"]: r["score"] for r in t.collect()}
    assert of(trials) == of(again) and of(trials) == pytest.approx(of(plain)) and best == best_plain
    # Other rows are other work.
    fourth = Counting()
    run(fourth, materialize(folded.where("CustomerId <> 1"), "folds"))
    assert fourth.fits == 9


def test_scores_without_a_row_are_done_again(spark, folded, tmp_path):
    """A crash between the scores and their row leaves the piece pending."""
    book = L.Ledger(spark, str(tmp_path / "ledger"))
    version = L.data_version(folded)
    half = folded.limit(1).select("CustomerId", F.lit(1).alias("y"), F.lit(0.5).alias("p"), F.lit(0).alias("fold"))
    half.write.parquet(book._scores(version, "m", 0))
    assert book.pending(version, ["m"], [0, 1]) == [("m", 0), ("m", 1)]
    out = L.out_of_fold(book, folded, {"m": lambda: models.strategy_pipeline("Logistic Regression", "class_weight")})["m"]
    assert out.count() == folded.count() and book.pending(version, ["m"], [0, 1, 2]) == []


def test_version_ignores_order_and_sees_every_cell(spark):
    frame = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, None)], "i int, s string")
    version = L.data_version(frame)
    assert version == L.data_version(frame.orderBy(F.desc("i")).repartition(3))
    for other in (frame.where("i < 3"), frame.withColumn("s", F.coalesce("s", F.lit(""))), frame.withColumnRenamed("s", "t"),
                  frame.unionByName(frame.where("i = 2"))):
        assert L.data_version(other) != version


def test_a_killed_comparison(spark, folded, tmp_path):
    book = L.Ledger(spark, str(tmp_path / "ledger"))
    count = Counting(dies_at=4)
    grid = [("Logistic Regression", s, (lambda c=c: count(C=c))) for s, c in (("class_weight", 1.0), ("plain", 0.5))]
    with pytest.raises(RuntimeError):
        search.compare_models(spark, folded, grid, ledger=book)
    kept = book.rows().count()
    count.dies_at, count.fits = None, 0
    assert search.compare_models(spark, folded, grid, ledger=book).count() == 2 and count.fits == 6 - kept
