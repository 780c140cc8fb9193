"""Co-training's passes over unlabelled rows against dense matrices, one round by hand."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from attrition.llm import quality as Q
from attrition.llm.common import read

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def features(spark):
    docs = read(spark, SF, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    rows = Q.featured(docs.withColumn("quality", (F.col("doc_id") % 2).cast("int"))).cache()
    held = rows.orderBy("doc_id").collect()
    text = Q._dense([(np.array(r["ti"]), r["tv"]) for r in held], Q.WORD_BUCKETS + Q.SHARES)
    meta = Q._dense([(np.array(r["mi"]), 1.0) for r in held], Q.META_BUCKETS)
    return rows, held, text, meta


def test_sums_over_the_table_are_dense_sums(features):
    rows, held, text, meta = features
    rng = np.random.default_rng(1)
    labels = [rng.integers(-1, 2, len(held)) for _ in (0, 1)]
    spark = rows.sparkSession
    given = spark.createDataFrame([(r["doc_id"], int(a), int(b)) for r, a, b in zip(held, *labels)], "doc_id long, label0 int, label1 int")
    told = rows.join(given, "doc_id").select("ti", "tv", "mi", "label0", "label1").repartition(3)
    sets = [[text[:9], np.arange(9) % 2], [meta[:9], np.arange(9) % 2]]
    weights = [rng.standard_normal(x.shape[1] + 1) * 0.1 for x in (text, meta)]
    got = Q.Sums(sets, told).at(weights)
    for v, x in enumerate((text, meta)):
        took = labels[v] >= 0
        every = np.vstack([x[:9], x[took]]).astype(float)
        y = np.r_[np.arange(9) % 2, labels[v][took]].astype(float)
        share = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y == 0).sum())
        z = every @ weights[v][:-1] + weights[v][-1]
        error = share * (1 / (1 + np.exp(-z)) - y)
        assert got[v][0] == pytest.approx((share * (np.logaddexp(0, z) - y * z)).sum() + Q.PENALTY / 2 * weights[v] @ weights[v], rel=1e-5)
        assert np.abs(got[v][1] - np.r_[error @ every, error.sum()] - Q.PENALTY * weights[v]).max() < 1e-6
    # The search falls with every step it takes, and ends near a point without slope.
    start = Q.Sums(sets, told).at(weights)
    end = Q.Sums(sets, told).at(Q.refit(Q.Sums(sets, told), weights))
    for v in (0, 1):
        assert end[v][0] < start[v][0] and np.abs(end[v][1]).max() < np.abs(start[v][1]).max() / 5


def test_every_sure_row_is_handed_over_once(features):
    """Two rounds by hand: whoever is sure first labels the row for the other view, whatever their number."""
    rows, held, text, meta = features
    rng = np.random.default_rng(2)
    models = [([rng.standard_normal(x.shape[1] + 1) * 0.2 for x in (text, meta)], [[0.3, 0.2], [0.4, 0.1]]),
              ([rng.standard_normal(x.shape[1] + 1) * 0.2 for x in (text, meta)], [[0.1, 0.2], [np.inf, 0.0]])]
    free, expected = np.ones(len(held), bool), []
    for views, sure in models:
        given = np.full((2, len(held)), -1)
        for v, x in enumerate((text, meta)):
            odds = Q._odds(x, views[v])
            for label in (1, 0):
                given[1 - v][free & ((odds if label else -odds) >= sure[v][label])] = label
        fresh = free & (given >= 0).any(0)
        expected.append(sorted((held[i]["ti"], given[0][i], given[1][i]) for i in np.flatnonzero(fresh)))
        free &= ~fresh
    schema = "ti array<int>, tv array<float>, mi array<int>, label0 int, label1 int"
    for k in (1, 2):
        got = rows.select("ti", "tv", "mi").repartition(2).mapInArrow(Q._hand_over(models[:k]), schema).collect()
        assert sorted((r["ti"], r["label0"], r["label1"]) for r in got) == expected[k - 1] and got


def test_columns_become_the_dense_rows(features):
    rows, held, text, meta = features
    table = rows.orderBy("doc_id").toArrow()
    assert (Q._dense_columns(table.column("ti"), table.column("tv"), text.shape[1]) == text).all()
    assert (Q._dense_columns(table.column("mi"), None, meta.shape[1]) == meta).all()


def test_no_text_is_dealt_for_the_unlabelled_rows(spark, monkeypatch):
    """Features, not texts, meet the labels, by a shuffle however few the labels are."""
    docs = spark.createDataFrame([(i, "good words here " * (1 + i % 5) if i % 2 else "!!! @@ 99", "en", "web", 40) for i in range(80)]
                                 + [(None, "lone text", "en", "web", 9)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(3, 1), (None, 1)], "doc_id long, quality int")
    plans, pools = [], []

    def stored(frame, name="table"):
        if name == "features":
            plans.append(frame._jdf.queryExecution().optimizedPlan().toString())
            pools.append(frame.count())
        return kept(frame, name)

    kept = Q.materialize
    monkeypatch.setattr(Q, "materialize", stored)
    assert Q.fit(docs, labels) is not None
    assert pools == [41]
    join = plans[0].index("Join LeftAnti")
    assert "strategy=merge" in plans[0] and plans[0].index("MapInArrow") > join
