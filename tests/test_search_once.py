"""Trials that say the same model are one fit; metrics of many trials from one deal of their scores."""

import numpy as np
import pytest

from attrition.operators import batch_logistic as B
from attrition.operators import curves, search
from attrition.plans.training import prepare
from attrition.sources.profile import customer_profile

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folded(spark):
    return prepare(customer_profile(spark, SF), 2)[0].cache()


def test_equal_models_are_fitted_and_scored_once(spark, folded, monkeypatch):
    """without a penalty C says nothing, so such trials are one model."""
    params = [{"C": 0.1, "penalty": "l2"}, {"C": 1.0, "penalty": None}, {"C": 2.0, "penalty": None}, {"C": 0.1, "penalty": "l2"}]
    monkeypatch.setattr(search, "draw", lambda space, trial, seed: params[trial])
    widths, rows, sums, scores = [], [], B._sums, B.held_out_scores
    monkeypatch.setattr(B, "_sums", lambda r, theta, *a: widths.append(theta.shape[1]) or sums(r, theta, *a))
    monkeypatch.setattr(B, "held_out_scores", lambda of, fits, fitted, trials: rows.append(sorted(set(trials))) or scores(of, fits, fitted, trials))
    table, _ = B.logistic_search(spark, folded, {}, 4)
    got = {r["trial"]: r["score"] for r in table.collect()}
    assert max(widths) == 4 and rows == [[0, 1]]
    assert len(got) == 4 and got[0] == got[3] and got[1] == got[2] != got[0]


def test_metrics_of_distinct_scores_are_the_counted_ones(spark):
    rng = np.random.default_rng(3)
    rows = [(int(t), int(rng.integers(0, 2)), float(p)) for t in range(4) for p in np.round(rng.random(300), 2 + t)]
    rows += [(9, 1, 0.5), (9, 1, 0.5)]
    frame = spark.createDataFrame(rows, "trial int, y int, p double")
    one, two = ({r["trial"]: r for r in curves.metrics_by_fold(frame, 0.4, fold="trial", distinct=d).collect()} for d in (False, True))
    assert one == two and one[9]["roc_auc"] is None and len(one) == 5
