"""Rows that a comparison prepares once for all learners."""

import pytest

from attrition.operators import imbalance, search
from attrition.plans.training import comparison_grid, prepare
from attrition.sources.profile import customer_profile

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folded(spark):
    return prepare(customer_profile(spark, SF), 2)[0].cache()


def test_a_fold_is_resampled_once_for_all_learners(spark, folded, monkeypatch):
    """three learners by fold asked for the same resampled rows, each made its own."""
    calls, smote = [], imbalance.smote
    monkeypatch.setattr(imbalance, "smote", lambda *a, **k: calls.append(1) or smote(*a, **k))
    sizes = {"Random Forest": {"num_trees": 3}, "Boosted Trees": {"max_iter": 2}}
    grid = comparison_grid(strategies=["SMOTE"], sizes=sizes)
    got = {r["Model"]: r for r in search.compare_models(spark, folded, grid).collect()}
    assert len(calls) == 2 and len(got) == 3
    alone = search.cross_validate(search.out_of_fold(grid[0][2], folded)).first()
    assert len(calls) == 4
    assert got[grid[0][0]]["ROC-AUC"] == pytest.approx(alone["roc_auc"], abs=1e-6)


def test_shared_gives_every_asker_the_error():
    shared = search.Shared()
    for _ in (1, 2):
        with pytest.raises(ZeroDivisionError):
            shared.of("k", lambda: 1 / 0)
    assert [shared.of("m", lambda: 3), shared.of("m", lambda: 4)] == [3, 3]
