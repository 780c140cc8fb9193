"""A fast slice of the DuckDB oracle gate at the smallest scale."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle import compare, duck

NAMES = ["customer_profile", "rate_by_group", "audit_columns", "split_stratified",
         "folds_stratified", "pr_curve", "roc_auc", "best_threshold", "calibration_curve",
         "isotonic_fit", "error_breakdown", "batch_result", "feature_table", "recommendations",
         "kde_by_class", "correlation_matrix", "high_correlation_pairs", "logistic_scores"]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sp = E.queries()[name](spark, SF_SMALL).toPandas()
    dk = con.execute(E.oracle_sql()[name]).df()
    assert compare(sp, dk) is None


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["dimension", "value", "n", "churn_rate", "overall_rate"]


def test_every_query_registered_has_oracle_or_is_a_fit():
    rows_only = {n for n in set(E.queries()) - set(E.oracle_sql())
                 if n != "pipeline" and not re.match(r"op\d+_", n)}
    assert set(E.oracle_sql()) <= set(E.queries())
    # Their rows are metrics of learners.
    assert rows_only <= {"model_comparison", "random_search"}
