"""The training workflow as Spark jobs: split -> folds -> comparison -> search
-> refit -> out-of-fold threshold -> isotonic calibration -> test evaluation.

Defaults avoid the published workflow's leaks: the threshold is chosen on
out-of-fold training scores and the calibrator is fitted on out-of-fold
scores too. ``mode='reference'`` reproduces the published choices instead
(calibrator on the training rows the model saw, threshold re-chosen on test).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.operators import calibrate, curves, models, search, split
from attrition.operators.ledger import Ledger
from attrition.schema import N_FOLDS, RECALL_FLOOR
from attrition.session import materialize

#: Trials of a parameter search.
N_TRIALS = 150


@dataclass
class TrainResult:
    model: PipelineModel
    calibrator: object
    threshold: float
    comparison: DataFrame | None
    trials: DataFrame | None
    best_params: dict = field(default_factory=dict)
    test_scores: DataFrame | None = None


def prepare(profile: DataFrame, k: int = N_FOLDS) -> tuple[DataFrame, DataFrame]:
    """Training rows with a fold column (checkpointed to the shared folder) and test rows."""
    train, test = split.split_frames(profile)
    folded = materialize(split.stratified_folds(train, k), "folds")
    return folded, test


def comparison_grid(families: list[str] | None = None, strategies: list[str] | None = None,
                    sizes: dict[str, dict] | None = None) -> list:
    """(Model, Strategy, pipeline factory) for every family x strategy; ``sizes`` overrides the
    learners' parameters by family (default: 200 trees, 100 boosting rounds)."""
    sizes = sizes or {}
    return [(fam, strat, (lambda f=fam, s=strat: models.strategy_pipeline(f, s, **sizes.get(f, {}))))
            for fam in (families or list(models.GRID))
            for strat in (strategies or models.STRATEGIES)]


def train_workflow(spark: SparkSession, profile: DataFrame, n_trials: int = N_TRIALS,
                   mode: str = "oof", k: int = N_FOLDS,
                   families: list[str] | None = None, strategies: list[str] | None = None,
                   sizes: dict[str, dict] | None = None, ledger: Ledger | None = None) -> TrainResult:
    """``ledger``: keeps every fold's fit of the comparison and the search, so that a workflow that
    was stopped fits only the rest when it is run again."""
    folded, test = prepare(profile, k)
    grid = comparison_grid(families, strategies, sizes)
    comparison = search.rank_results(search.compare_models(spark, folded, grid, ledger=ledger, name=str(sizes or "")))
    best = comparison.where(F.col("rank") == 1).first()
    fam, strat = best["Model"], best["Strategy"]
    space = SEARCH_SPACES[fam]
    trials, params = search.random_search(
        spark, folded, lambda **p: models.strategy_pipeline(fam, strat, **p), space, n_trials,
        objective=search.pooled_objective, ledger=ledger, name=f"{fam}/{strat}")
    pipe = models.strategy_pipeline(fam, strat, **params)
    train = folded.drop("fold")
    final = pipe.fit(train)
    oof = materialize(search.out_of_fold(lambda: models.strategy_pipeline(fam, strat, **params), folded), "oof")
    if mode == "reference":
        cal = calibrate.fit_isotonic(models.score(final, train))
        test_scores = calibrate.apply_isotonic(cal, models.score(final, test), "p", "p_cal")
        t = curves.best_threshold_value(test_scores, "y", "p_cal", RECALL_FLOOR)
    else:
        cal = calibrate.fit_isotonic(oof)
        oof_cal = calibrate.apply_isotonic(cal, oof, "p", "p_cal")
        t = curves.best_threshold_value(oof_cal, "y", "p_cal", RECALL_FLOOR)
        test_scores = calibrate.apply_isotonic(cal, models.score(final, test), "p", "p_cal")
    return TrainResult(final, cal, t, comparison, trials, params, test_scores)


SEARCH_SPACES = {
    "Logistic Regression": {"C": ("logfloat", 1e-3, 100.0), "penalty": ("cat", ["l2", None])},
    "Random Forest": {"num_trees": ("int", 100, 800), "max_depth": ("int", 3, 20),
                      "min_instances": ("int", 1, 10), "feature_subset": ("cat", ["sqrt", "log2"])},
    "Boosted Trees": {"max_iter": ("int", 200, 700), "step_size": ("logfloat", 0.015, 0.1),
                      "max_depth": ("int", 3, 5), "subsampling_rate": ("float", 0.5, 0.8)},
    "Newton Boosted Trees": {"max_iter": ("int", 200, 700), "step_size": ("logfloat", 0.015, 0.1),
                             "max_depth": ("int", 3, 5), "l2": ("logfloat", 0.01, 6.0),
                             "subsampling_rate": ("float", 0.5, 0.8)},
}


def evaluate(test_scores: DataFrame, t: float, score: str = "p_cal") -> DataFrame:
    """PASS/FAIL table on the test rows."""
    return curves.targets_status(test_scores, t, "y", score)

