"""Out-of-fold scoring, cross-validated comparison and parameter search.

Each fit is a set of distributed Spark jobs; independent fits (folds, grid
cells, trials) are submitted from driver threads so the cluster runs them
side by side. Only metric rows and chosen parameters reach the driver.
The fold frame is checkpointed once into the shared checkpoint folder, so a
lost executor recomputes from files, not from the whole lineage.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import contextmanager
from threading import Condition, Lock

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attrition.operators import batch_boost, curves, imbalance
from attrition.operators.ledger import Ledger, model_name
from attrition.operators.ledger import out_of_fold as ledger_folds
from attrition.operators.models import AttritionPipeline, score
from attrition.schema import KEY, SCORE_WEIGHTS, SEED_SAMPLER, TARGET
from attrition.session import materialize


#: Rows that the fits of a comparison hold in memory side by side.
ROWS = 2_000_000


class Gate:
    """Lets fits through as long as their rows are no more than ``most`` together, one fit at least."""

    def __init__(self, most: int = ROWS):
        self._most, self._rows, self._free = most, 0, Condition()

    @contextmanager
    def held(self, rows: int):
        with self._free:
            self._free.wait_for(lambda: not self._rows or self._rows + rows <= self._most)
            self._rows += max(1, rows)
        try:
            yield
        finally:
            with self._free:
                self._rows -= max(1, rows)
                self._free.notify_all()


class Shared:
    """What several threads ask for by key, made by the first of them."""

    def __init__(self):
        self._lock, self._found, self.gate = Lock(), {}, Gate()

    def of(self, key, make: Callable):
        with self._lock:
            mine = key not in self._found
            made = self._found.setdefault(key, Future())
        if mine:
            try:
                made.set_result(make())
            except BaseException as error:
                made.set_exception(error)
        return made.result()


def _prepared(pipeline: AttritionPipeline, k, train: DataFrame, shared: Shared):
    return shared.of((pipeline.preparation(), k), lambda: pipeline.prepare(train, lambda key, make: shared.of((*key, k), make)))


def out_of_fold(pipeline_fn: Callable[[], AttritionPipeline], folded: DataFrame,
                fold: str = "fold", key: str = KEY, label: str = TARGET,
                parallelism: int = 5, shared: Shared | None = None) -> DataFrame:
    """``(key, y, p, fold)``: every row scored by a model that never saw it.
    Every fold fits its own pipeline (scaler, encoder, sampler, learner). ``shared``: rows that
    pipelines of one comparison have prepared for the same fold of the same ``folded``."""
    sizes = {r[0]: r[1] for r in folded.groupBy(fold).count().collect()}
    folds = sorted(sizes)

    def one(k):
        train = folded.where(F.col(fold) != k).drop(fold)
        held = folded.where(F.col(fold) == k)
        pipeline = pipeline_fn()
        if shared is not None and type(pipeline) is AttritionPipeline:
            prepared = _prepared(pipeline, k, train, shared)
            # Resampled rows are up to twice as many.
            rows = (sum(sizes.values()) - sizes[k]) * (2 if pipeline.use_smote or pipeline.use_adasyn else 1)
            with shared.gate.held(rows):
                model = pipeline.fit_prepared(*prepared)
        else:
            model = pipeline.fit(train)
        return score(model, held, key, label).withColumn(fold, F.lit(k))

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(folds)))) as ex:
        parts = list(ex.map(one, folds))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def boosted_out_of_fold(pipelines: list[AttritionPipeline], folded: DataFrame, shared: Shared,
                        fold: str = "fold", key: str = KEY, label: str = TARGET,
                        parallelism: int = 5) -> list[DataFrame]:
    """``out_of_fold`` of every pipeline, the trees of all folds of all of them grown together."""
    folds = sorted(r[0] for r in folded.select(fold).distinct().collect())

    def ready(item):
        pipeline, k = item
        fm, x = _prepared(pipeline, k, folded.where(F.col(fold) != k).drop(fold), shared)
        counts = imbalance.label_counts(x, label)
        weights = imbalance.class_weight_values(counts, pipeline.weight_mode) if pipeline.weight_mode else (1.0, 1.0)
        return fm, batch_boost.Boost(x, counts, weights, pipeline.classifier)

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        stages, boosts = zip(*ex.map(ready, [(p, k) for p in pipelines for k in folds]))
    batch_boost.fit_all(list(boosts))
    out = []
    for i in range(len(pipelines)):
        parts = None
        for j, k in enumerate(folds, i * len(folds)):
            held = stages[j].transform(folded.where(F.col(fold) == k)).select(
                key, F.col(label).cast("int").alias("y"), batch_boost.probability(boosts[j]).alias("p"), F.lit(k).alias(fold))
            parts = held if parts is None else parts.unionByName(held)
        out.append(parts)
    return out


def grown_together(pipeline) -> bool:
    """Whether a pipeline's learner is fitted with those of the other cells and folds."""
    return (type(pipeline) is AttritionPipeline and batch_boost.supports(pipeline.classifier)
            and pipeline.classifier.isSet("weightCol") == bool(pipeline.weight_mode))


def cross_validate(oof: DataFrame, t: float = 0.5) -> DataFrame:
    """Mean over folds of ROC-AUC, F1 and recall at t (per-fold, then mean)."""
    return curves.mean_over_folds(curves.metrics_by_fold(oof, t))


def composite_score(f1="F1", recall="Recall", auc="ROC-AUC", weights=SCORE_WEIGHTS):
    return (F.lit(weights["F1"]) * F.col(f"`{f1}`") + F.lit(weights["Recall"]) * F.col(f"`{recall}`")
            + F.lit(weights["ROC-AUC"]) * F.col(f"`{auc}`"))


def rank_results(results: DataFrame, recall_floor: float | None = None,
                 weights: dict[str, float] = SCORE_WEIGHTS) -> DataFrame:
    """Add Score, rank by Score descending (Model, Strategy break ties);
    optionally drop rows under a recall floor."""
    df = results.withColumn("Score", composite_score(weights=weights))
    if recall_floor is not None:
        df = df.where(F.col("Recall") >= F.lit(recall_floor))
    # The comparison table has one row per grid cell: a handful of rows.
    w = Window.orderBy(F.col("Score").desc(), F.col("Model"), F.col("Strategy"))
    return df.withColumn("rank", F.row_number().over(w))


def strategy_summary(ranked: DataFrame) -> DataFrame:
    return ranked.groupBy("Strategy").agg(
        F.max_by("Model", "Score").alias("best_model"), F.max("Score").alias("best_score"),
        F.avg("Score").alias("mean_score"), F.count(F.lit(1)).alias("models"))


def compare_models(spark: SparkSession, folded: DataFrame,
                   grid: list[tuple[str, str, Callable[[], AttritionPipeline]]],
                   parallelism: int = 3, ledger: Ledger | None = None, name: str = "") -> DataFrame:
    """One row per (Model, Strategy): mean fold ROC-AUC, F1, Recall at 0.5.

    Learners that want the same rows of a fold (features, sampler) share them: these are made once.
    Boosted trees of all cells and folds are grown together (``batch_boost``). With a ``ledger`` a stopped comparison goes on where it was; ``name`` tells grids apart whose
    cells share names but not parameters."""
    called = lambda model, strategy: model_name(grid=name, model=model, strategy=strategy)
    held = ledger_folds(ledger, folded, {called(m, s): fn for m, s, fn in grid}) if ledger else {}
    shared = Shared()
    together = [] if ledger else [i for i, (_, _, fn) in enumerate(grid) if grown_together(fn())]

    def grown():
        return dict(zip(together, boosted_out_of_fold([grid[i][2]() for i in together], folded, shared)))

    def one(i):
        model, strategy, fn = grid[i]
        if ledger:
            oof = held[called(model, strategy)]
        elif i in together:
            oof = materialize(shared.of("grown", grown)[i], "oof")
        else:
            oof = materialize(out_of_fold(fn, folded, shared=shared), "oof")
        m = cross_validate(oof).first()
        return (model, strategy, m["roc_auc"], m["f1"], m["recall"])

    # Trees that are grown together have a thread of their own: their passes are many and short.
    with ThreadPoolExecutor(max_workers=max(1, parallelism) + bool(together)) as ex:
        done = {i: ex.submit(one, i) for i in sorted(range(len(grid)), key=lambda i: together[:1] != [i])}
        rows = [done[i].result() for i in range(len(grid))]
    return spark.createDataFrame(rows, "Model string, Strategy string, `ROC-AUC` double, "
                                       "F1 double, Recall double")


# ---------------------------------------------------------------- search
def draw(space: dict, trial: int, seed: int = SEED_SAMPLER) -> dict:
    """Hash-uniform draw of one trial's parameters.

    Space entries: ("int", lo, hi) | ("float", lo, hi) | ("logfloat", lo, hi) |
    ("cat", [choices]). The same (seed, trial, name) always gives the same value.
    """
    import hashlib
    out = {}
    for name, spec in space.items():
        h = hashlib.md5(f"{seed}:{trial}:{name}".encode()).hexdigest()
        u = int(h[:13], 16) / float(16 ** 13)
        kind = spec[0]
        if kind == "int":
            lo, hi = spec[1], spec[2]
            out[name] = int(lo + math.floor(u * (hi - lo + 1)))
        elif kind == "float":
            out[name] = spec[1] + u * (spec[2] - spec[1])
        elif kind == "logfloat":
            a, b = math.log(spec[1]), math.log(spec[2])
            out[name] = math.exp(a + u * (b - a))
        elif kind == "cat":
            out[name] = spec[1][min(int(u * len(spec[1])), len(spec[1]) - 1)]
        else:
            raise ValueError(f"unknown space kind {kind!r}")
    return out


def mean_fold_f1(oof: DataFrame, t: float = 0.5) -> float:
    """Mean over folds of F1 at t: the objective when the caller names none."""
    return float(cross_validate(oof, t).first()["f1"] or 0.0)


def pooled_objective(oof: DataFrame, t: float = 0.5, weights: dict[str, float] = SCORE_WEIGHTS) -> float:
    """Composite of pooled out-of-fold F1 and recall at t and ROC-AUC."""
    pm = curves.point_metrics(oof, t).first()
    auc = curves.roc_auc(oof).first()["roc_auc"]
    w = weights
    return w["F1"] * pm["f1"] + w["Recall"] * pm["recall"] + w["ROC-AUC"] * (auc or 0.0)


def random_search(spark: SparkSession, folded: DataFrame,
                  model_fn: Callable[..., AttritionPipeline], space: dict, n_trials: int,
                  seed: int = SEED_SAMPLER, fixed: dict | None = None,
                  objective: Callable[[DataFrame], float] | None = None,
                  parallelism: int = 4, ledger: Ledger | None = None, name: str = "") -> tuple[DataFrame, dict]:
    """Trials table ``(trial, params, score)`` and the best parameters merged
    with ``fixed``. Each trial is an out-of-fold Spark job whose scores are stored
    once; without an ``objective`` the mean fold F1 is used. With a ``ledger`` a stopped
    search goes on where it was, and equal parameters are fitted once; ``name`` says what
    ``model_fn`` fits."""
    drawn = [draw(space, trial, seed) for trial in range(n_trials)]
    called = lambda params: model_name(search=name, **params)
    held = ledger_folds(ledger, folded, {called(p): (lambda p=p: model_fn(**p)) for p in drawn}) if ledger else {}

    def one(trial):
        params = drawn[trial]
        oof = held[called(params)] if ledger else materialize(out_of_fold(lambda: model_fn(**params), folded), "oof")
        return trial, {k: str(v) for k, v in params.items()}, float((objective or mean_fold_f1)(oof)), params

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        res = list(ex.map(one, range(n_trials)))
    trials = spark.createDataFrame([(t, p, s) for t, p, s, _ in res],
                                   "trial int, params map<string,string>, score double")
    best = max(res, key=lambda r: (r[2], -r[0]))
    return trials, {**best[3], **(fixed or {})}


def best_so_far(trials: DataFrame) -> DataFrame:
    """Trials that set a new best score (the first trial always does)."""
    prev = (Window.orderBy("trial").rowsBetween(Window.unboundedPreceding, -1))
    return (trials.withColumn("_prev", F.max("score").over(prev))
            .where(F.col("_prev").isNull() | (F.col("score") > F.col("_prev")))
            .drop("_prev"))
