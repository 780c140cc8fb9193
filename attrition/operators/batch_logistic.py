"""Many logistic fits at once: every trial x fold model is a column of one coefficient matrix.

A parameter search fits the same rows again and again; only the fold left out, the class weights
and the penalty change. Here one pass over the stored rows (``mapInArrow``) evaluates all open
models together: scores are one matrix product, a fold is a weight of zero, and each task returns
one row of sums per model (loss, gradient, packed second derivatives), added up in Spark by model.
The driver turns the sums into Newton steps, halves the step of a model whose loss rose, and drops
models whose gradient vanished from the next pass. It holds numbers of the order of models x
features^2, never rows; models go in chunks so that a task's sums stay bounded as well.

The stored rows hold common coordinates: numeric features scaled over all rows, one indicator for
every category, pass-through features. What a fold's own scaler and drop-first encoder would do is
a linear map between those coordinates and the fold's, taken from per-fold sums, so no fold needs
its own table.

The loss is Spark's: the weighted mean of log losses plus regParam/2 times the squared
coefficients (not the intercept), regParam = 1 / (C * n).
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.operators import curves, search
from attrition.operators.preprocess import MAX_CATEGORIES, FeatureEngineer, fit_scaler_and_encoder
from attrition.schema import (CAT_FEATURES, KEY, NUM_FEATURES, PASSTHROUGH_FEATURES, SCORE_WEIGHTS, SEED_SAMPLER,
                              TARGET)
from attrition.session import materialize

#: Rows whose scores under all models are held at once.
ROWS = 1024
#: Doubles that a task adds up for one chunk of models.
CHUNK = 1 << 22
MAX_ITER = 100
#: Largest entry of a gradient that counts as none.
TOLERANCE = 1e-10


@dataclass(frozen=True)
class Fit:
    """One model: the fold it leaves out (null: none), its penalty and its class weights."""
    fold: int | None = None
    C: float = 1.0
    penalty: str | None = "l2"
    weight_mode: str | None = None


def _told_apart(fit: Fit) -> tuple:
    """What a model hangs on."""
    return fit.fold, fit.C if fit.penalty else None, fit.weight_mode


@dataclass
class Fitted:
    """A fitted model in the coordinates of its own fold's scaler and encoder."""
    names: list[str]
    coefficients: np.ndarray
    intercept: float
    gradient: float
    iterations: int
    common: np.ndarray  # coefficients and intercept over the common coordinates


@dataclass
class Design:
    """Rows in common coordinates and what each fold needs to get to its own."""
    rows: DataFrame  # key, fold, y, z
    num: list[str]
    cat: list[str]
    passthrough: list[str]
    categories: dict[str, list[str]]
    totals: dict[tuple[int, int], dict]  # (fold, y) -> n, sums, squares

    @property
    def width(self) -> int:
        return len(self.num) + sum(map(len, self.categories.values())) + len(self.passthrough)

    def counts(self, without: int | None) -> dict[int, int]:
        out = {0: 0, 1: 0}
        for (fold, y), t in self.totals.items():
            if fold != without:
                out[y] += t["n"]
        return out

    def to_fold(self, without: int | None) -> tuple[list[str], np.ndarray]:
        """Feature names of a fold's own encoding and the matrix from common coordinates and a
        one to those features and a one."""
        kept = [t for (fold, _), t in self.totals.items() if fold != without]
        n = sum(t["n"] for t in kept)
        sums, squares = (sum(t[c] for t in kept) for c in ("sums", "squares"))
        names, rows = [], []
        unit = np.eye(self.width + 1)
        for j, name in enumerate(self.num):
            mean = sums[j] / n
            spread = max(squares[j] / n - mean * mean, 0.0) ** 0.5
            # Under this the deviation is rounding: a constant column scales by one.
            spread = spread if spread > 1e-9 else 1.0
            names.append(name)
            rows.append((unit[j] - mean * unit[-1]) / spread)
        at = len(self.num)
        for c in self.cat:
            there = [(v, at + i) for i, v in enumerate(self.categories[c]) if sums[at + i] > 0]
            for v, j in there[1:]:
                names.append(f"{c}_{v}")
                rows.append(unit[j])
            at += len(self.categories[c])
        for j, name in enumerate(self.passthrough):
            names.append(name)
            rows.append(unit[at + j])
        return names, np.array([*rows, unit[-1]])


def design(folded: DataFrame, num: list[str] = NUM_FEATURES, cat: list[str] = CAT_FEATURES,
           passthrough: list[str] = PASSTHROUGH_FEATURES, extra_features: dict[str, str] | None = None,
           fold: str = "fold", key: str = KEY, label: str = TARGET, max_categories: int = MAX_CATEGORIES) -> Design:
    """Common coordinates of the rows, stored once, and their sums by fold and label."""
    extra = dict(extra_features or {})
    num = [*num, *[n for n in extra if n not in num]]
    engineered = FeatureEngineer(extra).transform(folded)
    scaler, onehot = fit_scaler_and_encoder(engineered, num, cat, max_categories)
    first = engineered.agg(F.count("*").alias("n"), *[F.min(F.col(c).cast("string")).alias(c) for c in cat]).first()
    known = dict(zip(cat, onehot.getOrDefault(onehot.categories)))
    categories = {c: [v for v in (first[c], *known[c]) if v is not None] for c in cat}
    z = [(F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, m, s in scaler.parameters()]
    z += [F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("double"), F.lit(0.0)) for c in cat for v in categories[c]]
    z += [F.col(c).cast("double") for c in passthrough]
    rows = materialize(engineered.select(F.col(key).alias("key"), F.col(fold).cast("int").alias("fold"),
                                         F.col(label).cast("int").alias("y"), F.array(*z).alias("z")), "common-rows")
    bad = F.exists("z", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    each = rows.groupBy("fold", "y").agg(
        F.count("*").alias("n"), F.count_if(bad).alias("bad"), *[F.sum(F.get("z", F.lit(j))).alias(f"s{j}") for j in range(len(z))],
        *[F.sum(F.get("z", F.lit(j)) ** 2).alias(f"q{j}") for j in range(len(num))]).collect()
    if any(r["bad"] for r in each):
        raise ValueError("features hold nulls, NaN or infinities")
    totals = {(r["fold"], r["y"]): {"n": r["n"], "sums": np.array([r[f"s{j}"] for j in range(len(z))]),
                                    "squares": np.array([r[f"q{j}"] for j in range(len(num))])} for r in each}
    return Design(rows, list(num), list(cat), list(passthrough), categories, totals)


def _class_weights(counts: dict[int, int], mode: str | None) -> tuple[float, float]:
    """Weights of label 0 and 1."""
    n0, n1 = float(counts[0]), float(counts[1])
    if mode is None:
        return 1.0, 1.0
    if mode == "balanced":
        return ((n0 + n1) / (2 * n0) if n0 else 0.0, (n0 + n1) / (2 * n1) if n1 else 0.0)
    if mode == "positive":
        return 1.0, n0 / n1 if n1 else 0.0
    raise ValueError(f"unknown weight mode {mode!r}")


def _matrix(column) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def _sigmoid(m: np.ndarray) -> np.ndarray:
    return np.where(m >= 0, 1.0, np.exp(-np.abs(m))) / (1.0 + np.exp(-np.abs(m)))


def _evaluate(theta: np.ndarray, without: np.ndarray, weights: np.ndarray):
    """Per task and model: loss, gradient and packed second derivatives over common coordinates.

    theta: (width + 1) x models; without: fold of each model; weights: models x 2."""
    width = theta.shape[0]
    upper = np.triu_indices(width)

    def go(batches):
        from pyspark import TaskContext
        total = np.zeros((theta.shape[1], 1 + width + len(upper[0])))
        for batch in batches:
            z = _matrix(batch.column("z"))
            y, fold = (np.asarray(batch.column(c)) for c in ("y", "fold"))
            for k in range(0, len(z), ROWS):
                x = np.hstack([z[k:k + ROWS], np.ones((len(z[k:k + ROWS]), 1))])
                own = y[k:k + ROWS]
                w = np.where(fold[k:k + ROWS, None] == without, 0.0, weights[:, own].T)
                margin = x @ theta
                small = np.exp(-np.abs(margin))
                p = np.where(margin >= 0, 1.0, small) / (1.0 + small)
                loss = np.maximum(margin, 0) - margin * own[:, None] + np.log1p(small)
                total[:, 0] += (w * loss).sum(0)
                total[:, 1:1 + width] += (w * (p - own[:, None])).T @ x
                total[:, 1 + width:] += (w * p * (1 - p)).T @ (x[:, upper[0]] * x[:, upper[1]])
        n = len(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(n, dtype=np.int32)), pa.array(np.full(n, TaskContext.get().partitionId(), np.int32)),
             pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * total.shape[1]), pa.array(total.reshape(-1)))],
            names=["model", "task", "sums"])
    return go


def _added(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The tasks' sums of one model, added in the order of the tasks, so that a rerun gives the same."""
    table = table.sort_by("task")
    sums = _matrix(table.column("sums").combine_chunks()).sum(0)
    return pa.table({"model": table.column("model").slice(0, 1), "sums": pa.array([sums.tolist()], pa.list_(pa.float64()))})


def _sums(rows: DataFrame, theta: np.ndarray, without: np.ndarray, weights: np.ndarray) -> np.ndarray:
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    found = (rows.select("fold", "y", "z").mapInArrow(_evaluate(theta, without, weights), "model int, task int, sums array<double>")
             .groupBy("model").applyInArrow(_added, "model int, sums array<double>").toArrow())
    out = np.empty((theta.shape[1], 1 + len(theta) + len(theta) * (len(theta) + 1) // 2))
    out[np.asarray(found.column("model").combine_chunks())] = _matrix(found.column("sums").combine_chunks())
    return out


class _Newton:
    """State of one model on the driver."""

    def __init__(self, fit: Fit, of: Design, maps: dict):
        self.fit = fit
        self.names, self.map = maps[fit.fold]
        counts = of.counts(fit.fold)
        n = counts[0] + counts[1]
        self.weights = _class_weights(counts, fit.weight_mode)
        self.weight = self.weights[0] * counts[0] + self.weights[1] * counts[1]
        self.ridge = np.zeros(len(self.map))
        if fit.penalty and n:
            self.ridge[:-1] = 1.0 / (fit.C * n)
        self.at, self.step = np.zeros(len(self.map)), np.zeros(len(self.map))
        self.loss, self.gradient, self.iterations = np.inf, np.inf, 0
        self.done = not self.weight

    def common(self) -> np.ndarray:
        return self.map.T @ (self.at + self.step)

    def learn(self, sums: np.ndarray, tolerance: float) -> None:
        size = self.map.shape[1]
        there = self.at + self.step
        loss = sums[0] / self.weight + 0.5 * float(self.ridge @ there ** 2)
        if not loss <= self.loss + 1e-13 * abs(self.loss):
            self.step = self.step / 2
            self.done = float(np.abs(self.step).max()) < 1e-15
            return
        self.at, self.loss, self.iterations = there, loss, self.iterations + 1
        gradient = self.map @ sums[1:1 + size] / self.weight + self.ridge * there
        self.gradient = float(np.abs(gradient).max())
        second = np.zeros((size, size))
        second[np.triu_indices(size)] = sums[1 + size:]
        second = second + np.triu(second, 1).T
        second = self.map @ second @ self.map.T / self.weight + np.diag(self.ridge)
        if self.gradient <= tolerance:
            self.step, self.done = np.zeros_like(there), True
        else:
            # Directions without curvature (a constant feature) are left where they are.
            self.step = -np.linalg.pinv(second, rcond=1e-13, hermitian=True) @ gradient


def fit_all(of: Design, fits: list[Fit], tolerance: float = TOLERANCE, max_iter: int = MAX_ITER) -> list[Fitted]:
    """All models, by Newton steps whose sums are taken for all open models in one pass."""
    maps = {k: of.to_fold(k) for k in {f.fold for f in fits}}
    # Equal models (without a penalty C says nothing) are fitted once.
    by_model = {_told_apart(f): _Newton(f, of, maps) for f in fits}
    states = list(by_model.values())
    size = of.width + 1
    chunk = max(1, CHUNK // (1 + size + size * (size + 1) // 2))
    for _ in range(max_iter):
        open_ = [s for s in states if not s.done]
        for k in range(0, len(open_), chunk):
            part = open_[k:k + chunk]
            theta = np.stack([s.common() for s in part], 1)
            without = np.array([-1 if s.fit.fold is None else s.fit.fold for s in part])
            for s, sums in zip(part, _sums(of.rows, theta, without, np.array([s.weights for s in part]))):
                s.learn(sums, tolerance)
        if not open_:
            break
    done = {m: Fitted(s.names, s.at[:-1], float(s.at[-1]), s.gradient, s.iterations, s.map.T @ s.at) for m, s in by_model.items()}
    return [done[_told_apart(f)] for f in fits]


def held_out_scores(of: Design, fits: list[Fit], fitted: list[Fitted], trials: list[int]) -> DataFrame:
    """``(trial, key, y, fold, p)``: every row scored by each trial's model that never saw it."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    by_fold = {}
    for k in {f.fold for f in fits}:
        own = [i for i, f in enumerate(fits) if f.fold == k]
        by_fold[k] = np.stack([fitted[i].common for i in own], 1), np.array([trials[i] for i in own], np.int32)

    def score(batches):
        for batch in batches:
            z = _matrix(batch.column("z"))
            fold = np.asarray(batch.column("fold"))
            for k, (theta, trial) in by_fold.items():
                rows = np.flatnonzero(fold == k)
                for a in range(0, len(rows), ROWS):
                    part = rows[a:a + ROWS]
                    p = _sigmoid(np.hstack([z[part], np.ones((len(part), 1))]) @ theta)
                    at = pa.array(np.repeat(part, len(trial)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.tile(trial, len(part))), *(batch.column(c).take(at) for c in ("key", "y", "fold")),
                         pa.array(p.reshape(-1))], names=["trial", "key", "y", "fold", "p"])

    kind = dict(of.rows.dtypes)["key"]
    return of.rows.mapInArrow(score, f"trial int, key {kind}, y int, fold int, p double")


def trial_fits(of: Design, params: list[dict], weight_mode: str | None = "balanced") -> tuple[list[Fit], list[int]]:
    """One fit per trial and fold, with the trial's number."""
    folds = sorted({fold for fold, _ in of.totals})
    fits = [(Fit(k, p.get("C", 1.0), p.get("penalty", "l2"), weight_mode), t) for t, p in enumerate(params) for k in folds]
    return [f for f, _ in fits], [t for _, t in fits]


def logistic_search(spark: SparkSession, folded: DataFrame, space: dict, n_trials: int, seed: int = SEED_SAMPLER,
                    weight_mode: str | None = "balanced", t: float = 0.5, weights: dict[str, float] = SCORE_WEIGHTS,
                    of: Design | None = None) -> tuple[DataFrame, dict]:
    """``search.random_search`` with the pooled objective for the logistic family, all trials and
    folds fitted together: the trials table ``(trial, params, score)`` and the best parameters."""
    of = of or design(folded)
    params = [search.draw(space, trial, seed) for trial in range(n_trials)]
    # Trials whose parameters say the same model are fitted, scored and measured once.
    model = [_told_apart(Fit(None, p.get("C", 1.0), p.get("penalty", "l2"))) for p in params]
    first = {m: i for i, m in reversed(list(enumerate(model)))}
    own = sorted(first.values())
    fits, trials = trial_fits(of, [params[i] for i in own], weight_mode)
    scored = materialize(held_out_scores(of, fits, fit_all(of, fits), [own[i] for i in trials]).select("trial", "y", "p"), "oof")
    found = {r["trial"]: r for r in curves.metrics_by_fold(scored, t, fold="trial", distinct=True).collect()}
    each = [found[first[m]] for m in model]
    res = [(i, p, weights["F1"] * each[i]["f1"] + weights["Recall"] * each[i]["recall"]
            + weights["ROC-AUC"] * (each[i]["roc_auc"] or 0.0)) for i, p in enumerate(params)]
    table = spark.createDataFrame([(i, {k: str(v) for k, v in p.items()}, float(s)) for i, p, s in res],
                                  "trial int, params map<string,string>, score double")
    return table, max(res, key=lambda r: (r[2], -r[0]))[1]
