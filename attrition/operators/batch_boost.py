"""Many boosted classifiers at once: every model's rows are blocks of one table.

A comparison boosts the same number of rounds for each strategy and fold. Spark's ``GBTClassifier``
runs a few jobs a level for each of them alone; here one pass over the stored blocks (``mapInArrow``)
adds up the histograms of all open models, so a round costs as many passes as a tree has levels,
however many models there are. The trees are those of ``GBTClassifier``: its split candidates, its
pseudo-residuals of the log loss, its gain, first best split and mean of a leaf, step 1 for the first
tree and the step size for the others.

A block holds up to ``BLOCK`` rows of one model: bins of every feature in one byte, labels, and the
margins after the trees that were grown when it was stored. Trees grown since are walked again in every
pass; every ``STORE`` rounds the margins are stored. Tasks return sums of the order of models x
features x bins, never rows; beyond ``DIRECT`` tasks these are added up in Spark before the driver sees them.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.session import materialize, release

#: Rows of a block.
BLOCK = 1 << 15
#: Rounds between two stores of the margins.
STORE = 10
#: Tasks whose sums the driver adds up itself.
DIRECT = 64
#: Rows that Spark takes its split candidates from (at least; maxBins squared if that is more).
CANDIDATES = 10_000
#: Bytes of blocks in a stored file.
FILE = 1 << 25
_BLOCK = "model int, rows int, bins binary, y binary, margin binary"
_EPSILON = 2.0 ** -52


@dataclass
class Boost:
    """One model: its rows (vectors and labels 0 and 1), rows and weight of either label, its learner."""
    rows: DataFrame
    counts: dict[int, int]
    weights: tuple[float, float]
    learner: GBTClassifier
    cuts: list[np.ndarray] = field(default_factory=list)
    trees: list[tuple] = field(default_factory=list)  # (feature, bin, value) of a whole tree's nodes, and its weight

    def of(self, name: str):
        return self.learner.getOrDefault(name)


def supports(learner: Estimator) -> bool:
    """Whether a learner is one whose trees are grown here."""
    if type(learner) is not GBTClassifier:
        return False
    of = learner.getOrDefault
    return (of("subsamplingRate") == 1.0 and of("featureSubsetStrategy") == "all" and of("lossType") == "logistic"
            and of("maxBins") <= 128 and of("maxDepth") <= 7 and of("minWeightFractionPerNode") == 0.0
            and not learner.isSet("validationIndicatorCol"))


# ------------------------------------------------------------ split candidates
def candidate_cuts(values: np.ndarray, weights: np.ndarray, expected: float, most: int) -> np.ndarray:
    """At most ``most`` thresholds of a feature, as Spark places them: midpoints of all values that
    occur if these are few, otherwise about ``expected / (most + 1)`` of weight apart. Zeros count as what the
    other values leave of the expected weight."""
    there = values != 0
    if not there.any():
        return np.empty(0)
    value, which = np.unique(values[there], return_inverse=True)
    weight = np.bincount(which, weights=weights[there])
    if expected - weight.sum() > _EPSILON * there.sum() * 100:
        at = int(np.searchsorted(value, 0.0))
        value, weight = np.insert(value, at, 0.0), np.insert(weight, at, expected - weight.sum())
    middle = (value[:-1] + value[1:]) / 2
    if len(middle) <= most:
        return middle
    stride = expected / (most + 1)
    out, target, current = [], stride, weight[0]
    for k in range(1, len(value)):
        before, current = current, current + weight[k]
        if abs(before - target) < abs(current - target):
            out.append(middle[k - 1])
            target += stride
    return np.array(out)


def _sampled(rows: DataFrame, share: float, seed: int) -> DataFrame:
    """The rows that Spark's own learner would take its candidates from."""
    spark = rows.sparkSession
    drawn = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
    jdf = spark._jsparkSession.createDataFrame(rows._jdf.toJavaRDD().sample(False, share, drawn), rows._jdf.schema())
    return DataFrame(jdf, spark)


def _cuts(model: Boost) -> list[np.ndarray]:
    n = sum(model.counts.values())
    if not n:
        raise ValueError("no rows to fit on")
    bins = min(model.of("maxBins"), n)
    wanted = max(bins * bins, CANDIDATES)
    share = wanted / n if wanted < n else 1.0
    rows = model.rows.select(model.of("featuresCol"), model.of("labelCol"))
    if share < 1.0:
        rows = _sampled(rows, share, model.of("seed"))
    found = rows.select(vector_to_array(F.col(model.of("featuresCol"))).alias("x"), F.col(model.of("labelCol")).cast("int").alias("y")).toArrow()
    x, y = _matrix(found.column("x")), np.asarray(found.column("y"))
    weights = np.where(y == 1, model.weights[1], model.weights[0])
    expected = share * (model.counts.get(0, 0) * model.weights[0] + model.counts.get(1, 0) * model.weights[1])
    return [candidate_cuts(x[:, f], weights, expected, bins - 1) for f in range(x.shape[1])]


# ---------------------------------------------------------------------- blocks
def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Bin of every value, a feature a row: the first whose threshold is not below it."""
    return np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)]).astype(np.uint8)


def _pack(number: int, cuts: list[np.ndarray]):
    def go(batches):
        held: list[tuple] = []

        def block():
            bins, y = (np.concatenate(part, axis=-1) for part in zip(*held))
            held.clear()
            return pa.RecordBatch.from_pydict({
                "model": pa.array([number], pa.int32()), "rows": pa.array([len(y)], pa.int32()), "bins": pa.array([bins.tobytes()], pa.binary()),
                "y": pa.array([y.tobytes()], pa.binary()), "margin": pa.array([np.zeros(len(y)).tobytes()], pa.binary())})

        for batch in batches:
            x, y = _matrix(batch.column("x")), np.asarray(batch.column("y").fill_null(-1))
            if not np.isfinite(x).all() or len(x) != batch.num_rows or not np.isin(y, (0, 1)).all():
                raise ValueError("features hold nulls, NaN or infinities, or labels other than 0 and 1")
            for k in range(0, len(x), BLOCK):
                part = _binned(x[k:k + BLOCK], cuts), y[k:k + BLOCK].astype(np.uint8)
                if held and sum(len(h[1]) for h in held) + len(part[1]) > BLOCK:
                    yield block()
                held.append(part)
        if held:
            yield block()
    return go


def _blocks(models: list[Boost]) -> DataFrame:
    """All models' rows in blocks, dealt evenly over files."""
    out = None
    for number, model in enumerate(models):
        rows = model.rows.select(vector_to_array(F.col(model.of("featuresCol"))).alias("x"), F.col(model.of("labelCol")).cast("int").alias("y"))
        one = rows.mapInArrow(_pack(number, model.cuts), _BLOCK)
        out = one if out is None else out.unionByName(one)
    n = sum(sum(m.counts.values()) for m in models)
    width = max(len(m.cuts) for m in models) + 9
    files = max(2 * out.sparkSession.sparkContext.defaultParallelism, n * width // FILE)
    return materialize(out.repartition(files), "boost")


# ----------------------------------------------------------------------- trees
def _levels(tree: tuple) -> int:
    return (len(tree[0]) + 1).bit_length() - 1


def _descend(bins: np.ndarray, feature, cut, levels: int) -> np.ndarray:
    """Place among the nodes of a level (from the left) of every row. A node that does not split
    (feature -1) sends its rows to the left."""
    node = np.zeros(bins.shape[1], np.uint8)
    for level in range(levels):
        right = np.zeros(len(node), bool)
        for k in range(1 << level):
            at = (1 << level) - 1 + k
            if feature[at] >= 0:
                right |= (node == k) & (bins[feature[at]] > cut[at])
        node = node * 2 + right
    return node


def _add_margin(margin: np.ndarray, bins: np.ndarray, trees: list[tuple]) -> np.ndarray:
    for feature, cut, value, weight in trees:
        margin = margin + value[_descend(bins, feature, cut, _levels((feature,)))] * weight
    return margin


def _unpacked(batch, row: int):
    n = batch.column("rows")[row].as_py()
    bins, y, margin = (np.frombuffer(batch.column(c)[row].as_buffer(), t) for c, t in (("bins", np.uint8), ("y", np.uint8), ("margin", np.float64)))
    return bins.reshape(-1, n), y, margin


def _histograms(state: dict):
    """Per task and model: for (feature, node of the level, bin) rows, their weight, and the weighted sums of
    targets and squared targets.

    state: model -> trees grown since the margins were stored, whether none was grown before, features and
    thresholds of the tree that grows, its levels, the number of bins, and the weights of labels 0 and 1."""
    def go(batches):
        from pyspark import TaskContext
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, number in enumerate(batch.column("model").to_pylist()):
                if number not in state:
                    continue
                trees, first, feature, cut, levels, width, weights = state[number]
                bins, y, margin = _unpacked(batch, row)
                target = np.where(y == 1, 1.0, -1.0)
                if not first:
                    # Arrow's exponential is the C library's, which rounds as the JVM's does.
                    target = 4.0 * target / (1.0 + np.asarray(pc.exp(pa.array(2.0 * target * _add_margin(margin, bins, trees)))))
                plain = weights == (1.0, 1.0)
                weight = None if plain else np.where(y == 1, weights[1], weights[0])
                once = target if plain else weight * target
                twice = once * target
                base = _descend(bins, feature, cut, levels).astype(np.int64) * width
                size = width << levels
                if number not in total:
                    total[number] = np.zeros((4, len(bins), size))
                sums = total[number]
                for f in range(len(bins)):
                    at = base + bins[f]
                    n = np.bincount(at, minlength=size)
                    sums[0, f] += n
                    sums[1, f] += n if plain else np.bincount(at, weights=weight, minlength=size)
                    sums[2, f] += np.bincount(at, weights=once, minlength=size)
                    sums[3, f] += np.bincount(at, weights=twice, minlength=size)
        task = TaskContext.get().partitionId()
        for number, sums in total.items():
            yield pa.RecordBatch.from_pydict({"model": pa.array([number], pa.int32()), "task": pa.array([task], pa.int32()),
                                              "sums": pa.array([sums.tobytes()], pa.binary())})
    return go


def _added(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The tasks' sums of one model, added in the order of the tasks, so that a rerun gives the same."""
    table = table.sort_by("task")
    sums = sum(np.frombuffer(s.as_buffer(), np.float64) for s in table.column("sums"))
    return pa.table({"model": table.column("model").slice(0, 1), "task": table.column("task").slice(0, 1), "sums": pa.array([sums.tobytes()], pa.binary())})


def _sums(blocks: DataFrame, files: int, state: dict) -> dict[int, np.ndarray]:
    shape = "model int, task int, sums binary"
    found = blocks.mapInArrow(_histograms(state), shape)
    if files > DIRECT:
        found = found.groupBy("model").applyInArrow(_added, shape)
    out: dict[int, np.ndarray] = {}
    for r in found.toArrow().sort_by([("model", "ascending"), ("task", "ascending")]).to_pylist():
        sums = np.frombuffer(r["sums"], np.float64)
        out[r["model"]] = out[r["model"]] + sums if r["model"] in out else sums
    return out


def _impurity(weight, once, twice):
    """Variance of the targets, 0 without any weight."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(weight == 0, 0.0, (twice - once * once / weight) / weight)


class _Tree:
    """A tree that grows by levels: of its nodes, left to right and level by level, feature (-1: a leaf) and
    bin; of the nodes of the last level, mean, impurity and whether they are open."""

    def __init__(self):
        self.feature, self.cut = np.empty(0, np.int64), np.empty(0, np.int64)
        self.value, self.impurity, self.open, self.levels = np.zeros(1), np.zeros(1), np.ones(1, bool), 0

    def grow(self, sums: np.ndarray, model: Boost, width: int) -> None:
        """Split the open nodes at their best (feature, bin), given the histograms of the last level."""
        nodes = 1 << self.levels
        left = np.cumsum(sums.reshape(4, len(model.cuts), nodes, width), axis=3)
        every = left[..., -1:]
        right = every - left
        if self.levels == 0:
            # The root as Spark has it: both sides of the first split.
            f = next((f for f, cuts in enumerate(model.cuts) if len(cuts)), 0)
            _, weight, once, twice = left[:, f, 0, 0] + right[:, f, 0, 0]
            self.value[0], self.impurity[0] = once / weight if weight else 0.0, _impurity(weight, once, twice)
        impure_left, impure_right = _impurity(*left[1:]), _impurity(*right[1:])
        with np.errstate(divide="ignore", invalid="ignore"):
            both = left[1] + right[1]
            gain = self.impurity[None, :, None] - left[1] / both * impure_left - right[1] / both * impure_right
        least = model.of("minInstancesPerNode")
        bad = (left[0] < least) | (right[0] < least) | ~(gain >= model.of("minInfoGain"))
        bad |= np.arange(width) >= np.array([len(cuts) for cuts in model.cuts])[:, None, None]
        gain[bad] = -np.inf
        feature, cut = np.full(nodes, -1), np.zeros(nodes, np.int64)
        value, impurity, open_ = np.repeat(self.value, 2), np.repeat(self.impurity, 2), np.zeros(2 * nodes, bool)
        for k in np.flatnonzero(self.open):
            f, b = np.unravel_index(int(gain[:, k].argmax()), gain[:, k].shape)
            if gain[f, k, b] <= 0:
                continue
            feature[k], cut[k] = f, b
            for at, side, impure in ((2 * k, left, impure_left), (2 * k + 1, right, impure_right)):
                _, weight, once, _ = side[:, f, k, b]
                value[at], impurity[at] = once / weight if weight else 0.0, impure[f, k, b]
                open_[at] = abs(impurity[at]) >= _EPSILON
        self.feature, self.cut = np.r_[self.feature, feature], np.r_[self.cut, cut]
        self.value, self.impurity, self.open, self.levels = value, impurity, open_, self.levels + 1


def fit_all(models: list[Boost]) -> list[Boost]:
    """Grow all models' trees, level by level in shared passes; their ``cuts`` and ``trees`` are set."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=5) as pool:
        for model, cuts in zip(models, pool.map(_cuts, models)):
            model.cuts, model.trees = cuts, []
    blocks = _blocks(models)
    files, stored = len(blocks.inputFiles()), 0
    for t in range(max(m.of("maxIter") for m in models)):
        growing = {k: _Tree() for k, m in enumerate(models) if t < m.of("maxIter")}
        for level in range(max(models[k].of("maxDepth") for k in growing)):
            state, width = {}, {}
            for k, tree in growing.items():
                if level < models[k].of("maxDepth") and tree.open.any():
                    width[k] = 1 + max(map(len, models[k].cuts), default=0)
                    state[k] = models[k].trees[stored:], t == 0, tree.feature, tree.cut, level, width[k], models[k].weights
            for k, sums in (_sums(blocks, files, state) if state else {}).items():
                growing[k].grow(sums, models[k], width[k])
        for k, tree in growing.items():
            models[k].trees.append((tree.feature, tree.cut, tree.value, 1.0 if t == 0 else models[k].of("stepSize")))
        if (t + 1) % STORE == 0 and t + 1 < max(m.of("maxIter") for m in models):
            before, blocks = blocks, materialize(blocks.mapInArrow(_with_margins([m.trees[stored:] for m in models]), _BLOCK), "boost")
            release(before)
            files, stored = len(blocks.inputFiles()), t + 1
    release(blocks)
    return models


def _with_margins(trees: list[list[tuple]]):
    def go(batches):
        for batch in batches:
            for row, number in enumerate(batch.column("model").to_pylist()):
                bins, _, margin = _unpacked(batch, row)
                margin = _add_margin(margin, bins, trees[number])
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(row, 1) for c in ("model", "rows", "bins", "y")),
                                                  pa.array([margin.tobytes()], pa.binary())], names=["model", "rows", "bins", "y", "margin"])
    return go


def probability(model: Boost, features: str = "features") -> Column:
    """Probability of label 1 of a fitted model."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    cuts, trees = model.cuts, model.trees

    def total(column: pa.Array) -> pa.Array:
        x = _matrix(column)
        return pa.array(_add_margin(np.zeros(len(x)), _binned(x, cuts), trees) if len(x) else np.empty(0))

    return 1 - 1 / (1 + F.exp(2 * F.arrow_udf(total, "double")(vector_to_array(F.col(features)))))
