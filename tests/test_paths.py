"""Tree SHAP over packed paths against Shapley's sum over all subsets, and for deep ensembles."""

import itertools
import math

import numpy as np
import pytest

from attrition.operators import explain, models, paths
from attrition.operators.preprocess import feature_names
from attrition.plans.training import prepare
from attrition.sources.profile import customer_profile
from conftest import SF_SMALL


def grown(rng, features, depth, leaf_share=0.15):
    """A random tree as arrays of nodes; covers add up, some leaves have none."""
    tree = {c: [] for c in ("left", "right", "feature", "cut", "cover", "value")}

    def grow(level, cover):
        at = len(tree["left"])
        for column, v in zip(tree.values(), (-1, -1, -1, 0.0, cover, float(rng.standard_normal()))):
            column.append(v)
        if level and rng.random() > leaf_share and (cover > 0 or rng.random() < 0.2):
            tree["feature"][at], tree["cut"][at] = int(rng.integers(features)), float(rng.standard_normal())
            left = float(rng.integers(0, int(cover) + 1))
            tree["left"][at] = grow(level - 1, left)
            tree["right"][at] = grow(level - 1, cover - left)
        return at

    grow(depth, 100.0)
    return [np.array(c) for c in tree.values()]


def expectation(tree, x, known, node=0):
    """Cover-weighted value where features outside ``known`` take both ways."""
    left, right, feature, cut, cover, value = tree
    if left[node] < 0:
        return value[node]
    if feature[node] in known:
        return expectation(tree, x, known, left[node] if x[feature[node]] <= cut[node] else right[node])
    if cover[node] == 0:
        return 0.0
    return sum(cover[c] / cover[node] * expectation(tree, x, known, c) for c in (left[node], right[node]))


def shapley(tree, x, d):
    out = np.zeros(d)
    for j in range(d):
        for size in range(d):
            weight = math.factorial(size) * math.factorial(d - size - 1) / math.factorial(d)
            for s in itertools.combinations([k for k in range(d) if k != j], size):
                out[j] += weight * (expectation(tree, x, {*s, j}) - expectation(tree, x, set(s)))
    return out


def chunks_of(trees, scale=1.0):
    return [c for i, t in enumerate(trees) for c in paths.pack(i, scale, t[0], t[1], t[2], t[3], t[4], t[5])]


@pytest.mark.parametrize("depth", [0, 1, 2, 3, 5])
def test_each_feature_by_all_subsets(depth):
    rng = np.random.default_rng(depth)
    for _ in range(25):
        tree, x = grown(rng, 4, depth), rng.standard_normal((6, 4))
        chunks, phi = chunks_of([tree]), np.zeros((6, 4))
        for c in chunks:
            paths.add_chunk(phi, x, c)
        assert np.abs(phi - np.array([shapley(tree, row, 4) for row in x])).max() < 1e-10
        assert sum(c["base"] for c in chunks) == pytest.approx(expectation(tree, x[0], set()))


def test_fitted_forest_by_all_subsets(spark):
    """A fitted forest of depth 3 per feature, nodes read back from Spark's model."""
    train = prepare(customer_profile(spark, SF_SMALL), 3)[0].drop("fold")
    m = models.strategy_pipeline("Random Forest", "class_weight", num_trees=3, max_depth=3).fit(train)
    trees, _, _ = explain.tree_tables(m.stages[-1], spark)
    names = feature_names(m)
    shap, base = explain.tree_shap(m, train.where("CustomerId <= 12"))
    got = {}
    for r in shap.collect():
        got.setdefault(r["CustomerId"], np.zeros((2, len(names))))[:, r["feature_idx"]] = r["shap"], r["value"]
    used = sorted({int(f) for t in trees for f in t["feature"] if f >= 0})
    assert len(got) > 3
    for phi, x in got.values():
        hand = np.zeros(len(names))
        for t in trees:
            own = sorted({int(f) for f in t["feature"] if f >= 0})
            arrays = (t["left"], t["right"], np.array([own.index(f) if f >= 0 else -1 for f in t["feature"]]),
                      np.array([s[0] if len(s) else 0.0 for s in t["split"]]), t["cover"], t["value"])
            hand[own] += shapley(arrays, x[own], len(own)) / len(trees)
        assert np.abs(phi - hand).max() < 1e-9 and set(np.flatnonzero(phi)) <= set(used)


def test_800_trees_of_depth_20_in_bounded_pieces(spark, monkeypatch):
    """The dealt way equals the shipped one, sums are exact, no piece passes its bound."""
    rng = np.random.default_rng(7)
    trees = [grown(rng, 12, 20, 0.35) for _ in range(800)]
    assert max(len(t[0]) for t in trees) > 200
    chunks = chunks_of(trees, 1 / 800)
    assert max(len(c["feature"]) // 4 for c in chunks) <= paths.CHUNK
    table = spark.createDataFrame(chunks, paths._CHUNK).repartition(4)
    x = rng.standard_normal((300, 12))
    rows = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "CustomerId long, x array<double>").repartition(3)
    names = [f"f{j}" for j in range(12)]
    monkeypatch.setattr(paths, "GROUP_BYTES", 1 << 19)
    monkeypatch.setattr(paths, "ROWS", 64)
    monkeypatch.setattr(paths, "BLOCKS", 1)
    table = table.cache()
    found = {}
    for ship in (1 << 40, 0):
        shap, base = paths.explain(rows, table, names, "CustomerId", ship_bytes=ship)
        out = np.full((300, 12), np.nan)
        for r in shap.collect():
            out[r["CustomerId"], r["feature_idx"]] = r["shap"]
            assert r["feature"] == names[r["feature_idx"]] and r["value"] == x[r["CustomerId"], r["feature_idx"]]
        found[ship] = out
    assert np.abs(found[0] - found[1 << 40]).max() < 1e-12
    everything = set(range(12))
    scores = np.array([sum(expectation(t, row, everything) for t in trees) / 800 for row in x[:40]])
    assert np.abs(found[0][:40].sum(1) + base - scores).max() < 1e-10
