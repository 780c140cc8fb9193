"""Boosting with an L2 leaf term: by hand, against plain Newton steps, saved and loaded."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from attrition.operators import models, search
from attrition.operators.newton_boost import NewtonBoostedModel, NewtonBoostedTrees, leaf_values, parse_tree, walk
from attrition.plans.training import SEARCH_SPACES


def frame(spark, rows):
    out = spark.createDataFrame(rows, "x double, z double, y int, weight double")
    return VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(out)


def probabilities(model, rows):
    return [r[0] for r in model.transform(rows).select(vector_to_array("probability")[1]).collect()]


def sigmoid(m):
    return 1 / (1 + math.exp(-m))


@pytest.mark.parametrize("l2", [0.0, 1.0, 7.5])
def test_two_leaves_by_hand(spark, l2):
    # At margin 0: g = w (1/2 - y), h = w / 4. Left: G = 3/2 - 1 = 1/2, H = 3/4. Right: G = -1/2, H = 5/4.
    rows = frame(spark, [(0.0, 0.0, 0, 1.0), (0.0, 0.0, 0, 1.0), (0.0, 0.0, 1, 1.0),
                         (1.0, 0.0, 1, 2.0), (1.0, 0.0, 1, 1.0), (1.0, 0.0, 0, 2.0)]).coalesce(1)
    boost = NewtonBoostedTrees(maxIter=1, stepSize=0.5, maxDepth=1, l2=l2, labelCol="y").setWeightCol("weight")
    model = boost.fit(rows)
    assert model.tree_arrays()[0]["value"] == pytest.approx([-0.5 / (0.75 + l2), 0.5 / (1.25 + l2)])
    got = probabilities(model, rows)
    assert got[0] == pytest.approx(sigmoid(-0.25 / (0.75 + l2))) and got[3] == pytest.approx(sigmoid(0.25 / (1.25 + l2)))


def made(spark, n=400):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((n, 2))
    y = (rng.random(n) < 1 / (1 + np.exp(-2 * x[:, 0] * (x[:, 1] > 0)))).astype(int)
    return frame(spark, [(float(a), float(b), int(c), 1.0) for (a, b), c in zip(x, y)]).coalesce(2).cache()


def test_rounds_follow_the_derivatives(spark):
    """Every round's leaves from the margins before it, recomputed in numpy; six rounds cross a store."""
    rows = made(spark)
    model = NewtonBoostedTrees(maxIter=6, stepSize=0.3, maxDepth=2, l2=2.0, labelCol="y").fit(rows)
    pdf = rows.select("x", "z", "y").toPandas()
    x, y = pdf[["x", "z"]].to_numpy(), pdf["y"].to_numpy()
    margin = np.zeros(len(x))
    for tree in model.tree_arrays():
        p = 1 / (1 + np.exp(-margin))
        leaf = walk(tree, x)
        for k, value in enumerate(tree["value"]):
            own = leaf == k
            assert value == pytest.approx(-(p - y)[own].sum() / ((p * (1 - p))[own].sum() + 2.0), abs=1e-9)
        margin += 0.3 * np.asarray(tree["value"])[leaf]
    assert np.abs(np.array(probabilities(model, rows)) - 1 / (1 + np.exp(-margin))).max() < 1e-9


def test_l2_to_zero_and_without_bound(spark):
    rows = made(spark)
    fit = lambda l2: np.array(probabilities(NewtonBoostedTrees(maxIter=3, maxDepth=2, l2=l2, labelCol="y").fit(rows), rows))
    plain, small, large = fit(0.0), fit(1e-9), fit(1e9)
    assert np.abs(plain - small).max() < 1e-8 and np.abs(large - 0.5).max() < 1e-6
    assert leaf_values({0: (1.0, 0.0)}, 2, 0.0) == [0.0, 0.0]


def test_saved_with_a_pipeline(spark, tmp_path):
    rows = made(spark)
    model = NewtonBoostedTrees(maxIter=2, subsamplingRate=0.7, labelCol="y").fit(rows)
    PipelineModel(stages=[model]).write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    assert isinstance(again.stages[0], NewtonBoostedModel) and probabilities(again, rows) == probabilities(model, rows)


def test_a_constant_feature_is_one_leaf(spark):
    rows = frame(spark, [(1.0, 1.0, i % 2, 1.0) for i in range(8)])
    model = NewtonBoostedTrees(maxIter=2, labelCol="y").fit(rows)
    assert [t["leaf"] for t in model.tree_arrays()] == [[0], [0]] and set(probabilities(model, rows)) == {0.5}


def test_printed_trees():
    tree = parse_tree("head\n  If (feature 3 <= 0.5)\n   Predict: 1.0\n  Else (feature 3 > 0.5)\n   If (feature 0 <= -1.0E-7)\n"
                      "    Predict: 2.0\n   Else (feature 0 > -1.0E-7)\n    Predict: 3.0\n")
    x = np.array([[0.0, 0, 0, 0], [-1.0, 0, 0, 1], [0.0, 0, 0, 1]])
    assert walk(tree, x).tolist() == [0, 1, 2]
    with pytest.raises(ValueError):
        parse_tree("head\n  If (feature 3 in {1.0})\n   Predict: 1.0\n  Else (feature 3 not in {1.0})\n   Predict: 2.0\n")


def test_l2_is_searched():
    params = search.draw(SEARCH_SPACES["Newton Boosted Trees"], 3)
    assert 0.01 <= params["l2"] <= 6.0
    assert models.strategy_pipeline("Newton Boosted Trees", "class_weight", **params).weight_mode == "balanced"
