"""The expanded density against the plain sum of kernels."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from attrition.operators import eda


def plain(values, x):
    bw = values.std(ddof=1) * len(values) ** -0.2
    return np.exp(-0.5 * ((x[:, None] - values) / bw) ** 2).sum(1) * eda.GAUSS_NORM / (len(values) * bw)


@pytest.mark.parametrize("kind", ["normal", "two far clusters", "heavy tail", "integers", "copies"])
def test_density(spark, kind):
    rng = np.random.default_rng(1)
    made = {"normal": rng.standard_normal(3000) * 5e4 + 1e6, "two far clusters": np.r_[rng.standard_normal(500), 1e5 + rng.standard_normal(20)],
            "heavy tail": rng.standard_cauchy(800), "integers": rng.integers(0, 60, 900).astype(float), "copies": np.r_[np.zeros(700), rng.random(50)]}[kind]
    label = (np.arange(len(made)) % 3 == 0).astype(int)
    frame = spark.createDataFrame([(int(y), float(v)) for y, v in zip(label, made)] + [(0, None)], "Exited int, v double").repartition(4)
    got = eda.kde_by_class(frame, "v").orderBy("label", "grid_index").toPandas()
    assert len(got) == 400
    for y in (0, 1):
        own, values = got[got.label == y], made[label == y]
        exact = plain(values, own.x.to_numpy())
        assert np.abs(own.density.to_numpy() - exact).max() < 1e-12 * exact.max() + 1e-15


def test_rows_do_not_grow_with_distinct_values(spark):
    """A million different values make as many rows for the grid as their cells, not themselves."""
    frame = spark.range(1_000_000).select((F.col("id") % 2).alias("Exited"), F.randn(3).alias("v"))
    out = eda.kde_by_class(frame, "v")
    assert out.count() == 400 and out.agg(F.max("density")).first()[0] == pytest.approx(eda.GAUSS_NORM, rel=0.02)


def test_a_class_of_one_value(spark):
    frame = spark.createDataFrame([(0, 1.0), (0, 1.0), (1, 2.0), (1, 3.0)], "Exited int, v double")
    got = eda.kde_by_class(frame, "v", grid_size=5).collect()
    assert len(got) == 10 and all((r["density"] is None) == (r["label"] == 0) for r in got)
