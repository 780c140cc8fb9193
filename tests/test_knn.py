"""The neighbour search looks at few points, and finds them all."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from attrition.operators import knn as K


def minority(spark, sf):
    from attrition.plans import catalog
    tab, names = catalog._ftab(spark, f"/root/testdata/{sf}")
    rows = catalog._vectors(tab, names)
    return rows.where("Exited = 1"), rows


def test_visited_share_falls_with_the_table(spark):
    shares = {}
    for sf in ("sf0.01", "sf0.1"):
        mino, everyone = minority(spark, sf)
        for name, candidates in (("mino", mino), ("all", everyone)):
            visited = []
            assert K.knn(mino, candidates, visited=visited).count() == 5 * mino.count()
            shares[sf, name] = visited[0]
    print("visited shares:", shares)
    for name in ("mino", "all"):
        assert shares["sf0.1", name] < 0.10 and shares["sf0.1", name] < shares["sf0.01", name]


@pytest.mark.parametrize("kind, cell, leaf, pivots", [("normal", 256, 8, 16), ("normal", 8, 2, 1), ("grid", 40, 3, 4), ("line", 8, 2, 2),
                                                       ("few", 256, 8, 16)])
def test_exact_for_all_shapes(spark, monkeypatch, cell, leaf, pivots, kind):
    monkeypatch.setattr(K, "CELL", cell)
    monkeypatch.setattr(K, "LEAF", leaf)
    monkeypatch.setattr(K, "PIVOTS", pivots)
    rng = np.random.default_rng(2)
    pts = {"normal": rng.standard_normal((150, 5)), "grid": rng.integers(0, 3, (150, 3)).astype(float),
           "line": np.outer(np.arange(150) // 2, np.ones(2)), "few": rng.standard_normal((4, 2))}[kind]
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(pts)], "CustomerId long, a array<double>").select(
        "CustomerId", array_to_vector("a").alias("features"))
    got = {}
    for r in K.knn(df, df, k=5).collect():
        got.setdefault(r["query"], {})[r["rank"]] = (r["neighbour"], r["distance"])
    for i, p in enumerate(pts):
        square = sum((pts[:, d] - p[d]) ** 2 for d in range(pts.shape[1]))
        near = [j for j in np.lexsort((np.arange(len(pts)), square)) if j != i][:5]
        assert [got[i][r + 1][0] for r in range(len(near))] == near and len(got[i]) == len(near)
        assert [got[i][r + 1][1] for r in range(len(near))] == [float(np.sqrt(square[j])) for j in near]
