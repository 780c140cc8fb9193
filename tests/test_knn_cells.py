"""Cells that queries visit: dealt by the number of queries, found without looking at every cell."""

import numpy as np
from pyspark.ml.functions import array_to_vector

from attrition.operators import knn


def frame(spark, points):
    rows = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "CustomerId long, v array<double>")
    return rows.select("CustomerId", array_to_vector("v").alias("features"))


def nearest(points, k):
    far = np.square(points[:, None] - points[None]).sum(2)
    np.fill_diagonal(far, np.inf)
    order = np.lexsort((np.broadcast_to(np.arange(len(points)), far.shape), far))[:, :k]
    return {(i, r + 1): int(order[i, r]) for i in range(len(points)) for r in range(k)}


def test_cells_are_found_in_many_tasks(spark, monkeypatch):
    """the cells of all queries were found in as many tasks as their small file had parts."""
    points = np.random.default_rng(3).random((300, 4))
    rows = frame(spark, points)
    tasks, plain = [], type(rows).mapInArrow
    monkeypatch.setattr(knn, "CELL", 4)
    monkeypatch.setattr(knn, "QUERIES", 32)

    def counted(self, f, schema):
        if str(schema).startswith("h1 long, h2 long, x"):
            tasks.append(self.rdd.getNumPartitions())
        return plain(self, f, schema)

    monkeypatch.setattr(type(rows), "mapInArrow", counted)
    got = {(r["query"], r["rank"]): r["neighbour"] for r in knn.knn(rows, rows, k=3).collect()}
    assert got == nearest(points, 3)
    assert len(tasks) == 2 and min(tasks) >= 300 // 32


def test_few_cells_are_compared_with_a_query():
    """every query was compared with every cell."""
    rng = np.random.default_rng(4)
    points = rng.random((8192, 2))
    nodes = knn.build_tree(points, 2048)
    leaf = knn.find_leaves(nodes, points)
    size = np.bincount(leaf)
    low, high = (np.stack([f(points[leaf == c], axis=0) for c in range(len(size))]) for f in (np.min, np.max))
    boxes = knn._Boxes(size, low, high, 6)
    queries, own, radius = points[:64], leaf[:64], np.full(64, 1e-3)
    row, cell = (np.concatenate(v) for v in zip(*boxes.reached(queries, own, radius)))
    start = set(zip(*(v.tolist() for v in boxes.start(own))))
    want = {(int(r), int(c)) for r, c in zip(*np.nonzero(knn._box_distance(queries, low, high) <= knn._slack(radius)[:, None]))}
    assert set(zip(row.tolist(), cell.tolist())) == want - start
    assert all(size[[c for r, c in start if r == q]].sum() >= 6 for q in range(64))
    compared = []
    plain = boxes._within

    def seen(x, limit, level, row, box):
        compared.append(len(row) * knn.GROUP if level else 0)
        yield from plain(x, limit, level, row, box)

    boxes._within = seen
    list(boxes.reached(queries, own, radius))
    assert sum(compared) + 64 * len(boxes.levels[-1][0]) < 64 * len(size) / 4


def test_rows_of_one_point_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(knn, "ROWS", 8)
    points = np.r_[np.zeros((100, 3)), np.random.default_rng(5).random((50, 3))]
    rows = frame(spark, points)
    got = {(r["query"], r["rank"]): r["neighbour"] for r in knn.knn(rows, rows, k=3).collect()}
    assert got == nearest(points, 3)
