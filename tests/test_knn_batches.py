"""Batches of (query, cell) that the neighbour search hands on."""

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector

from attrition.operators import knn


def test_visits_leave_a_task_in_bounded_batches(spark, monkeypatch):
    """all cells that a batch of queries visits were one batch, each row with the query's vector."""
    rng = np.random.default_rng(1)
    rows = spark.createDataFrame([(i, [float(v) for v in rng.random(6)]) for i in range(300)], "CustomerId long, v array<double>")
    rows = rows.select("CustomerId", array_to_vector("v").alias("features"))
    x = np.array([r["features"].toArray() for r in rows.orderBy("CustomerId").collect()])
    functions, plain = [], type(rows).mapInArrow
    monkeypatch.setattr(knn, "CELL", 4)
    monkeypatch.setattr(knn, "BATCH", 50)
    monkeypatch.setattr(type(rows), "mapInArrow", lambda self, f, schema: functions.append((f, str(schema))) or plain(self, f, schema))
    got = {(r["query"], r["rank"]): r["neighbour"] for r in knn.knn(rows, rows, k=3).collect()}
    far = np.square(x[:, None] - x[None]).sum(2)
    np.fill_diagonal(far, np.inf)
    order = np.argsort(far, axis=1, kind="stable")[:, :3]
    assert got == {(i, r + 1): int(order[i, r]) for i in range(300) for r in range(3)}
    number = pa.array(range(300), pa.int64())
    asked = pa.RecordBatch.from_arrays([number, number, pa.array(x.tolist()), pa.nulls(300, pa.float64())], names=["h1", "h2", "x", "radius"])
    for visit, schema in functions:
        if schema.startswith("h1 long, h2 long, x"):
            sizes = [b.num_rows for b in visit([asked])]
            assert sum(sizes) >= 300 and max(sizes) <= 50
