"""Exact tree SHAP over a packed table of paths, for ensembles of any size.

Every leaf of every tree becomes one path whose splits on a feature are merged into one element: an
interval that the feature must lie in and the share of the cover that goes there. Paths of equal
length are packed into chunks of bounded size, built per tree in Spark from the model's saved nodes;
the driver holds no tree.

A path's game is v * prod(o_k or z_k): o says whether the row's feature lies in the element's
interval, z is the cover share that stands for an unknown feature. The Shapley weight of s known
features out of m - 1 is the integral of t^s (1-t)^(m-1-s), so

    phi_j = v (o_j - z_j) * integral over 0..1 of prod over k != j of (t o_k + (1-t) z_k) dt

a polynomial of degree m - 1, which Gauss-Legendre nodes (half as many as elements) integrate
exactly; all terms are positive, so nothing cancels. A pack that fits ``SHIP_BYTES`` goes with the
tasks, which explain their rows in one pass. A larger one is dealt: blocks of rows meet groups of
chunks, and the blocks' sums are added.
"""

from __future__ import annotations

import os
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.session import materialize

#: Elements of a chunk, and the size up to which a whole pack goes with every task.
CHUNK = 1 << 13
SHIP_BYTES = 16 << 20
#: Rows of a block, blocks that meet a group of chunks in one task, and that group's bytes.
ROWS = 1024
BLOCKS = 32
GROUP_BYTES = 4 << 20
#: Doubles held at once per row slice and chunk.
CELLS = 1 << 19

_CHUNK = "tree int, length int, paths int, base double, value binary, feature binary, share binary, low binary, high binary"


def merged_paths(left, right, feature, cut, cover, value):
    """(value, {feature: [share, low, high]}, cover) of every leaf; low < x <= high."""
    stack = [(0, {})]
    while stack:
        node, path = stack.pop()
        if left[node] < 0:
            yield value[node], path, cover[node]
            continue
        f = int(feature[node])
        share, low, high = path.get(f, (1.0, -np.inf, np.inf))
        for child, bounds in ((left[node], (low, min(high, cut[node]))), (right[node], (max(low, cut[node]), high))):
            part = cover[child] / cover[node] if cover[node] > 0 else 0.0
            stack.append((int(child), {**path, f: (share * part, *bounds)}))


def pack(tree: int, scale: float, left, right, feature, cut, cover, value) -> list[dict]:
    """Chunks of a tree's paths, by length; ``base`` is the tree's expected value, on its first chunk."""
    by_length: dict[int, list] = {}
    base = 0.0
    for v, path, weight in merged_paths(left, right, feature, cut, cover, value):
        base += scale * v * weight / cover[0]
        by_length.setdefault(len(path), []).append((scale * v, [(f, *e) for f, e in path.items()]))
    out = []
    for length, paths in by_length.items():
        for k in range(0, len(paths), max(1, CHUNK // max(length, 1))):
            part = paths[k:k + max(1, CHUNK // max(length, 1))]
            elements = np.array([e for _, e in part], np.float64).reshape(len(part), length, 4)
            out.append({"tree": tree, "length": length, "paths": len(part), "base": 0.0,
                        "value": np.array([v for v, _ in part]).tobytes(), "feature": elements[:, :, 0].astype(np.int32).tobytes(),
                        **{c: elements[:, :, j].tobytes() for j, c in ((1, "share"), (2, "low"), (3, "high"))}})
    out[0]["base"] = float(base)
    return out


def _pack_tree(kind: str):
    def go(key: tuple[pa.Scalar, ...], nodes: pa.Table) -> pa.Table:
        nodes = nodes.sort_by("id")
        stats = nodes.column("impurityStats").to_pylist()
        split = nodes.column("leftCategoriesOrThreshold").to_pylist()
        if kind == "boosted":
            cover, value = np.array([s[0] for s in stats]), np.asarray(nodes.column("prediction"))
        else:
            cover = np.array([sum(s) for s in stats])
            value = np.array([s[1] / sum(s) if len(s) > 1 and sum(s) > 0 else 0.0 for s in stats])
        if (np.asarray(nodes.column("numCategories")) >= 0).any():
            raise ValueError("paths hold splits on numbers only")
        rows = pack(key[0].as_py(), nodes.column("scale")[0].as_py(), np.asarray(nodes.column("leftChild")), np.asarray(nodes.column("rightChild")),
                    np.asarray(nodes.column("featureIndex")), np.array([s[0] if s else 0.0 for s in split]), cover, value)
        kinds = [("tree", pa.int32()), ("length", pa.int32()), ("paths", pa.int32()), ("base", pa.float64()),
                 *((c, pa.binary()) for c in ("value", "feature", "share", "low", "high"))]
        return pa.table({c: pa.array([r[c] for r in rows], t) for c, t in kinds})
    return go


def packed(path: str, kind: str, scale: list[float], spark) -> DataFrame:
    """The packed paths of a saved ensemble: one row per chunk, stored."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    nodes = spark.read.parquet(os.path.join(path, "data"))
    tree = F.col("treeID") if "treeID" in nodes.columns else F.lit(0)
    nodes = nodes.select(tree.alias("tree"), "nodeData.id", "nodeData.prediction", "nodeData.impurityStats", "nodeData.leftChild",
                         "nodeData.rightChild", "nodeData.split.featureIndex", "nodeData.split.leftCategoriesOrThreshold", "nodeData.split.numCategories")
    scales = spark.createDataFrame(list(enumerate(map(float, scale))), "tree int, scale double")
    return materialize(nodes.join(scales, "tree").groupBy("tree").applyInArrow(_pack_tree(kind), _CHUNK), "paths")


def _arrays(chunk: dict):
    shape = chunk["paths"], chunk["length"]
    return (np.frombuffer(chunk["value"]), np.frombuffer(chunk["feature"], np.int32).reshape(shape),
            *(np.frombuffer(chunk[c]).reshape(shape) for c in ("share", "low", "high")))


def add_chunk(phi: np.ndarray, x: np.ndarray, chunk: dict) -> None:
    """Add a chunk's Shapley values for every row of x to phi."""
    value, feature, share, low, high = _arrays(chunk)
    paths, length = feature.shape
    if not length:
        return
    node, weight = np.polynomial.legendre.leggauss((length + 1) // 2)
    node, weight = (node + 1) / 2, weight / 2
    by_feature = np.argsort(feature, axis=None, kind="stable")
    used, first = np.unique(feature.reshape(-1)[by_feature], return_index=True)
    step = max(1, CELLS // feature.size)
    for k in range(0, len(x), step):
        own = x[k:k + step][:, feature]
        known = ((own > low) & (own <= high)).astype(float)
        rest = np.zeros_like(known)
        for t, w in zip(node, weight):
            factor = t * known + (1 - t) * share
            # A factor is zero only where o = z = 0, and there phi is zero whatever the rest.
            rest += w * (factor.prod(2, keepdims=True) / np.where(factor > 0, factor, np.inf))
        each = (value[:, None] * (known - share) * rest).reshape(len(own), -1)[:, by_feature]
        phi[k:k + step, used] += np.add.reduceat(each, first, axis=1)


def _explain_rows(chunks: list[dict], names: list[str], key: str):
    def go(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                part = batch.slice(k, ROWS)
                x = np.asarray(part.column("x").flatten(), np.float64).reshape(part.num_rows, -1)
                phi = np.zeros_like(x)
                for chunk in chunks:
                    add_chunk(phi, x, chunk)
                yield _long(part.column(key), x, phi, names, key)
    return go


def _long(keys, x: np.ndarray, phi: np.ndarray, names: list[str], key: str) -> pa.RecordBatch:
    n, d = x.shape
    return pa.RecordBatch.from_arrays(
        [keys.take(pa.array(np.repeat(np.arange(n), d))), pa.array(np.tile(np.arange(d, dtype=np.int32), n)),
         pa.array(names, pa.string()).take(pa.array(np.tile(np.arange(d), n))), pa.array(x.reshape(-1)), pa.array(phi.reshape(-1))],
        names=[key, "feature_idx", "feature", "value", "shap"])


def _as_blocks(key: str):
    """Blocks of rows, named by task and place, so that a rerun names them alike."""
    def go(batches):
        from pyspark import TaskContext
        place = 0
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                part = batch.slice(k, ROWS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([place], pa.int64()),
                     pa.array([part.column(key).to_pylist()], pa.list_(pa.int64())),
                     pa.array([np.asarray(part.column("x").flatten(), np.float64).tobytes()], pa.binary())], names=["task", "place", "keys", "x"])
                place += 1
    return go


def _partial(width: int):
    """Values of some blocks under one group of chunks."""
    def go(key: tuple[pa.Scalar, ...], blocks: pa.Table, chunks: pa.Table) -> pa.Table:
        found = []
        rows = chunks.to_pylist()
        for raw in blocks.column("x").to_pylist():
            x = np.frombuffer(raw).reshape(-1, width)
            phi = np.zeros_like(x)
            for chunk in rows:
                add_chunk(phi, x, chunk)
            found.append(phi.tobytes())
        return pa.table({"task": blocks.column("task"), "place": blocks.column("place"), "phi": pa.array(found, pa.binary())})
    return go


def _whole(width: int, names: list[str], key: str):
    """The long rows of a block from its sums under all groups."""
    def go(group: tuple[pa.Scalar, ...], sums: pa.Table, block: pa.Table) -> pa.Table:
        x = np.frombuffer(block.column("x")[0].as_py()).reshape(-1, width)
        phi = np.zeros_like(x)
        for raw in sums.sort_by("part").column("phi").to_pylist():
            phi += np.frombuffer(raw).reshape(-1, width)
        return pa.Table.from_batches([_long(pa.array(block.column("keys")[0].as_py(), pa.int64()), x, phi, names, key)])
    return go


def explain(rows: DataFrame, chunks: DataFrame, names: list[str], key: str, ship_bytes: int | None = None) -> tuple[DataFrame, float]:
    """``(key, feature_idx, feature, value, shap)`` for rows (key, x), and the ensemble's base value."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    size = F.length("value") + F.length("feature") + 3 * F.length("share")
    of = chunks.agg(F.sum(size).alias("bytes"), F.sum("base").alias("base")).first()
    schema = f"{key} long, feature_idx int, feature string, value double, shap double"
    if of["bytes"] <= (SHIP_BYTES if ship_bytes is None else ship_bytes):
        return rows.mapInArrow(_explain_rows([r.asDict() for r in chunks.orderBy("tree", "length").collect()], names, key), schema), of["base"]
    groups = -(-of["bytes"] // GROUP_BYTES)
    blocks = materialize(rows.mapInArrow(_as_blocks(key), "task int, place long, keys array<long>, x binary"), "blocks")
    many = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("batch", F.floor(F.col("place") / BLOCKS))
    batches = blocks.select(F.col("task").alias("of_task"), F.floor(F.col("place") / BLOCKS).alias("of_batch")).distinct()
    dealt = chunks.withColumn("of_part", F.pmod(F.xxhash64("tree", "length", "value"), F.lit(groups)).cast("int"))
    # Every batch of blocks gets every group of chunks: rows x chunks, in bounded pieces.
    sent = dealt.join(batches.withColumn("of_part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))), "of_part")
    part = (many.drop("keys").groupBy("task", "batch", "part").cogroup(sent.groupBy("of_task", "of_batch", "of_part")).applyInArrow(
        lambda group, left, right: _with_part(group, _partial(len(names))(group, left, right)), "task int, place long, phi binary, part int"))
    part = materialize(part, "partial")
    return (part.groupBy("task", "place").cogroup(blocks.groupBy("task", "place"))
            .applyInArrow(_whole(len(names), names, key), schema)), of["base"]


def _with_part(group: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    return table.append_column("part", pa.array([group[2].as_py()] * table.num_rows, pa.int32()))
