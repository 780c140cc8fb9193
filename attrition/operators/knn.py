"""Exact k-nearest-neighbour search over a two-level space partition with pivot distances.

Candidates are collapsed to distinct points and dealt to the cells of a kd-tree whose splits
come from a bounded sample; every cell gets the bounding box of its own points over all
coordinates. A query point then

1. searches its own cell, and its neighbours in the tree as far as they are needed to hold enough
   points, which bounds its k-th distance, and
2. searches every other cell whose box is no farther than that bound.

A cell that is skipped cannot hold a nearer point, so the result is exact. At most ``CELLS``
boxes are known to the tasks; ``GROUP`` neighbours in the tree share a box of their own, as do as many
of these, and only what such a box within the bound holds is compared with a query. Query points are dealt by their
number, not by the size of their file. Cells are searched in pairs of (cell, block of queries) of bounded
size. Inside, the cell's points are cut again into leaves of ``LEAF`` points with boxes of their
own, however many these are, and a table holds every point's distances to ``PIVOTS`` far-apart
points of the cell: by the triangle inequality a point whose pivot distance differs from the
query's by more than the bound is not looked at. Only the k nearest of each cell leave a task, and
the number of distances that were computed.

Copies: a point in many candidate rows is one entry with its smallest keys (cut to those per
salted subgroup first); a point in many query rows is searched once and its result goes back to
the rows over a join, salted where they are more than ``ROWS``. Neighbours carry their vector and columns, so nothing is joined on a
neighbour's key.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attrition.session import materialize

#: Points a cell should hold, and the most cells (boxes that every task knows).
CELL = 256
CELLS = 1 << 14
#: Cells, or boxes of cells, that share a box, and the most boxes that are compared with every query.
GROUP = 8
TOP = 64
#: Points a leaf of a cell should hold, and the pivots of a cell.
LEAF = 8
PIVOTS = 16
#: Numbers held at once in comparisons of queries with boxes or points.
HELD = 1 << 21
#: Rows of (query, cell) that leave a task at once, each with the query's vector.
BATCH = 1 << 14
#: Points (at most) that the splits are chosen from.
SAMPLE = 20_000
#: Query points searched in a leaf by one task, and those that a task finds the cells of.
QUERIES = 4096
#: Rows of a query point that get its result in one task.
ROWS = 4096
_SALTS = 16


def build_tree(sample: np.ndarray, leaves: int) -> list[tuple]:
    """Nodes (dimension, threshold, left, right); a leaf is (-1, leaf number, 0, 0)."""
    nodes: list[tuple] = []
    numbers = iter(range(1 << 30))

    def grow(points: np.ndarray, share: int) -> int:
        at = len(nodes)
        nodes.append(())
        widths = points.std(axis=0) if len(points) > 1 else np.zeros(points.shape[1])
        dim = int(widths.argmax()) if share > 1 and len(widths) else -1
        if dim < 0 or widths[dim] == 0:
            nodes[at] = (-1, next(numbers), 0, 0)
            return at
        cut = float(np.median(points[:, dim]))
        low = points[:, dim] < cut
        if not low.any():  # the median is the least value: cut just above it
            cut = float(points[points[:, dim] > cut, dim].min())
            low = points[:, dim] < cut
        left = grow(points[low], share // 2)
        right = grow(points[~low], share - share // 2)
        nodes[at] = (dim, cut, left, right)
        return at

    grow(sample, leaves)
    return nodes


def find_leaves(nodes: list[tuple], x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), np.int32)
    stack = [(0, np.arange(len(x)))]
    while stack:
        at, rows = stack.pop()
        dim, cut, left, right = nodes[at]
        if dim < 0:
            out[rows] = cut
            continue
        low = x[rows, dim] < cut
        stack += [(left, rows[low]), (right, rows[~low])]
    return out


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _box_distance(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each point to each box, in slices of bounded size."""
    out = np.empty((len(x), len(low)))
    step = max(1, HELD // max(1, low.size))
    for k in range(0, len(x), step):
        gap = np.maximum(np.maximum(low[None] - x[k:k + step, None], x[k:k + step, None] - high[None]), 0)
        out[k:k + step] = np.square(gap).sum(2)
    return out


def _slack(square: np.ndarray) -> np.ndarray:
    """A squared bound with room for rounding."""
    return square * (1 + 1e-9) + 1e-12


class _Boxes:
    """The cells in tree order: their keys, their boxes and those of groups of neighbours."""

    def __init__(self, size: np.ndarray, low: np.ndarray, high: np.ndarray, keep: int):
        self.low, self.high = low, high
        held = np.r_[0, np.cumsum(size)]
        # From each cell on (at the end of the order: before it), the cells that hold ``keep`` keys.
        at = np.arange(len(size))
        self.end = np.minimum(np.searchsorted(held, held[at] + keep), len(size))
        self.begin = np.clip(np.searchsorted(held, held[self.end] - keep, side="right") - 1, 0, at)
        self.levels = [(low, high)]
        while len(self.levels[-1][0]) > TOP:
            at = np.arange(0, len(self.levels[-1][0]), GROUP)
            self.levels.append(tuple(f.reduceat(v, at) for f, v in zip((np.minimum, np.maximum), self.levels[-1])))

    def start(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, cell) of the first cells, given the cell that each query lies in."""
        many = self.end[own] - self.begin[own]
        return np.repeat(np.arange(len(own)), many), _counted(self.begin[own], many)

    def reached(self, x: np.ndarray, own: np.ndarray, radius: np.ndarray):
        """(query, cell) of the other cells within the squared radius, in parts of bounded size."""
        limit = _slack(radius)
        top = len(self.levels) - 1
        for row, cell in self._within(x, limit, top, *np.nonzero(_box_distance(x, *self.levels[top]) <= limit[:, None])):
            other = (cell < self.begin[own[row]]) | (cell >= self.end[own[row]])
            yield row[other], cell[other]

    def _within(self, x: np.ndarray, limit: np.ndarray, level: int, row: np.ndarray, box: np.ndarray):
        if not level:
            yield row, box
            return
        low, high = self.levels[level - 1]
        step = max(1, HELD // (4 * GROUP * max(1, x.shape[1])))
        for k in range(0, len(row), step):
            first = box[k:k + step] * GROUP
            many = np.minimum(len(low) - first, GROUP)
            query, inner = np.repeat(row[k:k + step], many), _counted(first, many)
            gap = np.maximum(np.maximum(low[inner] - x[query], x[query] - high[inner]), 0)
            near = np.square(gap).sum(1) <= limit[query]
            yield from self._within(x, limit, level - 1, query[near], inner[near])


def _counted(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """``many`` numbers from each of ``first`` on."""
    return np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())


class _Cell:
    """A cell's points in leaves, their boxes, and the distances to its pivots."""

    def __init__(self, c: np.ndarray):
        leaf = find_leaves(build_tree(c, -(-len(c) // LEAF)), c)
        self.order = np.argsort(leaf, kind="stable")
        self.c = c[self.order]
        _, first = np.unique(leaf[self.order], return_index=True)
        self.first, self.size = first, np.diff(np.r_[first, len(c)])
        self.low, self.high = np.minimum.reduceat(self.c, first), np.maximum.reduceat(self.c, first)
        # Each pivot is the point farthest from those before it.
        pivots = [0]
        nearest = np.square(self.c - self.c[0]).sum(1)
        while len(pivots) < min(PIVOTS, len(c)) and nearest.max() > 0:
            pivots.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, np.square(self.c - self.c[pivots[-1]]).sum(1))
        self.pivots = self.c[pivots]
        self.table = self._to_pivots(self.c)

    def _to_pivots(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.stack([np.square(x - p).sum(1) for p in self.pivots], 1))

    def _pairs(self, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, point) of the chosen (query, leaf) pairs."""
        row, leaf = np.nonzero(leaves)
        many = self.size[leaf]
        within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        return np.repeat(row, many), np.repeat(self.first[leaf], many) + within

    def _square(self, q: np.ndarray, row: np.ndarray, point: np.ndarray) -> np.ndarray:
        out = np.zeros(len(row))
        for d in range(q.shape[1]):  # summed in coordinate order
            out += np.square(q[row, d] - self.c[point, d])
        return out

    def near(self, q: np.ndarray, radius: np.ndarray, keep: int):
        """Pairs (query, point, squared distance) that may be among the ``keep`` nearest within the
        squared radius, and how many distances were computed."""
        far = _box_distance(q, self.low, self.high)
        order = np.argsort(far, axis=1, kind="stable")
        before = np.empty(far.shape, np.int64)
        np.put_along_axis(before, order, np.cumsum(self.size[order], axis=1) - self.size[order], axis=1)
        to_pivots, limit = self._to_pivots(q), radius.copy()
        row, point, square = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        computed, low = 0, 0
        # The nearest leaves first; what they hold bounds the rest.
        for high in (keep, 4 * keep, 16 * keep, len(self.c) + 1):
            more, other = self._pairs((before >= low) & (before < high) & (far <= _slack(limit)[:, None]))
            reach = np.sqrt(_slack(limit))
            for k in range(len(self.pivots)):
                open_ = np.abs(to_pivots[more, k] - self.table[other, k]) <= reach[more]
                more, other = more[open_], other[open_]
            computed += len(more)
            row, point = np.r_[row, more], np.r_[point, other]
            square = np.r_[square, self._square(q, more, other)]
            by = np.lexsort((square, row))
            by = by[np.arange(len(by)) - np.searchsorted(row[by], row[by]) == keep - 1]
            limit[row[by]] = np.minimum(limit[row[by]], square[by])
            low = high
        inside = square <= _slack(limit)[row]
        return row[inside], self.order[point[inside]], square[inside], computed


def _search(keep: int):
    def search(key: tuple[pa.Scalar, ...], queries: pa.Table, points: pa.Table) -> pa.Table:
        """The ``keep`` nearest (by distance, then key) of a cell's points for each query; a last row
        without a query has the number of distances computed."""
        q, c = _matrix(queries.column("x")), _matrix(points.column("x"))
        h1, h2 = (np.asarray(queries.column(n)) for n in ("h1", "h2"))
        radius = np.asarray(queries.column("radius").combine_chunks().fill_null(float("inf")), np.float64)
        lists = points.column("ids").combine_chunks()
        bound = np.asarray(lists.offsets) - lists.offsets[0].as_py()
        ids = np.asarray(lists.flatten().field("id")) if len(lists) else np.empty(0, np.int64)
        found: list[tuple] = []
        computed = 0
        cell = _Cell(c) if len(c) else None
        step = max(1, min(256, HELD // max(1, len(c))))
        for k in range(0, len(q) if len(c) else 0, step):
            row, point, square, n = cell.near(q[k:k + step], radius[k:k + step], keep)
            computed += n
            many = bound[point + 1] - bound[point]
            entry = np.repeat(bound[point] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            row, point, square = (np.repeat(v, many) for v in (row, point, square))
            order = np.lexsort((ids[entry], square, row))
            order = order[np.arange(len(order)) - np.searchsorted(row[order], row[order]) < keep]
            found.append((row[order] + k, entry[order], point[order], square[order]))
        row, entry, point = (np.concatenate([f[j] for f in found]).astype(np.int64) if found else np.empty(0, np.int64) for j in range(3))
        square = np.concatenate([f[3] for f in found]) if found else np.empty(0)
        out = pa.table({"h1": pa.array(h1[row], pa.int64()), "h2": pa.array(h2[row], pa.int64()),
                        "d2": pa.array(square, pa.float64()),
                        "neighbour": lists.flatten().take(pa.array(entry)),
                        "vec": points.column("x").combine_chunks().take(pa.array(point))})
        count = pa.table({"h1": pa.nulls(1, pa.int64()), "h2": pa.nulls(1, pa.int64()), "d2": pa.array([float(computed)]),
                          "neighbour": pa.nulls(1, out.schema.field("neighbour").type), "vec": pa.nulls(1, out.schema.field("vec").type)})
        return pa.concat_tables([out, count])
    return search


def _hashes(x: Column) -> list[Column]:
    return [F.xxhash64(x).alias("h1"), F.xxhash64(F.lit(1), x).alias("h2")]


def _distinct_points(rows: DataFrame, keep: int) -> DataFrame:
    """Distinct points (h1, h2, x) with their ``keep`` smallest ``id`` structs. Copies of a point
    are first cut to ``keep`` per salted subgroup, so no group is collected whole."""
    w = Window.partitionBy("h1", "h2", "_salt").orderBy("id.id")
    return (rows.withColumn("_salt", F.pmod(F.xxhash64("id.id"), F.lit(_SALTS)))
            .withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= keep)
            .groupBy("h1", "h2").agg(F.slice(F.array_sort(F.collect_list("id")), 1, keep).alias("ids"),
                                     F.any_value("x").alias("x")))


def knn(queries: DataFrame, candidates: DataFrame, k: int = 5, key: str = "CustomerId",
        features: str = "features", exclude_self: bool = True,
        carry: list[str] | None = None, visited: list | None = None) -> DataFrame:
    """``(query, rank, neighbour, distance, neighbour_vec, *carry)`` for the k
    nearest candidates of every query row (fewer only if there are fewer
    candidates). Ties at equal distance go to the smaller key. ``visited`` is given the share of
    all (query point, candidate point) pairs whose distance was computed."""
    # Executors need numpy and pyarrow only, not this package on their path.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    carry = list(carry or [])
    keep = k + 1 if exclude_self else k
    x = vector_to_array(F.col(features))
    ident = F.struct(F.col(key).cast("long").alias("id"), *carry)
    points = materialize(_distinct_points(candidates.select(x.alias("x"), ident.alias("id"))
                                          .select("x", "id", *_hashes(F.col("x"))), keep), "knn-points")
    q_rows = queries.select(F.col(key).alias("query"), x.alias("x")).select("query", "x", *_hashes(F.col("x")))
    asked = materialize(q_rows.groupBy("h1", "h2").agg(F.any_value("x").alias("x"), F.count("*").alias("many")), "knn-queries")
    n, parts = points.count(), max(1, -(-asked.count() // QUERIES))
    sample = points.orderBy(F.xxhash64(F.lit(3), "h1")).limit(SAMPLE).select("x").toArrow().column("x")
    nodes = build_tree(_matrix(sample) if n else np.zeros((1, 1)), max(1, min(CELLS, -(-n // CELL))))
    width = _matrix(sample).shape[1] if n else 0

    def place(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(find_leaves(nodes, _matrix(batch.column("x"))), pa.int32())],
                names=[*batch.schema.names, "leaf"])

    ids_type = dict(points.dtypes)["ids"]
    held = materialize(points.select("ids", "x").mapInArrow(place, f"ids {ids_type}, x array<double>, leaf int"), "knn-leaves")
    boxes = held.groupBy("leaf").agg(
        F.sum(F.size("ids")).alias("n"), *[F.min(F.get("x", F.lit(d))).alias(f"l{d}") for d in range(width)],
        *[F.max(F.get("x", F.lit(d))).alias(f"u{d}") for d in range(width)]).orderBy("leaf").toPandas()
    leaf, size = boxes["leaf"].to_numpy(np.int32), boxes["n"].to_numpy(np.int64)
    low = boxes[[f"l{d}" for d in range(width)]].to_numpy(float)
    high = boxes[[f"u{d}" for d in range(width)]].to_numpy(float)

    cells = _Boxes(size, low, high, keep)

    def visits(first: bool):
        """(query, leaf): in the first round the leaves around the query that hold ``keep`` keys, then
        the others within the bound."""
        def go(batches):
            step = max(1, HELD // (8 * max(1, len(cells.levels[-1][0]))))
            for whole in batches:
                for k in range(0, whole.num_rows if len(leaf) else 0, step):
                    batch = whole.slice(k, step)
                    x = _matrix(batch.column("x"))
                    own = np.minimum(np.searchsorted(leaf, find_leaves(nodes, x)), len(leaf) - 1)
                    radius = np.asarray(batch.column("radius").fill_null(float("inf")), np.float64)
                    for row, at in [cells.start(own)] if first else cells.reached(x, own, radius):
                        for a in range(0, len(row), BATCH):
                            took = pa.array(row[a:a + BATCH])
                            yield pa.RecordBatch.from_arrays(
                                [*(batch.column(c).take(took) for c in ("h1", "h2", "x", "radius")), pa.array(leaf[at[a:a + BATCH]], pa.int32())],
                                names=["h1", "h2", "x", "radius", "leaf"])
        return go

    shape = "h1 long, h2 long, x array<double>, radius double, leaf int"
    entry = ids_type[len("array<"):-1]
    found_type = f"h1 long, h2 long, d2 double, neighbour {entry}, vec array<double>"

    def search(frame: DataFrame, name: str) -> DataFrame:
        frame = materialize(frame, f"{name}-visits")
        blocks = frame.groupBy("leaf").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("blocks"))
        one = (frame.join(blocks, "leaf")
               .withColumn("block", F.pmod(F.xxhash64("h1", "h2"), F.col("blocks")).cast("int")).drop("blocks"))
        two = held.join(blocks, "leaf").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
        found = materialize(one.groupBy("leaf", "block").cogroup(two.groupBy("leaf", "block"))
                            .applyInArrow(_search(keep), found_type), name)
        if visited is not None:
            computed.append(found.where("h1 is null").agg(F.sum("d2")).first()[0] or 0.0)
        return found.where("h1 is not null")

    computed: list[float] = []
    dealt = lambda frame: frame.select("h1", "h2", "x", "radius").repartition(parts, "h1", "h2")
    start = search(dealt(asked.withColumn("radius", F.lit(None).cast("double"))).mapInArrow(visits(True), shape), "knn-first")
    w = Window.partitionBy("h1", "h2").orderBy("d2", "neighbour.id")
    bound = (start.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == keep)
             .select("h1", "h2", F.col("d2").alias("radius")))
    wide = asked.join(bound, ["h1", "h2"], "left")
    rest = search(dealt(wide).mapInArrow(visits(False), shape), "knn-rest")
    if visited is not None:
        visited.append(sum(computed) / max(1, asked.count() * n))
    per_point = (start.unionByName(rest).withColumn("_r", F.row_number().over(w))
                 .where(F.col("_r") <= keep).drop("_r"))
    # Back to the rows: the result of a point with many rows is repeated over salts, its rows are
    # spread over them.
    heavy = materialize(asked.where(F.col("many") > ROWS).select("h1", "h2", F.ceil(F.col("many") / ROWS).cast("int").alias("salts")),
                        "knn-heavy")
    salts = F.coalesce("salts", F.lit(1))
    salted = per_point.join(heavy, ["h1", "h2"], "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    joined = (q_rows.join(heavy, ["h1", "h2"], "left")
              .select("query", "h1", "h2", F.pmod(F.xxhash64("query"), salts).cast("int").alias("_salt"))
              .join(salted, ["h1", "h2", "_salt"]))
    if exclude_self:
        joined = joined.where(F.col("query") != F.col("neighbour.id"))
    wq = Window.partitionBy("query").orderBy("d2", "neighbour.id")
    return (joined.withColumn("rank", F.row_number().over(wq)).where(F.col("rank") <= k)
            .select("query", "rank", F.col("neighbour.id").alias("neighbour"), F.sqrt("d2").alias("distance"),
                    array_to_vector("vec").alias("neighbour_vec"), *[F.col(f"neighbour.{c}").alias(c) for c in carry]))
