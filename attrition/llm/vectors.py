"""Embedding near-duplicates: spherical k-means cells, blocked cosine products, one kept per group.

Centroids are fitted on a bounded sample of distinct vectors; those that lie too close together to
part linked vectors are merged, so a dense cluster is one cell. A vector is at home in the cell of
its nearest centroid and visits every lower cell in which a vector linked with it can be at home,
so no pair is lost: two linked unit vectors are at most ``NEAR`` apart, so if one of them is nearer
to centroid c than to d, the other has at most ``NEAR * |d - c|`` more in common with d than with
c. A pair is counted in the lower of its two homes. The vectors at home in a cell and its visitors
are cut into blocks, and each pair of blocks of which one is at home is one task of bounded size
that multiplies the two blocks and returns link counts and a spanning star per local group, never
the pairs. Equal vectors are collapsed first and weigh as many as they are.

Only vectors of equal label and equal length are compared. Vectors that are null, zero or hold
null or non-finite components, and rows with a null label or null vec_id, link with nothing and
are their own component. Rows that repeat a vec_id count as vectors of their own in n_links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import documents, materialize
from attrition.llm.components import components

THRESHOLD = 0.98
#: Vectors (at most) on which the centroids are fitted, and Lloyd rounds.
SAMPLE = 20_000
ROUNDS = 8
#: Distance of two unit vectors whose cosine is THRESHOLD, with room for rounding.
NEAR = (2 - 2 * THRESHOLD) ** 0.5 + 1e-6
#: Centroids under this angle are merged: the vectors around them visit both cells anyway.
MERGED = 2 * np.arccos(THRESHOLD)
#: Distinct vectors of a label that a cell should hold, and the most cells.
CELL = 512
MOST_CELLS = 1024
BLOCK = 1024


def _matrix(column) -> np.ndarray:
    """Rows of an Arrow list column of equal lengths as float64."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _unit(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(axis=1, keepdims=True)
    x = x / np.where(scale > 0, scale, 1)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def _fitted(x: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(x), width))
    n = min(width, x.shape[1])
    out[:, :n] = x[:, :n]
    return out


def fit_centroids(sample: list, cells: int, seed: int = 3) -> np.ndarray:
    """Spherical k-means: unit centroids of the sample under cosine, by Lloyd rounds."""
    width = int(np.median([len(v) for v in sample]))
    x = _unit(np.vstack([_fitted(np.asarray(v, np.float64)[None], width) for v in sample]))
    rng = np.random.default_rng(seed)
    centroids = x[rng.permutation(len(x))[:min(cells, len(x))]].copy()
    for _ in range(ROUNDS):
        near = (x @ centroids.T).argmax(1)
        total = np.zeros_like(centroids)
        np.add.at(total, near, x)
        filled = np.linalg.norm(total, axis=1) > 1e-12
        centroids[filled] = _unit(total[filled])
    return _apart(centroids)


def _apart(centroids: np.ndarray) -> np.ndarray:
    """The centroids without those that lie closer than MERGED to one before them."""
    kept: list[int] = []
    for i, likeness in enumerate(centroids @ centroids.T):
        if not (likeness[kept] > np.cos(MERGED)).any():
            kept.append(i)
    return centroids[kept]


def places(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Home cell of each row, and the lower cells it visits; rows are unit vectors or parts of them."""
    gap = np.sqrt(np.maximum(2 - 2 * centroids @ centroids.T, 0))
    home, visits = np.empty(len(x), np.int32), []
    for k in range(0, len(x), BLOCK):
        likeness = x[k:k + BLOCK] @ centroids.T
        own = likeness.argmax(1)
        home[k:k + BLOCK] = own
        open_ = likeness.max(1, keepdims=True) - likeness <= NEAR * gap[own]
        open_ &= np.arange(len(centroids)) < own[:, None]
        visits += [np.flatnonzero(row).astype(np.int32) for row in open_]
    return home, visits


def _cells(unique: DataFrame, centroids: np.ndarray) -> DataFrame:
    def assign(batches):
        for batch in batches:
            vectors = batch.column("embedding")
            lengths = np.diff(np.asarray(vectors.offsets))
            home = np.zeros(batch.num_rows, np.int32)
            visits: list = [None] * batch.num_rows
            flat = np.asarray(vectors.flatten(), np.float64)
            starts = np.r_[0, np.cumsum(lengths)]
            for n in np.unique(lengths):
                rows = np.flatnonzero(lengths == n)
                x = flat[starts[rows][:, None] + np.arange(n)]
                # Cutting components off brings vectors closer together, never apart.
                home[rows], found = places(_fitted(_unit(x), centroids.shape[1]), centroids)
                for row, cells in zip(rows, found):
                    visits[row] = cells
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(home), pa.array(visits, pa.list_(pa.int32()))],
                names=[*batch.schema.names, "home", "visits"])

    return unique.mapInArrow(assign, "rep long, label string, width int, many long, embedding array<float>, home int, visits array<int>"
                             .replace("array<float>", dict(unique.dtypes)["embedding"]))


def _block_links(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Links of one pair of blocks: for each vector the rows it links with and its local root."""
    one, two = (k.as_py() for k in key[3:])
    rep = np.asarray(table.column("rep"))
    many = np.asarray(table.column("many"))
    block = np.asarray(table.column("block"))
    x = _unit(_matrix(table.column("embedding")))
    left = np.flatnonzero(block == one)
    right = left if one == two else np.flatnonzero(block == two)
    links = np.zeros(len(rep), np.int64)
    root = np.arange(len(rep))
    p, q = np.nonzero(x[left] @ x[right].T >= THRESHOLD)
    p, q = left[p], right[q]
    p, q = (p[p < q], q[p < q]) if one == two else (p, q)
    if len(p):
        np.add.at(links, p, many[q])
        np.add.at(links, q, many[p])
        order = np.argsort(rep, kind="stable")
        rank = np.empty(len(rep), np.int64)
        rank[order] = np.arange(len(rep))
        least = rank.copy()
        while True:
            low = np.minimum(least[p], least[q])
            new = least.copy()
            np.minimum.at(new, p, low)
            np.minimum.at(new, q, low)
            new = np.minimum(new, new[order[new]])
            if (new == least).all():
                break
            least = new
        root = order[least]
    told = np.flatnonzero((links > 0) | (root != np.arange(len(rep))))
    return pa.table({"rep": rep[told], "links": links[told], "root": rep[root[told]]})


def link(vectors: DataFrame) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    narrow = documents(vectors, "vec_id", "embedding", "label")
    e = F.col("embedding")
    bad = F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    valid = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & e.isNotNull()
             & ~F.coalesce(bad, F.lit(True)) & F.exists(e, lambda v: v != 0))
    marked = narrow.select(
        "vec_id", "embedding", F.when(F.coalesce(valid, F.lit(False)), F.col("label").cast("string")).alias("label"),
        F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2"))
    unique = materialize(
        marked.where("label is not null").groupBy("label", "h1", "h2")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("many"), F.any_value("embedding").alias("embedding")),
        "vectors")
    if unique.isEmpty():
        return narrow.select("vec_id", F.lit(0).cast("long").alias("n_links"),
                             F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    # Only vectors of one label and length are compared, so the largest of these groups sets the cells.
    largest = unique.groupBy("label", F.size("embedding")).count().agg(F.max("count")).first()[0]
    sample = unique.orderBy(F.xxhash64(F.lit(17), "rep")).limit(SAMPLE).select("embedding").collect()
    centroids = fit_centroids([r["embedding"] for r in sample],
                              min(MOST_CELLS, -(-largest // CELL)))
    placed = materialize(_cells(unique.select("rep", "label", F.size("embedding").alias("width"), "many", "embedding"),
                                centroids), "cells")
    # Blocks of those at home come first; those of visitors meet no visitors.
    spots = placed.select("*", F.col("home").alias("cell"), F.lit(False).alias("guest")).unionByName(
        placed.select("*", F.explode("visits").alias("cell"), F.lit(True).alias("guest"))).drop("home", "visits")
    cut = lambda guest: F.ceil(F.count_if(F.col("guest") == guest) / BLOCK).cast("int")
    blocks = spots.groupBy("label", "width", "cell").agg(cut(False).alias("own"), cut(True).alias("guests")).where("own > 0")
    share = F.xxhash64(F.lit(23), "rep")
    dealt = (spots.join(blocks, ["label", "width", "cell"])
             .withColumn("block", F.when(F.col("guest"), F.col("own") + F.pmod(share, F.col("guests")))
                         .otherwise(F.pmod(share, F.col("own"))).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("own") - 1 + F.when(F.col("guest"), 0).otherwise(F.col("guests")))))
             .withColumn("one", F.least("block", "other")).withColumn("two", F.greatest("block", "other")))
    found = materialize(dealt.select("label", "width", "cell", "one", "two", "block", "rep", "many", "embedding")
                        .groupBy("label", "width", "cell", "one", "two")
                        .applyInArrow(_block_links, "rep long, links long, root long"), "links")
    group = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    sums = (unique.select("rep", "label", "h1", "h2", (F.col("many") - 1).alias("copies"))
            .join(found.groupBy("rep").agg(F.sum("links").alias("links")), "rep", "left")
            .join(group, F.col("rep") == F.col("node"), "left")
            .select("label", "h1", "h2", (F.col("copies") + F.coalesce("links", F.lit(0))).alias("n_links"),
                    F.coalesce("component", "rep").alias("component_id")))
    return (marked.drop("embedding").join(sums, ["label", "h1", "h2"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))

