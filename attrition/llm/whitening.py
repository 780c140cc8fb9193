"""Embedding whitening: principal components by block Jacobi-Davidson over distributed products.

Entries become integers x = floor(64 * c) + 1000000. The covariance V of the distinct integer
vectors is never formed: one product V W is one pass over them, in which every task centres its
rows (n * x - S exactly in integers, then one division), multiplies them with the block W and
returns one sum. All wanted components share a pass. An outer step does Rayleigh-Ritz in the
subspace, locks the components whose residual is at the rounding level, and expands the subspace
by the corrections of the others: (I - QQ')(V - theta I)(I - QQ') t = -r, with Q the locked and
the current Ritz vectors, solved by a few steps of MINRES, each of them one product for all open
components together. At the end the residuals are taken anew from a product of their own, and the
search goes on unless all of them hold. The driver sees blocks of vectors of one dimension each,
never rows.

Distinct vectors are grouped by their integers with partial sums, so copies meet as one row, and
kept in blocks of rows.

Defined results: rows whose vector is null or holds null or non-finite entries are dropped. A
vector shorter than the longest kept one counts as filled up with zeros. Rows that share a vec_id
are rows of their own, and so are rows without one. Vectors of d entries have min(d, 16)
components. Components without variance (also: a single distinct vector) have null ``whitened``
and explained 0; ``identity_error`` is over the others, null if there are none. Among equal
eigenvalues any orthonormal basis may be returned, the same for all rows. ``deviation`` is null
where it does not fit in 64 bits. Integers are held within 2^40. An empty table gives no rows.
Other columns of the input are not read, so their names cannot clash; there is no text here that
could be long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import documents, materialize
from attrition.llm.pq import kept_vectors, rows_of

COMPONENTS = 16
SCALE = 64
SHIFT = 1_000_000
BOUND = 1 << 40
#: Rows of distinct vectors that one stored block holds.
BLOCK_ROWS = 2048
#: Residual, relative to the largest eigenvalue, at which a component is locked.
RESIDUAL = 2e-14
#: MINRES steps of a correction at most, and the drop of its residual that is enough.
INNER_STEPS = 5
INNER_DROP = 0.05
#: Subspace vectors at most, as a multiple of the components, before it is cut to its best ones.
SUBSPACE = 5
OUTER_STEPS = 300
#: Variance below this share of the largest is none.
NO_VARIANCE = 1e-12
#: Largest integer below which products and sums of 64-bit integers cannot wrap.
SAFE = 1 << 62


def _integers(batch, width: int) -> np.ndarray:
    x = np.floor(SCALE * rows_of(batch.column("embedding"), width))
    return np.clip(x, -BOUND, BOUND).astype(np.int64) + SHIFT


def _as_keys(width: int):
    """The integers of a vector as bytes, by which equal ones are grouped."""
    def change(batches):
        for batch in batches:
            x = _integers(batch, width)
            yield pa.RecordBatch.from_arrays([pa.array([row.tobytes() for row in x], pa.binary())], names=["x"])
    return change


def _as_blocks(width: int):
    """Blocks of BLOCK_ROWS distinct vectors with their number and exact sums."""
    def change(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                raw = batch.column("x").slice(start, BLOCK_ROWS).to_pylist()
                x = np.frombuffer(b"".join(raw), np.int64).reshape(len(raw), width)
                small = np.abs(x - SHIFT).max(initial=0) < 1 << 30
                block = (x - SHIFT).astype(np.int32 if small else np.int64).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.binary()), pa.array([len(raw)], pa.int64()), pa.array([x.sum(0).tolist()], pa.list_(pa.int64()))],
                    names=["block", "n", "sums"])
    return change


class Centred:
    """The fit list: products with its covariance, as passes over stored blocks."""

    def __init__(self, blocks: DataFrame, width: int):
        self.blocks, self.width = blocks, width
        self.n = blocks.agg(F.sum("n")).first()[0] or 0
        sums = blocks.select(F.posexplode("sums").alias("place", "s")).groupBy("place").agg(F.sum("s").alias("s")).collect()
        self.sums = np.zeros(width, np.int64)
        for r in sums:
            self.sums[r["place"]] = r["s"]

    def rows(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums)

    def total(self, of, rows: int, columns: int) -> np.ndarray:
        """Sum over all blocks of ``of(centred rows)``, a matrix of the given shape."""
        n, sums, width = self.n, self.sums, self.width
        names = [f"c{j}" for j in range(columns)]

        def add(batches):
            out = np.zeros((rows, columns))
            for batch in batches:
                for raw, m in zip(batch.column("block"), batch.column("n").to_pylist()):
                    raw = raw.as_buffer()
                    kind = np.int32 if raw.size == 4 * m * width else np.int64
                    x = np.frombuffer(raw, kind).reshape(m, width).astype(np.int64) + SHIFT
                    out += of(centred(x, n, sums))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(rows, dtype=np.int32)), *(pa.array(out[:, j]) for j in range(columns))],
                                             names=["place", *names])

        found = (self.blocks.select("block", "n").mapInArrow(add, ", ".join(["place int", *(f"{c} double" for c in names)]))
                 .groupBy("place").agg(*(F.sum(c).alias(c) for c in names)).collect())
        out = np.zeros((rows, columns))
        for r in found:
            out[r["place"]] = r[1:]
        return out

    def product(self, w: np.ndarray) -> np.ndarray:
        """V w for a block of vectors."""
        return self.total(lambda x: x.T @ (x @ w), self.width, w.shape[1]) / self.n

    def trace(self) -> float:
        return float(self.total(lambda x: np.array([[(x * x).sum()]]), 1, 1)[0, 0] / self.n)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n, the subtraction in integers where they hold it."""
    if n * int(np.abs(x).max(initial=0)) < SAFE:
        return (n * x - sums) / n
    return x - sums / n


def _orthonormal(w: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns of w add to ``against``; twice, for rounding."""
    size = np.linalg.norm(w, axis=0)
    w = w[:, size > 0] / size[size > 0]
    for _ in range(2):
        w = w - against @ (against.T @ w)
        if not w.shape[1]:
            return w
        u, s, _ = np.linalg.svd(w, full_matrices=False)
        w = u[:, s > 1e-9]
    return w


def corrections(product, theta: np.ndarray, residual: np.ndarray, held: np.ndarray,
                steps: int = INNER_STEPS, drop: float = INNER_DROP) -> np.ndarray:
    """MINRES for all columns at once: (I-QQ')(V - theta)(I-QQ') t = -residual, Q = held."""
    project = lambda v: v - held @ (held.T @ v)
    r = project(-residual)
    beta = np.linalg.norm(r, axis=0)
    first, rest, beta_before = beta, beta, np.zeros_like(beta)
    v_before, v = np.zeros_like(r), r / np.maximum(beta, 1e-300)
    t, d_before, d = np.zeros_like(r), np.zeros_like(r), np.zeros_like(r)
    cos, sin, bar, far = -np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    for _ in range(steps):
        going = rest > drop * first
        if not going.any():
            break
        w = project(product(v) - theta * v) - beta_before * v_before
        alpha = (v * w).sum(0)
        w = w - alpha * v
        beta_before = np.linalg.norm(w, axis=0)
        # The last two rotations meet the new column of the tridiagonal matrix; a new one ends it.
        farther, near, own = far, cos * bar + sin * alpha, sin * bar - cos * alpha
        far, bar = sin * beta_before, -cos * beta_before
        size = np.maximum(np.hypot(own, beta_before), 1e-300)
        cos, sin = own / size, beta_before / size
        d_before, d = d, (v - farther * d_before - near * d) / size
        t = t + np.where(going, cos * rest, 0) * d
        rest = np.where(going, sin * rest, rest)
        v_before, v = v, w / np.maximum(beta_before, 1e-300)
    return project(t)


def eigenpairs(product, width: int, count: int, level: float = RESIDUAL, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their unit eigenvectors as columns, to
    residuals of ``level`` times the largest eigenvalue."""
    rng = np.random.default_rng(seed)
    basis = _orthonormal(rng.standard_normal((width, min(width, 2 * count))), np.zeros((width, 0)))
    image = product(basis)
    most = min(width, SUBSPACE * count)
    for _ in range(OUTER_STEPS):
        small = basis.T @ image
        theta, u = np.linalg.eigh((small + small.T) / 2)
        theta, u = theta[::-1], u[:, ::-1]
        ritz, at = basis @ u[:, :count], image @ u[:, :count]
        scale = max(abs(theta[0]), 1e-300)
        away = np.linalg.norm(at - ritz * theta[:count], axis=0)
        if basis.shape[1] == width or (away <= level * scale).all():
            # Judged by a product of their own, and once refined by what it says.
            ritz = _polished(ritz)
            at = product(ritz)
            small = ritz.T @ at
            theta, u = np.linalg.eigh((small + small.T) / 2)
            theta, u = theta[::-1], u[:, ::-1]
            ritz, at = ritz @ u, at @ u
            away = np.linalg.norm(at - ritz * theta, axis=0)
            if basis.shape[1] == width or (away <= 4 * level * scale).all():
                return theta, ritz
            basis, image = ritz, at
        open_ = np.flatnonzero(away > level * scale)
        if basis.shape[1] + len(open_) > most and most < width:
            keep = min(2 * count, basis.shape[1])
            basis, image = basis @ u[:, :keep], image @ u[:, :keep]
        t = corrections(product, theta[open_], (at - ritz * theta[:count])[:, open_], ritz)
        fresh = _orthonormal(np.where(np.isfinite(t), t, 0), basis)
        if not fresh.shape[1]:
            fresh = _orthonormal(rng.standard_normal((width, len(open_))), basis)
        fresh = fresh[:, :width - basis.shape[1]]
        basis, image = np.hstack([basis, fresh]), np.hstack([image, product(fresh)])
    raise ArithmeticError("the residuals of the components did not fall to the rounding level")


def _polished(q: np.ndarray) -> np.ndarray:
    """The columns orthonormalised to the last digit, each staying next to itself."""
    u, _, v = np.linalg.svd(q, full_matrices=False)
    return u @ v


def _projected(width: int, n: int, sums: np.ndarray, weights: np.ndarray, valid: np.ndarray):
    """Rows (vec_id, component, deviation, whitened) of a batch of vectors."""
    def change(batches):
        count = weights.shape[1]
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                x = _integers(part, width)
                m = len(x)
                whitened = centred(x, n, sums) @ weights
                wide = n * int(np.abs(x).max(initial=0)) >= SAFE
                away = np.zeros_like(x) if wide else n * x - sums
                big = wide or (away.astype(np.float64) ** 2).sum(1).max(initial=0) >= SAFE
                if big:
                    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
                    deviation = pa.array([e if e < 1 << 63 else None for e in exact], pa.int64())
                else:
                    deviation = pa.array((away * away).sum(1), pa.int64())
                rows = np.repeat(np.arange(m), count)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").take(pa.array(rows)), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), m)),
                     deviation.take(pa.array(rows)), pa.array(whitened.reshape(-1), mask=~np.tile(valid, m))],
                    names=["vec_id", "component", "deviation", "whitened"])
    return change


def fit_list(kept: DataFrame, width: int) -> Centred:
    """The distinct integer vectors of the kept rows, stored in blocks."""
    keys = kept.select("embedding").mapInArrow(_as_keys(width), "x binary").groupBy("x").agg(F.count("*").alias("rows"))
    return Centred(materialize(keys.select("x").mapInArrow(_as_blocks(width), "block binary, n long, sums array<long>"), "fit-list"), width)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error), one for each
    kept vector and component."""
    kept = kept_vectors(vectors)
    vec_id = dict(kept.dtypes)["vec_id"]
    width = kept.agg(F.max(F.size("embedding"))).first()[0]
    if not width:
        return kept.where("1 = 0").select(
            "vec_id", *(F.lit(None).cast(t).alias(c) for c, t in (("component", "int"), ("n", "long"), ("deviation", "long"),
                                                                  ("whitened", "double"), ("explained", "double"), ("identity_error", "double"))))
    fit = fit_list(kept, width)
    count = min(components, width)
    # The rounding of a sum of block sums grows with the root of their number.
    level = RESIDUAL + np.finfo(float).eps * (fit.n / BLOCK_ROWS) ** 0.5
    values, axes = eigenpairs(fit.product, width, count, level)
    trace = fit.trace()
    valid = values > NO_VARIANCE * max(values[0], 0.0)
    weights = np.where(valid, axes / np.sqrt(np.where(valid, values, 1.0)), 0.0)
    explained = np.where(valid, values / trace if trace > 0 else 0.0, 0.0)
    error = None
    if valid.any():
        mean = fit.total(lambda x: (x @ weights).sum(0)[None], 1, count)[0] / fit.n

        def spread(x):
            w = x @ weights - mean
            return w.T @ w

        away = np.abs(fit.total(spread, count, count) / fit.n - np.eye(count))
        error = float(away[np.ix_(valid, valid)].max())
    rows = documents(kept, "vec_id", "embedding").mapInArrow(
        _projected(width, fit.n, fit.sums, weights, valid), f"vec_id {vec_id}, component int, deviation long, whitened double")
    share = F.element_at(F.array(*(F.lit(float(v)) for v in explained)), F.col("component"))
    return rows.select("vec_id", "component", F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened",
                       share.alias("explained"), F.lit(error).cast("double").alias("identity_error"))
