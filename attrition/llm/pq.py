"""Vector code compression: product quantisation by active-entry Lloyd rounds, exact in integers.

Components become integers floor(1024 * x) and a vector is cut into ``PARTS`` equal consecutive
parts; each part position has a codebook of at most ``ENTRIES`` entries, which starts as that part
of the vectors with the smallest ids. A round assigns every part to its nearest entry (squared
Euclidean distance, ties to the lower index) and replaces each entry by its parts' floor(sum /
count); unused entries stay.

Every part keeps its entry and the exact distance to it. If that entry did not move in the last
update, the distance still holds and no entry that stayed fixed can have become nearer, so only the
moved entries are compared with it, ties to the lower index; other parts rescan the codebook. The
state of a round is a table in the shared folder, dropped once the next one is stored. The driver
holds the codebooks (their size is fixed) and one row of sums per entry.

Defined results: vectors that are null or hold null or non-finite components are dropped. A vector
shorter than the longest kept one counts as filled up with zeros, as does the longest one up to a
multiple of ``PARTS``. Rows that share a vec_id are vectors of their own, ordered by their
components where the first codebook needs an order; null vec_ids come last there. Integers are
held within a bound that keeps every squared distance inside 64 bits (2^28 for parts of up to 16
components), which only components above 10^5 can meet. Fewer kept vectors than ``ENTRIES`` make as
many entries. An empty table gives no rows. Other columns of the input are not read, so their
names cannot clash; there is no text here that could be long.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import documents, materialize
from attrition.session import release

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Squared distances up to here are exact in doubles.
EXACT = 1 << 53
#: Rows whose distances to all entries are held at once.
ROWS = 1024
#: Label sums up to this many rows are broadcast; more are joined by a shuffle with salted labels.
BROADCAST_LABELS = 100_000
SALTS = 32


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, label, embedding of the rows whose vector is there and finite throughout."""
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return documents(vectors, "vec_id", "label", "embedding").where(F.col("embedding").isNotNull() & ~bad)


def rows_of(column, width: int) -> np.ndarray:
    """Rows of an Arrow list column as doubles, filled up with zeros to ``width``."""
    lengths = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten(), np.float64)
    if (lengths == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _lists(x: np.ndarray, kind) -> pa.ListArray:
    n, width = x.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * np.int32(width)), pa.array(x.reshape(-1), kind))


def bound(part: int) -> int:
    """Largest magnitude of an integer: ``part`` squared differences of such fit in 62 bits."""
    return 1 << ((62 - max(part - 1, 0).bit_length()) // 2 - 1)


def _as_integers(width: int):
    limit = bound(width // PARTS)

    def change(batches):
        for batch in batches:
            x = np.clip(np.floor(SCALE * rows_of(batch.column("embedding"), width)), -limit, limit).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), _lists(x, pa.int32())],
                                             names=["vec_id", "label", "x"])
    return change


def _distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to integer entries."""
    most = int(max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0)))
    if 4 * most * most * max(x.shape[1], 1) < EXACT:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return sum((x[:, j, None] - entries[:, j]) ** 2 for j in range(x.shape[1]))


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each row's nearest entry, ties to the lower one, and its squared distance."""
    index, distance = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
    for k in range(0, len(x), ROWS):
        d = _distances(x[k:k + ROWS], entries)
        at = d.argmin(1)
        index[k:k + ROWS], distance[k:k + ROWS] = at, d[np.arange(len(at)), at]
    return index, distance


def reassign(x: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray,
             distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entries again, given those before the entries of ``moved`` moved."""
    code, distance = code.copy(), distance.copy()
    lost = moved[code]
    code[lost], distance[lost] = nearest(x[lost], entries)
    active, still = np.flatnonzero(moved), np.flatnonzero(~lost)
    if len(active) and len(still):
        at, d = nearest(x[still], entries[active])
        at = active[at]
        nearer = (d < distance[still]) | ((d == distance[still]) & (at < code[still]))
        code[still[nearer]], distance[still[nearer]] = at[nearer], d[nearer]
    return code, distance


def _assigned(batch, width: int, books: np.ndarray, moved: np.ndarray | None):
    """Integers, codes and distances of a batch under the codebooks (part, entry, place)."""
    x = np.asarray(batch.column("x").flatten()).reshape(-1, width).astype(np.int64)
    part = width // PARTS
    code, distance = (np.zeros((len(x), PARTS), np.int64) for _ in range(2))
    if moved is not None:
        before = [np.asarray(batch.column(c).flatten()).reshape(-1, PARTS).astype(np.int64) for c in ("code", "distance")]
    for p in range(PARTS):
        own = x[:, p * part:(p + 1) * part]
        if moved is None:
            code[:, p], distance[:, p] = nearest(own, books[p])
        else:
            code[:, p], distance[:, p] = reassign(own, books[p], moved[p], before[0][:, p], before[1][:, p])
    return code, distance


def _round(width: int, books: np.ndarray, moved: np.ndarray | None):
    def assign(batches):
        for batch in batches:
            code, distance = _assigned(batch, width, books, moved)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("vec_id", "label", "x")), _lists(code, pa.int32()), _lists(distance, pa.int64())],
                names=["vec_id", "label", "x", "code", "distance"])
    return assign


def _last(width: int, books: np.ndarray, moved: np.ndarray):
    def assign(batches):
        for batch in batches:
            code, distance = _assigned(batch, width, books, moved)
            text = ["".join(f"{c:02x}" for c in row) for row in code.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(text, pa.string()),
                                              pa.array(distance.sum(1), pa.int64())], names=["vec_id", "label", "code", "error"])
    return assign


def _sums(width: int, entries: int):
    """One row per task, part and used entry: count and componentwise sums."""
    part = width // PARTS

    def add(batches):
        count, total = np.zeros((PARTS, entries), np.int64), np.zeros((PARTS, entries, part), np.int64)
        for batch in batches:
            x = np.asarray(batch.column("x").flatten()).reshape(-1, width).astype(np.int64)
            code = np.asarray(batch.column("code").flatten()).reshape(-1, PARTS)
            for p in range(PARTS):
                order = np.argsort(code[:, p], kind="stable")
                if len(order):
                    used, first = np.unique(code[order, p], return_index=True)
                    count[p, used] += np.diff(np.r_[first, len(order)])
                    total[p, used] += np.add.reduceat(x[order, p * part:(p + 1) * part], first, axis=0)
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(count[p, e]),
             *(pa.array(total[p, e, j]) for j in range(part))], names=["part", "entry", "n", *(f"s{j}" for j in range(part))])
    return add


def _updated(state: DataFrame, width: int, books: np.ndarray) -> np.ndarray:
    """Codebooks after the floor of each used entry's mean."""
    part = width // PARTS
    places = [f"s{j}" for j in range(part)]
    rows = (state.select("x", "code").mapInArrow(_sums(width, books.shape[1]), ", ".join(
        ["part int", "entry int", "n long", *(f"{c} long" for c in places)]))
        .groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in places)).collect())
    out = books.copy()
    for r in rows:
        out[r["part"], r["entry"]] = [r[c] // r["n"] for c in places]
    return out


def digest(books: np.ndarray) -> str:
    """sha256 of all entries' components by part, entry and place, as decimals joined by commas."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress(vectors: DataFrame) -> DataFrame:
    """One row per kept vector: vec_id, code, error, label_error, codebooks_sha256."""
    kept = kept_vectors(vectors)
    kinds = dict(kept.dtypes)
    owner = f"vec_id {kinds['vec_id']}, label {kinds['label']}"
    longest = kept.agg(F.max(F.size("embedding"))).first()[0]
    if longest is None:
        return kept.select("vec_id", *(F.lit(None).cast(t).alias(c) for c, t in (
            ("code", "string"), ("error", "long"), ("label_error", "long"), ("codebooks_sha256", "string"))))
    width = -(-longest // PARTS) * PARTS
    table = materialize(kept.mapInArrow(_as_integers(width), f"{owner}, x array<int>"), "integers")
    first = table.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(ENTRIES).select("x").collect()
    books = np.array([r["x"] for r in first], np.int64).reshape(-1, PARTS, width // PARTS).transpose(1, 0, 2).copy()
    moved = None
    for _ in range(ROUNDS):
        state = materialize(table.mapInArrow(_round(width, books, moved), f"{owner}, x array<int>, code array<int>, distance array<long>"), "codes")
        release(table)
        table, before = state, books
        books = _updated(state, width, books)
        moved = (books != before).any(2)
    coded = materialize(table.mapInArrow(_last(width, books, moved), f"{owner}, code string, error long"), "coded")
    release(table)
    sums = materialize(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    if sums.count() <= BROADCAST_LABELS:
        joined = coded.join(F.broadcast(sums.withColumnRenamed("label", "of")), F.col("label").eqNullSafe(F.col("of")))
    else:
        # A label may hold a third of the rows: each of its sums is there once per salt.
        salted = sums.select(F.col("label").alias("of"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("of_salt"))
        joined = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int")).join(
            salted, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("of_salt")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def sql() -> str:
    """The same rows in DuckDB, every round a full rescan, for vectors of one length divisible by PARTS."""
    steps = [f"""kept AS (SELECT vec_id, label, list_transform(embedding, lambda v: CAST(floor({SCALE} * CAST(v AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0)""",
             f"""parts AS MATERIALIZED (SELECT vec_id, label, p, CAST(x[p * len(x) // {PARTS} + 1 : (p + 1) * len(x) // {PARTS}] AS DOUBLE[]) AS v
  FROM kept, (SELECT unnest(range({PARTS})) AS p))""",
             f"""book0 AS MATERIALIZED (SELECT p, e, v FROM (SELECT p, v, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM parts)
  WHERE e < {ENTRIES})"""]
    for r in range(ROUNDS + 1):
        steps.append(f"""near{r} AS MATERIALIZED (SELECT vec_id, any_value(label) AS label, p, any_value(a.v) AS v,
  min(CAST(list_dot_product(a.v, a.v) - 2 * list_dot_product(a.v, b.v) + list_dot_product(b.v, b.v) AS BIGINT) * {ENTRIES} + b.e) AS best
  FROM parts a JOIN book{r} b USING (p) GROUP BY vec_id, p)""")
        if r < ROUNDS:
            steps.append(f"""book{r + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book{r} b LEFT JOIN (
  SELECT p, e, list(floor(total / n) ORDER BY i) AS v FROM (
    SELECT p, best % {ENTRIES} AS e, i, sum(v[i]) AS total, count(*) AS n
    FROM near{r}, (SELECT unnest(range(1, (SELECT max(len(v)) FROM parts) + 1)) AS i) GROUP BY ALL) GROUP BY p, e) m USING (p, e))""")
    return "WITH " + ",\n".join(steps) + f""",
coded AS (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', best % {ENTRIES}), '' ORDER BY p) AS code,
  CAST(sum(best // {ENTRIES}) AS BIGINT) AS error FROM near{ROUNDS} GROUP BY vec_id),
digest AS (SELECT sha256(string_agg(CAST(CAST(v[i] AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256
  FROM book{ROUNDS}, (SELECT unnest(range(1, (SELECT max(len(v)) FROM parts) + 1)) AS i))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded, digest"""
