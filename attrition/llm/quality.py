"""Quality classifier by co-training of a text view and a metadata view.

Both views are logistic regressions with their own features: the text view sees what the words
look like (hashed words and shares of character classes), the metadata view sees source,
language and length. They start from the labelled rows. In each round both score every unlabelled
row, and all rows one view is confident enough about become labelled rows of the other; how
confident it must be is read off labelled rows held back from training, and nothing else limits
their number. At the end each view is calibrated (Platt) on the held-back rows, and their
calibrated log odds are combined by weights fitted there too.

The labelled rows are a bounded sample picked by the hash of doc_id (``LABELLED`` at most) and held
by the driver as features. The unlabelled rows stay in Spark: their features are stored once,
rows handed over are tables, and a round's fit reads them in at most ``PASSES`` passes, each of
which returns sums of loss and gradient. Scoring is one map-only pass over all documents and whole
texts.

Defined results: null text counts as empty, null source, language and length have features of
their own; without labelled rows of both classes every score is 0.5 (kept); repeated label rows
count as rows; the score of a document never depends on its own label row at scoring time. A score
of exactly 0.5 is kept. Very long texts are one row of features like any other. An empty table of
documents gives no rows. Other columns of the input are not read, so their names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import ODD, chunks, documents, materialize, text_bytes
from attrition.session import release

#: Labelled rows (at most) that the views are fitted on.
LABELLED = 8_000
ROUNDS = 4
#: Share that must be right among the held-back rows of at least the same confidence, for a view to hand
#: a row to the other.
PRECISION = 0.97
#: Passes over the pseudo-labelled rows that a round's fit takes, and steps its search remembers.
PASSES = 20
MEMORY = 8
#: Labelled rows whose features the driver widens to double precision at once.
BLOCK = 1024
WORD_BUCKETS = 1 << 10
META_BUCKETS = 1 << 8
SHARES = 10
#: Weight of the character shares beside the unit-length word vector.
SHARE_WEIGHT = 6.0
PENALTY = 1e-4
#: Calibrated log odds are held within this range.
MOST_ODDS = 8.0


def _hash_text(value: str) -> int:
    out = 2166136261
    for b in value.encode():
        out = ((out ^ b) * 16777619) & 0xFFFFFFFF
    return out


#: Class of every byte whose share is a feature (the last one: none of them); a line feed counts as a
#: space too.
CLASSES = np.full(256, 9, np.uint8)
for _class, _members in enumerate([range(65, 91), range(48, 58), b"\n", b"|", b"!", b"*&%$#@^~<>{}[]=+_\\/", b".,;:?'\"-()",
                                   b" \t\v\f\r", range(128, 256)]):
    CLASSES[list(_members)] = _class
#: The byte in lower case, mixed for the hash of a word.
MIXED = np.array([b + 33 if 65 <= b <= 90 else b + 1 for b in range(256)], np.uint64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64, kept for the next call."""
    if len(_POWERS.get("up", ())) < n:
        n = max(n, 1 << 20)
        _POWERS["up"] = np.cumprod(np.full(n, ODD, np.uint64))
        _POWERS["down"] = np.cumprod(np.full(n, pow(ODD, -1, 1 << 64), np.uint64))
    return _POWERS["up"], _POWERS["down"]


def text_features(part: pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text (indices, values): word buckets by root frequency, then character shares."""
    data, offsets = text_bytes(part.column("text"))
    n = len(offsets) - 1
    size = np.diff(offsets)
    kind = CLASSES[data]
    space = (kind == 7) | (kind == 2)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    word = ~space
    begins = np.flatnonzero(word & (edge[:-1] | np.r_[True, space[:-1]][:len(data)]))
    ends = np.flatnonzero(word & (edge[1:] | np.r_[space[1:], True][:len(data)])) + 1
    # Hash of a word: sum of mixed bytes times powers of an odd number, by prefix sums modulo 2^64.
    power, inverse = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(MIXED[data] * power[:len(data)], out=total[1:])
    # Dividing by the first power is left out: words are compared after scaling to one position.
    key = (total[ends] - total[begins]) * inverse[begins] if len(begins) else np.empty(0, np.uint64)
    key = ((key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(54)
    owner = np.searchsorted(offsets, begins, side="right") - 1
    pair, times = np.unique(owner.astype(np.int64) * WORD_BUCKETS + key.astype(np.int64), return_counts=True)
    doc, bucket = pair // WORD_BUCKETS, pair % WORD_BUCKETS
    value = np.sqrt(times)
    norm = np.sqrt(np.bincount(doc, times, minlength=n))
    value = value / norm[doc] if len(doc) else value
    shares = np.zeros((n, SHARES))
    counted = np.bincount(np.repeat(np.arange(0, 10 * n, 10), size) + kind, minlength=10 * n).reshape(n, 10)[:, :9]
    counted[:, 7] += counted[:, 2]
    shares[:, :9] = counted / np.maximum(size, 1)[:, None]
    words = np.bincount(owner, minlength=n)
    distinct = np.bincount(doc, minlength=n)
    shares[:, 9] = distinct / np.maximum(words, 1)
    shares = SHARE_WEIGHT * np.sqrt(shares)
    cut = np.searchsorted(doc, np.arange(n + 1))
    return [(np.r_[bucket[cut[i]:cut[i + 1]], WORD_BUCKETS + np.arange(SHARES)],
             np.r_[value[cut[i]:cut[i + 1]], shares[i]]) for i in range(n)]


def meta_features(lang, source, n_chars) -> tuple[np.ndarray, np.ndarray]:
    """(indices, values) of the metadata view: language, source, their pair, length class."""
    size = "none" if n_chars is None else str(int(np.log2(max(n_chars, 0) + 1) * 2))
    names = [f"l={lang}", f"s={source}", f"ls={lang},{source}", f"n={size}"]
    index = np.unique([_hash_text(x) % META_BUCKETS for x in names])
    return index, np.ones(len(index))


def _dense(rows: list, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.float32)
    for i, (index, value) in enumerate(rows):
        out[i, index] = value
    return out


def _dense_columns(index: pa.ChunkedArray, value: pa.ChunkedArray | None, width: int) -> np.ndarray:
    """``_dense`` of Arrow columns, without an object for every entry; no values: ones."""
    index = index.combine_chunks()
    row = np.repeat(np.arange(len(index)), np.diff(np.asarray(index.offsets)))
    out = np.zeros((len(index), width), np.float32)
    out[row, np.asarray(index.flatten())] = 1.0 if value is None else np.asarray(value.combine_chunks().flatten())
    return out


def _fit(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY, rounds: int = 150) -> np.ndarray:
    """Class-balanced logistic regression by accelerated gradient steps; last weight: bias."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    share = np.where(y > 0, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9)) / len(y)
    share, y = share.astype(np.float32), y.astype(np.float32)
    step = np.float32(4 / (np.square(x).sum(1).max() + penalty))
    penalty = np.float32(penalty)
    w = np.zeros(x.shape[1], np.float32)
    ahead, t = w.copy(), 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30)))
        new = ahead - step * (x.T @ (share * (p - y)) + penalty * ahead)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead, w = new + np.float32((before - 1) / t) * (new - w), new
    return w


def _odds(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


def _newton(x: np.ndarray, target: np.ndarray, shift: float, start: np.ndarray, pull: np.ndarray) -> np.ndarray:
    """Logistic regression of soft targets by damped Newton steps; ``pull`` ties w to ``start``."""
    def loss(w):
        z = x @ w + shift
        return (np.logaddexp(0, z) - target * z).sum() + (pull * (w - start) ** 2).sum() / 2
    w = start.astype(float)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w + shift, -30, 30)))
        gradient = x.T @ (p - target) + pull * (w - start)
        change = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull + 1e-9), gradient)
        size, now = 1.0, loss(w)
        while size > 1e-6 and loss(w - size * change) > now:
            size /= 2
        w = w - size * change
        if np.abs(size * change).max() < 1e-8:
            break
    return w


def _platt(score: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slope and intercept that calibrate a score, by Platt's smoothed targets."""
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    return _newton(np.stack([score, np.ones(len(y))], 1).astype(float), target, 0.0, np.array([1.0, 0.0]), np.array([1e-3, 1e-3]))


def calibrated(score: np.ndarray, platt: np.ndarray) -> np.ndarray:
    return np.clip(platt[0] * score + platt[1], -MOST_ODDS, MOST_ODDS)


def _sure(score: np.ndarray, y: np.ndarray, label: int) -> float:
    """Least score (in the label's direction) from which PRECISION of the rows have the label."""
    toward = score if label else -score
    order = np.argsort(-toward, kind="stable")
    right = np.cumsum(y[order] == label) / np.arange(1, len(y) + 1)
    enough = np.flatnonzero((right >= PRECISION) & (np.arange(len(y)) >= 9))
    return toward[order[enough[-1]]] if len(enough) else np.inf


class Sums:
    """Loss and gradient of both views over a labelled part, held here, and a pseudo-labelled table.

    A class weighs one half in each view's loss, whatever its size; ``told`` has the rows' features
    and, per view, the label they were given (-1: none)."""

    def __init__(self, sets: list, told: DataFrame | None):
        self.sets, self.told = sets, told
        more = np.zeros((2, 2))
        if told is not None:
            row = told.agg(*[F.count_if(F.col(f"label{v}") == y).alias(f"n{v}{y}") for v in (0, 1) for y in (0, 1)]).first()
            more = np.array([[row[f"n{v}{y}"] for y in (0, 1)] for v in (0, 1)], float)
        self.share = [[0.5 / max(1.0, (s[1] == y).sum() + more[v, y]) for y in (0, 1)] for v, s in enumerate(sets)]
        self.some = [more[v].sum() > 0 for v in (0, 1)]

    def at(self, weights: list) -> list:
        """(loss, gradient) of each view at the given weights, in one pass over the table."""
        out = [_loss(x, y, self.share[v], weights[v]) for v, (x, y) in enumerate(self.sets)]
        if any(self.some):
            widths = [len(w) for w in weights]
            for row in _told_sums(self.told, weights, self.share).collect():
                sums, at = np.array(row["sums"]), 0
                for v in (0, 1):
                    out[v][0] += sums[at]
                    out[v][1] += sums[at + 1:at + 1 + widths[v]]
                    at += 1 + widths[v]
        return [(loss + PENALTY / 2 * float(w @ w), gradient + PENALTY * w) for (loss, gradient), w in zip(out, weights)]


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(float)


def _loss(x: np.ndarray, y: np.ndarray, share: list, w: np.ndarray) -> list:
    loss, gradient = 0.0, np.zeros(len(w))
    for k in range(0, len(x), BLOCK):
        part, own = _with_one(x[k:k + BLOCK]), y[k:k + BLOCK]
        z = part @ w
        weight = np.where(own > 0, share[1], share[0])
        loss += float((weight * (np.logaddexp(0, z) - own * z)).sum())
        gradient += part.T @ (weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - own))
    return [loss, gradient]


def _told_sums(told: DataFrame, weights: list, share: list) -> DataFrame:
    """Sums of both views over the table, in a few rows."""
    size = sum(1 + len(w) for w in weights)

    def add(batches):
        from pyspark import TaskContext
        total = np.zeros(size)
        for batch in batches:
            at = 0
            for v, (label, index, value) in enumerate((("label0", "ti", "tv"), ("label1", "mi", None))):
                w = weights[v]
                y = np.asarray(batch.column(label))
                rows = np.flatnonzero(y >= 0)
                if len(rows):
                    loss, gradient = _sparse_loss(batch.take(pa.array(rows)), index, value, y[rows].astype(float), share[v], w)
                    total[at] += loss
                    total[at + 1:at + 1 + len(w)] += gradient
                at += 1 + len(w)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % 32], pa.int32()),
                                          pa.array([total.tolist()], pa.list_(pa.float64()))], names=["part", "sums"])

    def merge(key, table):
        sums = np.asarray(table.column("sums").combine_chunks().flatten()).reshape(-1, size).sum(0)
        return pa.table({"sums": pa.array([sums.tolist()], pa.list_(pa.float64()))})

    return told.mapInArrow(add, "part int, sums array<double>").groupBy("part").applyInArrow(merge, "sums array<double>")


def _rows_of(batch: pa.RecordBatch, index: str, value: str | None):
    """Row, bucket and value of every feature of a batch."""
    column = batch.column(index)
    offsets = np.asarray(column.offsets)
    bucket = np.asarray(column.flatten()).astype(np.int64)
    row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
    return row, bucket, np.asarray(batch.column(value).flatten(), float) if value else np.ones(len(bucket))


def _sparse_odds(batch: pa.RecordBatch, index: str, value: str | None, w: np.ndarray) -> np.ndarray:
    row, bucket, v = _rows_of(batch, index, value)
    return np.bincount(row, w[bucket] * v, minlength=batch.num_rows) + w[-1]


def _sparse_loss(batch: pa.RecordBatch, index: str, value: str | None, y: np.ndarray, share: list, w: np.ndarray):
    row, bucket, v = _rows_of(batch, index, value)
    z = np.bincount(row, w[bucket] * v, minlength=batch.num_rows) + w[-1]
    weight = np.where(y > 0, share[1], share[0])
    error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
    gradient = np.bincount(bucket, v * error[row], minlength=len(w)).astype(float)
    gradient[-1] += error.sum()
    return float((weight * (np.logaddexp(0, z) - y * z)).sum()), gradient


def refit(sums: Sums, views: list) -> list:
    """Both views from where they were, by limited-memory quasi-Newton steps that share their passes."""
    now = [w.astype(float) for w in views]
    told = sums.at(now)
    past: list[list] = [[], []]
    scale, trial = [1.0, 1.0], [None, None]
    for _ in range(PASSES - 1):
        for v in (0, 1):
            if trial[v] is None:
                trial[v] = _direction(told[v][1], past[v])
        ahead = [w + scale[v] * trial[v] for v, w in enumerate(now)]
        new = sums.at(ahead)
        for v in (0, 1):
            slope = float(told[v][1] @ trial[v])
            if new[v][0] <= told[v][0] + 1e-4 * scale[v] * slope:
                step, change = ahead[v] - now[v], new[v][1] - told[v][1]
                if float(step @ change) > 1e-12:
                    past[v] = [*past[v], (step, change)][-MEMORY:]
                now[v], told[v], trial[v], scale[v] = ahead[v], new[v], None, 1.0
            else:
                scale[v] /= 4
        if all(np.abs(t[1]).max() < 1e-6 for t in told):
            break
    return now


def _direction(gradient: np.ndarray, past: list) -> np.ndarray:
    """Minus the gradient times the inverse curvature that past steps tell of."""
    q, used = gradient.copy(), []
    for step, change in reversed(past):
        a = float(step @ q) / float(step @ change)
        used.append(a)
        q -= a * change
    if past:
        step, change = past[-1]
        q *= float(step @ change) / float(change @ change)
    for (step, change), a in zip(past, reversed(used)):
        q += step * (a - float(change @ q) / float(step @ change))
    return -q


def _hand_over(models: list):
    """Rows that a view is sure of for the first time in the last round of ``models``: what it says
    becomes the other view's label."""
    def go(batches):
        for batch in batches:
            given = np.full((2, batch.num_rows), -1, np.int32)
            free = np.ones(batch.num_rows, bool)
            for views, sure in models:
                given[:] = -1
                for v, (index, value) in enumerate((("ti", "tv"), ("mi", None))):
                    odds = _sparse_odds(batch, index, value, views[v])
                    for label in (1, 0):
                        given[1 - v][free & ((odds if label else -odds) >= sure[v][label])] = label
                last, free = free, free & (given < 0).all(0)
            took = np.flatnonzero(last & ~free) if models else np.empty(0, int)
            some = batch.take(pa.array(took))
            yield pa.RecordBatch.from_arrays(
                [*some.columns, pa.array(given[0][took]), pa.array(given[1][took])], names=[*batch.schema.names, "label0", "label1"])
    return go


def co_train(xt, xm, y, pool: DataFrame | None, held) -> dict:
    """Both views' weights, their calibration and the combination weights.

    xt, xm: feature matrices of labelled rows; y: 0/1; held: rows kept for calibration only; pool: the
    features (ti, tv, mi) of all unlabelled rows, or None. In a round every unlabelled row is scored by
    both views; each row that a view is sure of is handed to the other with its label, none is left out."""
    train = ~held
    sets = [[xt[train], y[train]], [xm[train], y[train]]]
    views = [_fit(*s) for s in sets]
    models, told, scratch = [], None, []
    for _ in range(ROUNDS if pool is not None else 0):
        sure = [[_sure(_odds(x[held], views[v]), y[held], label) for label in (0, 1)] for v, x in ((0, xt), (1, xm))]
        models.append((views, sure))
        fresh = materialize(pool.mapInArrow(_hand_over(models), "ti array<int>, tv array<float>, mi array<int>, label0 int, label1 int"), "told")
        scratch.append(fresh)
        told = fresh if told is None else told.unionByName(fresh)
        views = refit(Sums(sets, told), views)
    release(*scratch)
    scores = [_odds(x[held], w).astype(float) for x, w in zip((xt, xm), views)]
    platt = [_platt(s, y[held]) for s in scores]
    base = float(np.log((y[held].sum() + 0.5) / ((1 - y[held]).sum() + 0.5)))
    odds = np.stack([calibrated(s, c) for s, c in zip(scores, platt)], 1)
    mix = np.maximum(_newton(odds - base, y[held], base, np.ones(2), np.ones(2)), 0)
    return {"views": views, "platt": platt, "base": base, "mix": mix}


def _features(batches):
    for batch in batches:
        for chunk in chunks(batch):
            rows = text_features(chunk)
            meta = [meta_features(*x) for x in zip(*(chunk.column(c).to_pylist() for c in ("lang", "source", "n_chars")))]
            yield pa.RecordBatch.from_arrays(
                [chunk.column("doc_id"), chunk.column("quality"),
                 pa.array([r[0].astype(np.int32) for r in rows], pa.list_(pa.int32())),
                 pa.array([r[1].astype(np.float32) for r in rows], pa.list_(pa.float32())),
                 pa.array([m[0].astype(np.int32) for m in meta], pa.list_(pa.int32()))],
                names=["doc_id", "quality", "ti", "tv", "mi"])


def featured(frame: DataFrame) -> DataFrame:
    """Rows (doc_id, quality, ti, tv, mi) of documents with a quality (null: unlabelled)."""
    narrow = frame.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"), "text", "lang", "source", "n_chars")
    return narrow.mapInArrow(_features, "doc_id long, quality int, ti array<int>, tv array<float>, mi array<int>")


def fit(docs: DataFrame, labels: DataFrame) -> dict | None:
    """Model from the documents that ``labels`` (doc_id, quality) names, or None without both classes."""
    told = documents(labels, "doc_id", "quality").where("quality in (0, 1)")
    narrow = documents(docs, "doc_id", "text", "lang", "source", "n_chars")
    # The limit is taken over ids, and again over features where an id has several rows.
    ids = told.orderBy(F.xxhash64(F.lit(29), "doc_id"), "doc_id").limit(LABELLED)
    known = featured(narrow.join(ids, "doc_id")).orderBy(F.xxhash64(F.lit(29), "doc_id"), "doc_id").limit(LABELLED).toArrow()
    known = known.sort_by([("doc_id", "ascending")])
    y = np.array(known.column("quality").to_pylist(), float)
    if len(y) < 20 or y.min() == y.max():
        return None
    xt = _dense_columns(known.column("ti"), known.column("tv"), WORD_BUCKETS + SHARES)
    xm = _dense_columns(known.column("mi"), None, META_BUCKETS)
    del known
    held = np.zeros(len(y), bool)
    for label in (0, 1):
        held[np.flatnonzero(y == label)[::4]] = True
    if y[~held].min() == y[~held].max():
        return None
    # Features are dealt instead of texts, and by a shuffle at every size: the labels grow with the documents.
    every = featured(narrow.withColumn("quality", F.lit(None).cast("int"))).drop("quality")
    loose = every.join(told.select(F.col("doc_id").cast("long")).distinct().hint("merge"), "doc_id", "left_anti")
    pool = materialize(loose.select("ti", "tv", "mi"), "features")
    model = co_train(xt, xm, y, pool, held)
    release(pool)
    return model


def score(docs: DataFrame, model: dict | None) -> DataFrame:
    """Every document: doc_id, p_text, p_meta, score, keep."""
    narrow = documents(docs, "doc_id", "text", "lang", "source", "n_chars")
    if model is None:
        half = F.lit(0.5)
        return narrow.select("doc_id", half.alias("p_text"), half.alias("p_meta"), half.alias("score"),
                             F.lit(True).alias("keep"))

    def judge(batches):
        wt, wm = model["views"]
        base, mix = model["base"], model["mix"]
        sure = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))
        for batch in batches:
            for chunk in chunks(batch):
                odds = np.zeros((chunk.num_rows, 2))
                odds[:, 0] = [wt[i] @ v + wt[-1] for i, v in text_features(chunk)]
                odds[:, 1] = [wm[i] @ v + wm[-1] for i, v in (meta_features(*x) for x in zip(
                    *(chunk.column(c).to_pylist() for c in ("lang", "source", "n_chars"))))]
                odds = np.stack([calibrated(odds[:, k], c) for k, c in enumerate(model["platt"])], 1)
                p = sure((odds - base) @ mix + base)
                yield pa.RecordBatch.from_arrays(
                    [chunk.column("doc_id"), pa.array(sure(odds[:, 0])), pa.array(sure(odds[:, 1])),
                     pa.array(p), pa.array(p >= 0.5)], names=["doc_id", "p_text", "p_meta", "score", "keep"])

    id_type = dict(narrow.dtypes)["doc_id"]
    return narrow.mapInArrow(judge, f"doc_id {id_type}, p_text double, p_meta double, score double, keep boolean")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
