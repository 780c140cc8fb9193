"""Language identification by error-correcting output codes.

Every language gets a codeword. Bit ``l`` of the codewords splits the languages in two camps,
and a binary classifier over hashed byte 3-grams (log odds of the two camps' smoothed n-gram
distributions, counted over *all* training rows) predicts it. A document's margins are decoded
by loss-weighted distance: bits that told a language apart well in training count more for it.
The nearest codeword wins; a small gap to the runner-up marks the document ambiguous.

Defined results: null text, empty text and text without a letter give ``und`` with score 0;
with no training row at all every document is ``und``; with one language that language is
predicted. Repeated rows are scored one by one. Rows with a null doc_id are kept.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import chunks, crc_mod, documents, text_bytes

BUCKETS = 1 << 16
#: Rows (expected) of the training table on which bit accuracies and margin scales are measured.
WEIGHT_ROWS = 20_000
#: Gap between the two nearest codewords' distances under which a document is ambiguous.
AMBIGUOUS_GAP = 0.05
SHARPNESS = 8.0


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """n codewords of +1/-1: exhaustive code up to 6 languages, else the best of seeded random
    codes (largest least Hamming distance)."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 6:
        cols = [[1, *c] for c in itertools.product([1, -1], repeat=n - 1) if -1 in c]
        return np.array(cols, float).T
    rng, best, gap = np.random.default_rng(seed), None, -1
    width = max(15, int(np.ceil(6 * np.log2(n))))
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], size=(n, width))
        code = code[:, np.abs(code.sum(0)) < n]
        distance = (code.shape[1] - code @ code.T) / 2
        least = distance[~np.eye(n, dtype=bool)].min()
        if least > gap:
            best, gap = code, least
    return best


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bucket of the 3-gram that ends at each byte; a text is preceded by blanks."""
    fold = np.zeros(256, np.uint32)
    fold[128:] = np.arange(128, 256)
    for first in (65, 97):
        fold[first:first + 26] = np.arange(97, 123)
    c = fold[data]
    code = c.copy()
    code[1:] |= c[:-1] << np.uint32(8)
    code[2:] |= c[:-2] << np.uint32(16)
    starts, ends = offsets[:-1], offsets[1:]
    first = starts[ends > starts]
    second = starts[ends > starts + 1] + 1
    code[first] = c[first]
    code[second] = c[second] | (c[second - 1] << np.uint32(8))
    return (code * np.uint32(2654435761)) >> np.uint32(16)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    rows: dict[str, int] = {}
    for batch in batches:
        for part in chunks(batch):
            data, offsets = text_bytes(part.column("text"))
            langs = part.column("lang").to_pylist()
            names = sorted(set(langs))
            number = {x: k for k, x in enumerate(names)}
            owner = np.repeat([number[x] for x in langs], np.diff(offsets))
            code = grams(data, offsets).astype(np.int64) + owner * BUCKETS
            found, times = np.unique(code, return_counts=True)
            for name, k in number.items():
                own = (found >= k * BUCKETS) & (found < (k + 1) * BUCKETS)
                into = totals.setdefault(name, np.zeros(BUCKETS, np.int64))
                into[found[own] - k * BUCKETS] += times[own]
            for x in langs:
                rows[x] = rows.get(x, 0) + 1
    for name, into in totals.items():
        at = np.flatnonzero(into)
        bucket = np.append(at, -1).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(bucket), pa.string()), pa.array(bucket),
             pa.array(np.append(into[at], rows[name]))], names=["lang", "bucket", "n"])


def _margins(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Mean log odds of every bit for every text (0 for an empty text)."""
    out = np.zeros((len(offsets) - 1, weights.shape[1]))
    full = np.flatnonzero(np.diff(offsets) > 0)
    if len(full):
        code = grams(data, offsets)
        starts = offsets[full]
        size = np.diff(offsets)[full]
        for bit in range(weights.shape[1]):
            out[full, bit] = np.add.reduceat(weights[:, bit][code], starts) / size
    return out


def fit(train: DataFrame) -> dict:
    """Model from rows (doc_id, text, lang), text and lang not null.

    n-gram counts cover all rows; bit accuracies and margin scales come from an expected
    ``WEIGHT_ROWS`` rows picked by the hash of the id.
    """
    counts = (train.select("text", "lang").mapInArrow(_count, "lang string, bucket int, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))).toPandas()
    langs = sorted(counts["lang"].unique())
    if not langs:
        return {"langs": []}
    table = np.zeros((len(langs), BUCKETS))
    rows = 0
    for k, name in enumerate(langs):
        own = counts[counts["lang"] == name]
        rows += int(own.loc[own["bucket"] < 0, "n"].sum())
        own = own[own["bucket"] >= 0]
        table[k, own["bucket"].to_numpy()] = own["n"].to_numpy()
    share = (table + 0.5) / (table.sum(1, keepdims=True) + 0.5 * BUCKETS)
    code = codewords(len(langs))
    if len(langs) == 1:
        return {"langs": langs, "code": code, "weights": np.zeros((BUCKETS, 1), np.float32),
                "scale": np.ones(1), "trust": np.ones((1, 1))}
    weights = np.stack([np.log(share[code[:, b] > 0].mean(0) / share[code[:, b] < 0].mean(0))
                        for b in range(code.shape[1])], 1).astype(np.float32)
    number = {x: k for k, x in enumerate(langs)}

    def tally(batches):
        right = np.zeros((len(langs), weights.shape[1]))
        size = np.zeros_like(right)
        seen = np.zeros(len(langs))
        for batch in batches:
            for part in chunks(batch):
                m = _margins(*text_bytes(part.column("text")), weights)
                k = np.array([number[x] for x in part.column("lang").to_pylist()], int)
                np.add.at(right, k, m * code[k] > 0)
                np.add.at(size, k, np.abs(m))
                np.add.at(seen, k, 1)
        at = [(i, b) for i in range(len(langs)) for b in range(weights.shape[1])]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in at], pa.int32()), pa.array([x[1] for x in at], pa.int32()),
             pa.array(right.ravel()), pa.array(size.ravel()), pa.array(np.repeat(seen, weights.shape[1]))],
            names=["lang", "bit", "right", "size", "seen"])

    part = max(1, round(1_000_000 * min(1.0, WEIGHT_ROWS / max(rows, 1))))
    sample = train.where(F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1_000_000)) < part)
    told = (sample.select("text", "lang")
            .mapInArrow(tally, "lang int, bit int, right double, size double, seen double")
            .groupBy("lang", "bit").agg(F.sum("right").alias("right"), F.sum("size").alias("size"),
                                        F.sum("seen").alias("seen"))).toPandas()
    right, size, seen = (np.zeros(code.shape) for _ in range(3))
    for name, into in (("right", right), ("size", size), ("seen", seen)):
        into[told["lang"].to_numpy(), told["bit"].to_numpy()] = told[name].to_numpy()
    trust = (right + 1) / (seen + 2)
    trust /= trust.sum(1, keepdims=True)
    scale = np.maximum(size.sum(0) / np.maximum(seen.sum(0), 1), 1e-6)
    return {"langs": langs, "code": code, "weights": weights, "scale": scale, "trust": trust}


def decode(margins: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the nearest codeword, its score, and the gap to the runner-up."""
    z = margins / model["scale"]
    loss = np.clip((1 - z[:, None, :] * model["code"][None]) / 2, 0, 1)
    distance = (loss * model["trust"][None]).sum(2)
    best = distance.argmin(1)
    power = np.exp(-SHARPNESS * (distance - distance.min(1, keepdims=True)))
    if distance.shape[1] == 1:
        gap = np.ones(len(distance))
    else:
        two = np.partition(distance, 1, axis=1)
        gap = two[:, 1] - two[:, 0]
    return best, 1 / power.sum(1), gap


def predict(rows: DataFrame, model: dict, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``rows`` (which has ``text``) plus lang_pred, score, ambiguous.

    Map-only: one Arrow pass, no shuffle."""
    langs = model["langs"]
    if not langs:
        return rows.select(*keep, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(True).alias("ambiguous"))
    fields = [rows.schema[c] for c in keep]

    def score(batches):
        for batch in batches:
            for part in chunks(batch):
                margins = _margins(*text_bytes(part.column("text")), model["weights"])
                best, sure, gap = decode(margins, model)
                lettered = np.asarray(part.column("__lettered"))
                names = np.where(lettered, np.array(langs, object)[best], "und")
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in keep]
                    + [pa.array(names, pa.string()), pa.array(np.where(lettered, sure, 0.0)),
                       pa.array(~lettered | (gap < AMBIGUOUS_GAP))],
                    names=[*keep, "lang_pred", "score", "ambiguous"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("__lettered")
    text = [] if "text" in keep else ["text"]
    return rows.select(*keep, *text, lettered).mapInArrow(
        score, schema + ", lang_pred string, score double, ambiguous boolean")


def fit_split(docs: DataFrame) -> dict:
    """Fit on documents with non-null text and lang whose crc32(doc_id) mod 4 is not 2."""
    narrow = documents(docs, "doc_id", "text", "lang")
    return fit(narrow.where((crc_mod("doc_id", 4) != 2) & F.col("lang").isNotNull()
                            & F.col("text").isNotNull()))


def classify(docs: DataFrame) -> DataFrame:
    """Every document: doc_id, held_out, lang_pred, score, ambiguous."""
    model = fit_split(docs)
    out = predict(documents(docs, "doc_id", "text"), model, ["doc_id"])
    return out.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred",
                      "score", "ambiguous")


def keep_identified(docs: DataFrame) -> DataFrame:
    """Pipeline form: all columns of the documents whose language is told without ambiguity."""
    model = fit_split(docs)
    columns = docs.columns
    # The other columns travel as one struct, so that no name of theirs can clash, the text once.
    others = [c for c in columns if c != "text"]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), F.col("text").alias("text"))
    told = predict(packed, model, ["row", "text"])
    return told.where(~F.col("ambiguous")).select(
        *[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in columns])
