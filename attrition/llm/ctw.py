"""Language-model scores by context-tree weighting over binary-decomposed bytes.

A byte is eight binary decisions; each decision, named by the bits before it, has a context tree
over the ``DEPTH`` preceding bytes. A node estimates with Krichevsky-Trofimov counts of the
training rows and mixes, at weight one half, its own estimate with its children's product. The
mixture along a context's path gives the probability of each bit, and the bits of a byte its
log10 probability; their sum over a text and its end is the score (code length is its negative).

Everything gathered from the corpus is a distributed table: counts of byte strings, tree levels,
word counts for the base score. All byte strings of all rows are in the table (with zero counts
if only held-out rows have them), so each lookup is a hit. Lookups have two tiers: keys with at
least ``floor`` occurrences, at most ``HEAD`` of each kind, go with the tasks as a hash table;
the others are joined by shuffle, and no key of that join has ``floor`` rows or more, so it has
no hot key.

Texts are lower-cased in A-Z. Defined results: null and empty texts consist of their end alone;
without training rows every bit has probability one half and the base is 1 / (0 + 0 + 1);
repeated rows are scored one by one and each counts in training; a null doc_id is in training.
Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import (END_WORD, ODD, chunks, crc_mod, documents, head_floor, lowered,
                                  materialize, word_keys)
from attrition.session import release

DEPTH = 5
HEAD = 1 << 19
#: Marks the end of a text and fills contexts before its start; never a byte of UTF-8.
END = 255
WORD, STRING = 0, 1


def byte_strings(low: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(string, owner): DEPTH context bytes and the byte itself, for every byte and each end."""
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    gap = DEPTH + 1
    padded = np.full(len(low) + n * gap, END, np.uint64)
    padded[np.arange(len(low)) + owner * gap + DEPTH] = low
    code = padded.copy()
    for back in range(1, DEPTH + 1):
        code[back:] |= padded[:-back] << np.uint64(8 * back)
    real = np.ones(len(padded), bool)
    heads = offsets[:-1] + np.arange(n) * gap
    real[(heads[:, None] + np.arange(DEPTH)).ravel()] = False
    return code[real].view(np.int64), np.repeat(np.arange(n), np.diff(offsets) + 1)


def _tally(batches):
    """Counts of words and byte strings: kind, key, n_train, n_all."""
    for batch in batches:
        parts: dict = {(kind, t): [] for kind in (WORD, STRING) for t in (True, False)}
        held = 0
        for part in chunks(batch):
            low, offsets = lowered(part)
            train = np.asarray(part.column("train"))
            for kind, (key, owner) in ((WORD, word_keys(low, offsets)), (STRING, byte_strings(low, offsets))):
                for t in (True, False):
                    parts[kind, t].append(np.unique(key[train[owner] == t], return_counts=True))
            parts[WORD, True].append((np.array([END_WORD]), np.array([train.sum()])))
            parts[WORD, False].append((np.array([END_WORD]), np.array([(~train).sum()])))
            held += 1
            if held == 16:
                yield from _merged(parts)
                held = 0
        yield from _merged(parts)


def _merged(parts: dict):
    for (kind, train), found in parts.items():
        if found:
            key = np.concatenate([k for k, _ in found])
            n = np.concatenate([c for _, c in found])
            order = np.argsort(key, kind="stable")
            key, n = key[order], n[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
            n = np.add.reduceat(n, first) if len(first) else n
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(first), kind, np.int32)), pa.array(key[first]),
                 pa.array(n if train else np.zeros_like(n)), pa.array(n)],
                names=["kind", "key", "n_train", "n_all"])
            found.clear()


def _log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 0.5: Stirling's series at x+8, moved back by the recurrence."""
    z = x + 8
    step = x
    for k in range(1, 8):
        step = step * (x + k)
    return ((z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z)
            - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z) - F.log(step))


def _estimate(n0: Column, n1: Column) -> Column:
    """ln of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    return F.when(n0 + n1 == 0, 0.0).otherwise(
        _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - math.log(math.pi) - _log_gamma(n0 + n1 + 1.0))


def _bits(strings: DataFrame) -> DataFrame:
    """Eight rows per byte string: its context, the bits before (with a leading 1) and the bit."""
    place = F.explode(F.sequence(F.lit(0), F.lit(7)))
    split = strings.select("*", F.shiftright("key", 8).alias("context"),
                           F.col("key").bitwiseAND(255).cast("int").alias("byte"), place.alias("i"))
    return (split.withColumn("before", F.expr("shiftleft(1, i) | shiftright(byte, 8 - i)"))
            .withColumn("bit", F.expr("shiftright(byte, 7 - i) & 1")).drop("byte", "i"))


def tree(strings: DataFrame, scratch: list | None = None) -> DataFrame:
    """Rows (key, log_p): log10 probability of each byte string's last byte in its context.

    ``strings``: key, n_train. Levels are built from the deepest up by grouped sums, then the
    mixture is carried down by equi-joins in which a parent has at most 256 children. ``scratch`` is
    given the stored levels, to be released once the rows are stored."""
    half = math.log(0.5)
    levels = {DEPTH: _bits(strings).groupBy("context", "before").agg(
        F.sum(F.when(F.col("bit") == 0, F.col("n_train")).otherwise(0)).alias("n0"),
        F.sum(F.when(F.col("bit") == 1, F.col("n_train")).otherwise(0)).alias("n1"))}
    own = _estimate(F.col("n0"), F.col("n1"))
    levels[DEPTH] = materialize(levels[DEPTH].withColumn("weighted", own)
                                .withColumn("stop", F.lit(1.0)).withColumn("go", F.lit(0.0)), "ctw")
    for depth in range(DEPTH - 1, -1, -1):
        up = (levels[depth + 1]
              .groupBy(F.col("context").bitwiseAND((1 << 8 * depth) - 1).alias("context"), "before")
              .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("weighted").alias("below")))
        up = up.withColumn("own", own)
        high = F.greatest("own", "below")
        up = up.withColumn("weighted", half + high + F.log(F.exp(F.col("own") - high) + F.exp(F.col("below") - high)))
        up = (up.withColumn("stop", F.exp(half + F.col("own") - F.col("weighted")))
              .withColumn("go", F.exp(half + F.col("below") - F.col("weighted"))))
        levels[depth] = materialize(up.drop("own", "below"), "ctw")
    if scratch is not None:
        scratch += levels.values()
    path = None
    for depth in range(DEPTH + 1):
        here = levels[depth].select(
            "context", "before", "stop", "go",
            ((F.col("n0") + 0.5) / (F.col("n0") + F.col("n1") + 1)).alias("p0"),
            ((F.col("n1") + 0.5) / (F.col("n0") + F.col("n1") + 1)).alias("p1"))
        if path is None:
            path = here.withColumns({"q0": F.col("stop") * F.col("p0"), "q1": F.col("stop") * F.col("p1"),
                                     "left": F.col("go")})
        else:
            parent = path.select(F.col("context").alias("up"), "before", F.col("q0").alias("u0"),
                                 F.col("q1").alias("u1"), "left")
            here = here.withColumn("up", F.col("context").bitwiseAND((1 << 8 * (depth - 1)) - 1))
            path = here.join(parent, ["up", "before"]).select(
                "context", "before", (F.col("u0") + F.col("left") * F.col("stop") * F.col("p0")).alias("q0"),
                (F.col("u1") + F.col("left") * F.col("stop") * F.col("p1")).alias("q1"),
                (F.col("left") * F.col("go")).alias("left"))
        path = path.select("context", "before", "q0", "q1", "left")
    # A context's nodes, at most 255 of them, come together, so a string is one row of the join.
    nodes = path.groupBy("context").agg(F.map_from_entries(F.collect_list(F.struct("before", F.struct("q0", "q1")))).alias("nodes"))
    byte = F.col("key").bitwiseAND(255).cast("int")
    log_p = F.lit(0.0)
    for i in range(8):
        node = F.col("nodes")[F.shiftright(byte, 8 - i).bitwiseOR(F.lit(1 << i))]
        bit = F.shiftright(byte, 7 - i).bitwiseAND(F.lit(1))
        log_p = log_p + F.log10(F.when(bit == 0, node["q0"]).otherwise(node["q1"]))
    return (strings.select("key", F.shiftright("key", 8).alias("context")).join(nodes, "context")
            .select("key", log_p.alias("log_p")))


class Head:
    """Open-addressing table of int64 keys to float64 values with vectorised lookup."""

    def __reduce__(self):
        # Tasks get the keys and values and lay out the table themselves.
        return Head, self.rows

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.rows = (keys, values)
        self.power = max(4, int(len(keys) * 2).bit_length())
        self.keys = np.zeros(1 << self.power, np.int64)
        self.values = np.zeros(1 << self.power)
        self.used = np.zeros(1 << self.power, bool)
        self.reach = 0
        rest, place = np.arange(len(keys)), self._place(keys)
        while len(rest):
            self.reach += 1
            at, first = np.unique(place[rest], return_index=True)
            free = ~self.used[at]
            at, took = at[free], rest[first[free]]
            self.keys[at], self.values[at], self.used[at] = keys[took], values[took], True
            rest = np.setdiff1d(rest, took, assume_unique=True)
            place[rest] = (place[rest] + 1) & ((1 << self.power) - 1)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        x = (keys.view(np.uint64) ^ (keys.view(np.uint64) >> np.uint64(29))) * np.uint64(ODD)
        return (x >> np.uint64(64 - self.power)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, hit); the value of a miss is 0."""
        place = self._place(keys)
        hit = self.used[place] & (self.keys[place] == keys)
        out = np.where(hit, self.values[place], 0.0)
        rest = np.flatnonzero(~hit & self.used[place])
        for _ in range(self.reach - 1):
            if not len(rest):
                break
            place[rest] = (place[rest] + 1) & ((1 << self.power) - 1)
            at = place[rest]
            found = self.used[at] & (self.keys[at] == keys[rest])
            hit[rest[found]] = True
            out[rest[found]] = self.values[at[found]]
            rest = rest[~found & self.used[at]]
        return out, hit


def _head(rows: DataFrame, value: str) -> Head:
    table = rows.select("key", F.col(value).cast("double").alias("value")).toArrow()
    return Head(np.asarray(table.column("key").combine_chunks(), dtype=np.int64).copy(),
                np.asarray(table.column("value").combine_chunks(), dtype=np.float64).copy())


def _missed(owner: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((key, owner))
    owner, key = owner[order], key[order]
    first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])])
    return owner[first], key[first], np.diff(np.r_[first, len(key)])


def score(docs: DataFrame) -> DataFrame:
    """Every document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and
    code length per byte of the text and its end (bits_per_byte)."""
    narrow = documents(docs, "doc_id", "text").withColumn("held_out", crc_mod("doc_id", 7) == 2)
    counts = materialize(
        narrow.select("text", (~F.col("held_out")).alias("train"))
        .mapInArrow(_tally, "kind int, key long, n_train long, n_all long")
        .groupBy("kind", "key").agg(F.sum("n_train").alias("n_train"), F.sum("n_all").alias("n_all")), "counts")
    words = counts.where(F.col("kind") == WORD).drop("kind")
    strings = counts.where(F.col("kind") == STRING).drop("kind")
    size = words.agg(F.sum("n_train"), F.count(F.when(F.col("n_train") > 0, 1))).first()
    n, v = size[0] or 0, size[1] or 0
    levels: list = []
    priced = materialize(tree(strings.select("key", "n_train"), levels).join(strings.select("key", "n_all"), "key"), "priced")
    # From here on the strings are read from ``priced``, the words from a table of their own.
    words = materialize(words, "words")
    release(*levels, counts)
    word_floor, string_floor = head_floor(words, "n_all", HEAD), head_floor(priced, "n_all", HEAD)
    head_words = _head(words.where(F.col("n_all") >= word_floor), "n_train")
    head_strings = _head(priced.where(F.col("n_all") >= string_floor), "log_p")
    scale = float(n + v + 1)

    def judge(batches):
        for batch in batches:
            for part in chunks(batch):
                low, offsets = lowered(part)
                rows = part.num_rows
                row = np.asarray(part.column("row"))
                key, owner = word_keys(low, offsets)
                key, owner = np.r_[key, np.full(rows, END_WORD)], np.r_[owner, np.arange(rows)]
                c, hit = head_words.find(key)
                base = np.bincount(owner[hit], np.log10((c[hit] + 1) / scale), minlength=rows)
                known = np.bincount(owner[hit & (c > 0)], minlength=rows)
                tokens = np.bincount(owner, minlength=rows)
                tail = [(WORD, *_missed(owner[~hit], key[~hit]))] if not hit.all() else []
                key, owner = byte_strings(low, offsets)
                p, hit = head_strings.find(key)
                total = np.bincount(owner, p, minlength=rows)
                tail += [(STRING, *_missed(owner[~hit], key[~hit]))] if not hit.all() else []
                none = np.zeros(rows, np.int64)
                size = np.diff(offsets)
                yield _rows(part.column("doc_id"), part.column("held_out"), row, np.full(rows, -1), none, none,
                            size, tokens, known, base, total)
                for kind, at, key, times in tail:
                    zero = np.zeros(len(at), np.int64)
                    yield _rows(pa.nulls(len(at), part.column("doc_id").type), pa.nulls(len(at), pa.bool_()), row[at],
                                np.full(len(at), kind), key, times, zero, zero, zero, zero, zero)

    numbered = narrow.select("doc_id", "held_out", "text", F.monotonically_increasing_id().alias("row"))
    found = materialize(numbered.mapInArrow(
        judge, f"doc_id {dict(narrow.dtypes)['doc_id']}, held_out boolean, row long, kind int, key long, n long, "
               "size long, n_tokens long, n_known long, base double, score double"), "scored")
    tail_words = found.where(F.col("kind") == WORD).join(words.select("key", "n_train"), "key").select(
        "row", F.when(F.col("n_train") > 0, F.col("n")).otherwise(0).alias("more_known"),
        (F.col("n") * F.log10((F.col("n_train") + 1) / F.lit(scale))).alias("more_base"), F.lit(0.0).alias("more_score"))
    tail_strings = found.where(F.col("kind") == STRING).join(priced.select("key", "log_p"), "key").select(
        "row", F.lit(0).cast("long").alias("more_known"), F.lit(0.0).alias("more_base"),
        (F.col("n") * F.col("log_p")).alias("more_score"))
    more = [f"more_{c}" for c in ("known", "base", "score")]
    sums = tail_words.unionByName(tail_strings).groupBy("row").agg(*[F.sum(c).alias(c) for c in more])
    scored = (found.where("kind = -1").select("row", "doc_id", "held_out", "size", "n_tokens", "n_known", "base", "score")
              .join(sums, "row", "left").fillna(0, more))
    total = F.col("score") + F.col("more_score")
    return scored.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.col("more_known")).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (F.col("base") + F.col("more_base")).alias("base_score"),
        total.alias("score"), (-total * math.log2(10) / (F.col("size") + 1)).alias("bits_per_byte"))


def _rows(doc_id, held_out, row, kind, key, n, size, tokens, known, base, score_) -> pa.RecordBatch:
    whole = [pa.array(x, pa.int64()) for x in (key, n, size, tokens, known)]
    return pa.RecordBatch.from_arrays(
        [doc_id, held_out, pa.array(row, pa.int64()), pa.array(kind.astype(np.int32)), *whole,
         pa.array(base, pa.float64()), pa.array(score_, pa.float64())],
        names=["doc_id", "held_out", "row", "kind", "key", "n", "size", "n_tokens", "n_known", "base", "score"])
