"""Repeated 100-byte strings by merging the Burrows-Wheeler transforms of shards.

Every byte is removed that a 100-byte string covers which also starts earlier (smaller doc_id, or
same document and earlier start).

The transform reads texts in blocks of ``STEP`` bytes: a suffix's symbol is the hashed block
before it, so ``LENGTH / STEP`` refinements order suffixes by their first 100 bytes. Each shard
of a group of texts is transformed alone. Two shards are merged by interleave refinement: the
interleave says for every place of the merged order which shard its suffix comes from; one
round deals the places out by the symbols read off both transforms in turn, stably, and so
lengthens the prefix that the interleave is ordered by, one block a round, without comparing or
sorting suffixes. A place where two neighbours part is marked in the round in which they do
(their common prefix in blocks); places never marked lie in intervals of equal strings. The
order within an interval is that of the corpus, so its first string stays and the others go.

What reaches the transforms is found without loss first. Windows of 100 bytes that are equal
have the same least hashed 40-byte string inside. A segment is a run of windows with the
same least string (its key). (1) Keys are counted over the corpus; only keys that occur twice can
hold a repeat. They are known to the tasks as a bitmap of fixed size, which lets through some
others at no harm. (2) Of equal segments the first one stays and all windows of the others go.
(3) Different segments of one key, and segments that repeat a string inside, are dealt by key
into groups of bounded size, and there the transforms are merged; of a segment goes to them what lies
between windows all of whose blocks occur again under its key. All segments of a key that occurs at most
``FEW`` times are dealt to its group at once, where (2) and (3) follow; for the others (2) is told by
their places first. A key with more than ``HOT``
different segments, or more than ``GROUP_BYTES`` of them, is cut again by a longer least string,
and at last into its windows, which are dealt by their own hash. Of equal windows only the first and the last go to the transforms,
whatever their number; those between become removed spans by their places.

Defined results: null text is empty; texts under 100 bytes keep everything; rows that repeat
doc_id and text are one document and get the same result; rows that share a doc_id otherwise are
ordered by the hash of their texts; null doc_ids come last.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attrition.llm.common import MIX, ODD, chunks, documents, materialize, text_bytes
from attrition.session import release

LENGTH = 100
STEP = 20
#: Bytes of the strings that make keys, level by level. The first is long enough that equal strings are
#: hardly ever chance, however large the corpus; beyond the last, windows are keys.
GRAMS = (40, 70)
BITMAP_BITS = 27
#: Of the keys that occur more than FEW times: at most one of FEW segments has one, and it is known to the
#: same tasks as the other two.
MANY_BITS = 24
HOT = 4096
#: A key that occurs as often at most, with GROUP_BYTES of text at most, is judged in one group.
FEW = 256
#: Added to a key's count by segments that repeat a string inside.
INSIDE = 1 << 32
GROUP_BYTES = 1 << 20
#: Text of a group on average: a group holds at most one key's GROUP_BYTES beside about this much. The
#: transforms hold some hundred bytes for each of it.
DEALT_BYTES = 1 << 18
SHARD_BYTES = 1 << 18
#: Text whose segments are worked out at once; the arrays hold some hundred bytes for each of it.
SLICE_BYTES = 1 << 17
#: What a segment without text counts among the text of a group.
BARE_BYTES = 32
#: Segments of repeated keys that are judged at once, and the most passes this is cut into by key.
JUDGED = 1 << 21
PASSES = 2
#: Order of a row without doc_id.
LAST = (1 << 63) - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(MIX)
    return x ^ (x >> np.uint64(32))


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64, kept for the next call."""
    if len(_POWERS.get("up", ())) < n:
        n = max(n, 1 << 20)
        _POWERS["up"] = np.cumprod(np.r_[np.uint64(1), np.full(n, ODD, np.uint64)])
        _POWERS["down"] = np.cumprod(np.r_[np.uint64(1), np.full(n, pow(ODD, -1, 1 << 64), np.uint64)])
    return _POWERS["up"], _POWERS["down"]


def _prefix(data: np.ndarray) -> np.ndarray:
    """Prefix sums whose differences, moved to one place, hash any substring."""
    up, _ = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    x = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(MIX)
    np.cumsum((x ^ (x >> np.uint64(31))) * up[:len(data)], out=total[1:])
    return total


def _hash(total: np.ndarray, start, end) -> np.ndarray:
    _, down = _powers(len(total))
    return _mixed((total[end] - total[start]) * down[start])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours."""
    size, n = 1, len(values) - width + 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:n], values[width - size:width - size + n])


def segments(data: np.ndarray, offsets: np.ndarray, gram_bytes: int = GRAMS[0]):
    """Segments of all texts: owner, start within the text, windows, key, hash, repeats inside."""
    none = np.empty(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none, none, none.astype(bool)
    total = _prefix(data)
    places = len(data) - gram_bytes + 1
    gram = _hash(total, slice(0, places), slice(gram_bytes, gram_bytes + places))
    bits = np.uint64(int(places).bit_length())
    coarse = (gram >> bits) << bits
    place = np.arange(places, dtype=np.uint64)
    mask = (np.uint64(1) << bits) - np.uint64(1)
    width = LENGTH - gram_bytes + 1
    left = (_least(coarse | place, width) & mask).astype(np.int64)
    right = (mask - (_least(coarse | (mask - place), width) & mask)).astype(np.int64)
    size = np.diff(offsets)
    windows = np.maximum(size - LENGTH + 1, 0)
    owner = np.repeat(np.arange(len(size)), windows)
    at = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows) + offsets[owner]
    key = gram[left[at]]
    fresh = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])]) if len(at) else none
    count = np.diff(np.r_[fresh, len(at)])
    begin, last = at[fresh], at[fresh + count - 1]
    inside = (left[begin] != left[last]) | (right[last] != left[last])
    code = _hash(total, begin, last + LENGTH)
    return owner[fresh], begin - offsets[owner[fresh]], count, key[fresh].view(np.int64), code.view(np.int64), inside


def _count_keys(gram: int):
    def count(batches):
        for batch in batches:
            for part in chunks(batch, limit=SLICE_BYTES):
                _, _, n, key, code, inside = segments(*text_bytes(part.column("text")), gram)
                if not len(key):
                    continue
                order = np.argsort(key)
                key, code, inside = key[order], code[order], inside[order]
                # Long segments count more, so that FEW of them hold at most GROUP_BYTES.
                counted = 1 + (n[order] + LENGTH - 1) * FEW // GROUP_BYTES
                first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[first]),
                     pa.array(np.add.reduceat(counted, first) + np.logical_or.reduceat(inside, first) * INSIDE),
                     pa.array(np.minimum.reduceat(code, first)), pa.array(np.maximum.reduceat(code, first))],
                    names=["key", "n", "low", "high"])
    return count


def _bitmap(keys: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """Bitmap of fixed size over the top bits of the keys, built by Spark, collected as words."""
    place = F.shiftrightunsigned("key", 64 - bits)
    words = keys.groupBy(F.shiftright(place, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - bits}) & 63 as int))")).alias("bits"))
    table = words.toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[np.asarray(table.column("word").combine_chunks())] = np.asarray(table.column("bits").combine_chunks())
    return out


def _in_bitmap(bitmap: np.ndarray, key: np.ndarray) -> np.ndarray:
    place = (key.view(np.uint64) >> np.uint64(65 - (len(bitmap) << 6).bit_length())).astype(np.int64)
    return (bitmap[place >> 6] >> (place & 63)) & 1 == 1


_SPANS = "doc long, hash long, begin long, end long"
_FOUND = "kind int, key long, seg long, doc long, hash long, start int, n int, size int, many boolean, text binary"


def _copies(key, code, doc, tie, start) -> tuple[np.ndarray, np.ndarray]:
    """Which segments equal one of an earlier place, and which to keep: a repeated row is no later copy
    of itself."""
    order = np.lexsort((start, tie, doc, code, key))
    same = np.r_[False, (key[order][1:] == key[order][:-1]) & (code[order][1:] == code[order][:-1])]
    later, keep = np.zeros(len(key), bool), np.ones(len(key), bool)
    later[order[same]] = True
    place = np.stack([doc, tie, start], 1)[order]
    head = np.maximum.accumulate(np.where(~same, np.arange(len(order)), 0))
    twin = same & np.r_[False, (place[1:] == place[:-1]).all(1)]
    itself = same & (place == place[head]).all(1)
    keep[order[twin | itself]] = False
    return later, keep


def _find(repeated: np.ndarray, varied: np.ndarray, many: np.ndarray, gram: int):
    """Segments of repeated keys; equal ones of a slice at once become removed spans (kind 1)."""
    def find(batches):
        for batch in batches:
            for part in chunks(batch, limit=SLICE_BYTES):
                data, offsets = text_bytes(part.column("text"))
                owner, start, n, key, code, _ = segments(data, offsets, gram)
                take = _in_bitmap(repeated, key)
                if not take.any():
                    continue
                owner, start, n, key, code = (v[take] for v in (owner, start, n, key, code))
                begin = offsets[owner] + start
                doc, tie, base = (np.asarray(part.column(c)).astype(np.int64)[owner] for c in ("doc", "hash", "start"))
                start = base + start
                later, keep = _copies(key, code, doc, tie, start)
                kind = later.astype(np.int32)
                # Neighbouring removed segments of a text become one row.
                gone = np.flatnonzero(keep & (kind == 1))
                text = _in_bitmap(varied, key) & (kind == 0) & keep
                texts = [data[b:b + m].tobytes() if t else None for b, m, t in zip(begin, n + LENGTH - 1, text)]
                if len(gone):
                    joins = np.r_[False, (owner[gone[1:]] == owner[gone[:-1]])
                                  & (start[gone[1:]] == start[gone[:-1]] + n[gone[:-1]])]
                    heads = np.flatnonzero(~joins)
                    n = n.copy()
                    n[gone[heads]] = np.add.reduceat(n[gone], heads)
                    keep[gone[joins]] = False
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kind), pa.array(key), pa.array(code), pa.array(doc), pa.array(tie),
                     pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)),
                     pa.array(np.where(text, n + LENGTH - 1, BARE_BYTES).astype(np.int32)), pa.array(_in_bitmap(many, key)),
                     pa.array(texts, pa.binary())],
                    names=["kind", "key", "seg", "doc", "hash", "start", "n", "size", "many", "text"]).filter(pa.array(keep))
    return find


def transform(symbol: np.ndarray, ahead: np.ndarray) -> np.ndarray:
    """Order of a shard's suffixes by their first LENGTH bytes, ties in corpus order.

    symbol: block at each place; ahead: the place STEP bytes before, cyclic within its text."""
    order = np.arange(len(symbol), dtype=np.int32)
    for _ in range(LENGTH // STEP):
        before = ahead[order]
        order = before[_stable_order(symbol[before])]
    return order


def _stable_order(symbol: np.ndarray) -> np.ndarray:
    """Stable argsort by symbol: its leading bits and the place are sorted as one number."""
    bits = np.uint64(max(1, int(len(symbol)).bit_length()))
    packed = ((symbol >> bits) << bits) | np.arange(len(symbol), dtype=np.uint64)
    packed.sort()
    packed &= (np.uint64(1) << bits) - np.uint64(1)
    return packed.astype(np.int32)


def merge(one: np.ndarray, two: np.ndarray, symbol: np.ndarray, ahead: np.ndarray):
    """Merged order of two shards and the places where a new string begins.

    Only the shards' transforms (``symbol[ahead[order]]``) are read."""
    bwt = (symbol[ahead[one]], symbol[ahead[two]])
    n = len(one) + len(two)
    source = np.r_[np.zeros(len(one), bool), np.ones(len(two), bool)]
    begins = np.zeros(n, bool)
    begins[0] = True
    for _ in range(LENGTH // STEP):
        read = np.empty(n, np.uint64)
        read[~source], read[source] = bwt
        dealt = _stable_order(read)
        group = np.cumsum(begins, dtype=np.int32)[dealt]
        read = read[dealt]
        begins = np.r_[True, (read[1:] != read[:-1]) | (group[1:] != group[:-1])]
        source = source[dealt]
    merged = np.empty(n, np.int32)
    merged[~source], merged[source] = one, two
    return merged, begins


def repeated_windows(texts: list[bytes]) -> np.ndarray:
    """For texts in corpus order, the places (in their concatenation) of windows that began earlier."""
    size = np.array([len(t) for t in texts], np.int64)
    # Each text is closed by STEP bytes that UTF-8 does not have, and read as a cycle.
    closed = size + STEP
    data = np.frombuffer((b"\xff" * STEP).join([*texts, b""]), np.uint8)
    bound = np.r_[0, np.cumsum(closed)]
    # Places are 32-bit: a group is far from 2^31 bytes, and these arrays are what a task holds.
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), closed)
    place = np.arange(len(data), dtype=np.int32)
    ahead = np.where(place - bound[owner] >= STEP, place - STEP, place - STEP + closed[owner]).astype(np.int32)
    symbol = np.zeros(len(data), np.uint64)
    whole = np.flatnonzero(place + STEP <= bound[owner + 1])
    symbol[whole] = _hash(_prefix(data), whole, whole + STEP) | np.uint64(1 << 63)
    shard = bound[:-1] // SHARD_BYTES
    cuts = np.r_[0, np.flatnonzero(shard[1:] != shard[:-1]) + 1, len(texts)] if len(texts) else np.array([0])
    parts = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        low, high = bound[a], bound[b]
        parts.append(transform(symbol[low:high], ahead[low:high] - np.int32(low)) + np.int32(low))
    if len(parts) == 1:
        parts.append(np.empty(0, np.int32))
    while len(parts) > 1:
        pairs = [merge(parts[i], parts[i + 1], symbol, ahead) if i + 1 < len(parts) else (parts[i], None)
                 for i in range(0, len(parts), 2)]
        parts = [p[0] for p in pairs]
        begins = pairs[0][1]
    order = parts[0]
    again = order[~begins]
    first = order[np.maximum.accumulate(np.where(begins, np.arange(len(order), dtype=np.int32), 0))[~begins]]
    valid = place - bound[owner] <= size[owner] - LENGTH
    sure = valid[again] & valid[first]
    again, first = again[sure], first[sure]
    # Blocks were told by their hashes: look at the bytes before anything is removed.
    equal = _equal(data, again, first)
    again = np.sort(again[equal]).astype(np.int64)
    return again - STEP * owner[again]


def _worth(texts: list[bytes], deal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The part of each text (begin, end) that its windows may repeat in: a window goes through the
    transforms only if each of its blocks occurs twice in texts of its ``deal``. Loses no repeat, as
    equal windows are dealt alike; empty where a text has no such window."""
    size = np.array([len(t) for t in texts], np.int64)
    bound = np.r_[0, np.cumsum(size)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    begin, end = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    if len(data) < LENGTH:
        return begin, end
    places = len(data) - STEP + 1
    block = _hash(_prefix(data), slice(0, places), slice(STEP, STEP + places))
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), size)[:places]
    block = _mixed(block ^ _mixed(deal.view(np.uint64) + np.uint64(ODD))[owner])
    # Leading bits of the hash and the place are sorted as one number.
    bits = np.uint64(int(places).bit_length())
    packed = ((block >> bits) << bits) | np.arange(places, dtype=np.uint64)
    packed.sort()
    same = (packed[1:] >> bits) == (packed[:-1] >> bits)
    twice = np.zeros(places, bool)
    twice[(packed & ((np.uint64(1) << bits) - np.uint64(1)))[np.r_[same, False] | np.r_[False, same]].astype(np.int64)] = True
    windows = len(data) - LENGTH + 1
    worth = np.logical_and.reduce([twice[k:k + windows] for k in range(0, LENGTH, STEP)])
    at = np.flatnonzero(worth)
    at = at[at + LENGTH <= bound[owner[at] + 1]]
    if not len(at):
        return begin, end
    mine = owner[at]
    first = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
    begin[mine[first]] = at[first] - bound[mine[first]]
    end[mine[first]] = at[np.r_[first[1:], len(at)] - 1] + LENGTH - bound[mine[first]]
    return begin, end


def _merge_group(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    table = table.sort_by([("doc", "ascending"), ("hash", "ascending"), ("start", "ascending")])
    texts = table.column("text").to_pylist()
    low, high = _worth(texts, np.asarray(table.column("deal")))
    some = np.flatnonzero(high)
    texts, table, low = [texts[i][low[i]:high[i]] for i in some], table.take(pa.array(some)), low[some]
    again = repeated_windows(texts) if texts else np.empty(0, np.int64)
    bound = np.r_[0, np.cumsum([len(t) for t in texts], dtype=np.int64)]
    row = np.searchsorted(bound, again, side="right") - 1
    fresh = np.flatnonzero(np.r_[True, (np.diff(again) != 1) | (np.diff(row) != 0)]) if len(again) else np.empty(0, np.int64)
    last = np.r_[fresh[1:], len(again)] - 1 if len(again) else fresh
    start = np.asarray(table.column("start")).astype(np.int64) + low
    row = row[fresh]
    begin = start[row] + again[fresh] - bound[row]
    return pa.table({"doc": np.asarray(table.column("doc"))[row], "hash": np.asarray(table.column("hash"))[row],
                     "begin": begin, "end": begin + again[last] - again[fresh] + LENGTH})


def _judge_group(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Removed spans of whole keys: of later equal segments, and of what the first ones repeat."""
    place = [np.asarray(table.column(c)).astype(np.int64) for c in ("doc", "hash", "start")]
    later, keep = _copies(np.asarray(table.column("key")), np.asarray(table.column("seg")), *place)
    gone = np.flatnonzero(later & keep)
    begin = place[2][gone]
    copies = pa.table({"doc": place[0][gone], "hash": place[1][gone], "begin": begin,
                       "end": begin + np.asarray(table.column("n"))[gone] + LENGTH - 1})
    texts = table.filter(pa.array(~later & keep)).filter(pc.field("text").is_valid())
    texts = texts.select(["doc", "hash", "start", "text", "key"]).rename_columns(["doc", "hash", "start", "text", "deal"])
    return pa.concat_tables([copies, _merge_group(key, texts)]) if texts.num_rows else copies


def _identified(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text and the order (doc, hash); the hash only matters where a doc_id is repeated."""
    narrow = documents(docs, "doc_id", "text", *more).withColumn("doc", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)))
    repeats = narrow.groupBy("doc").count().where("count > 1").limit(1).count()
    tie = F.xxhash64(F.coalesce("text", F.lit(""))) if repeats else F.lit(0).cast("long")
    return narrow.withColumn("hash", tie)


def _window_codes(batches):
    """Hash of every window of the texts, once per slice."""
    for batch in batches:
        for part in chunks(batch, limit=SLICE_BYTES):
            data, offsets = text_bytes(part.column("text"))
            _, at = _window_places(offsets)
            code, n = np.unique(_hash(_prefix(data), at, at + LENGTH).view(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(code, pa.int64()), pa.array(n, pa.int64())], names=["key", "n"])


def _window_places(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and place of every window of the texts."""
    windows = np.maximum(np.diff(offsets) - LENGTH + 1, 0)
    owner = np.repeat(np.arange(len(windows)), windows)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows) + offsets[owner]


def _equal(data: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Whether the LENGTH bytes from each place of ``one`` and ``two`` are the same."""
    span, out = np.arange(LENGTH), np.ones(len(one), bool)
    for k in range(0, len(one), 1 << 14):
        part = slice(k, k + (1 << 14))
        out[part] = (data[one[part, None] + span] == data[two[part, None] + span]).all(1)
    return out


_WINDOWS = "kind int, doc long, hash long, begin long, end long, text binary, deal long"


def _cut_windows(repeated: np.ndarray):
    """Windows of the texts whose hash is in the bitmap: the first of equal ones as a text of its own
    (kind 0), runs of later ones as removed spans (kind 1)."""
    def cut(batches):
        for batch in batches:
            for part in chunks(batch, limit=SLICE_BYTES):
                data, offsets = text_bytes(part.column("text"))
                owner, at = _window_places(offsets)
                code = _hash(_prefix(data), at, at + LENGTH).view(np.int64)
                take = np.flatnonzero(_in_bitmap(repeated, code))
                if not len(take):
                    continue
                owner, at, code = owner[take], at[take], code[take]
                doc, tie, base = (np.asarray(part.column(c)).astype(np.int64)[owner] for c in ("doc", "hash", "start"))
                start = base + at - offsets[owner]
                order = np.lexsort((start, tie, doc, code))
                same = np.r_[False, code[order][1:] == code[order][:-1]]
                head = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
                later = np.zeros(len(order), bool)
                again = np.flatnonzero(same)
                later[order[again]] = _equal(data, at[order[again]], at[head[again]])
                gone, first = np.flatnonzero(later), np.flatnonzero(~later)
                fresh = np.flatnonzero(np.r_[True, (np.diff(owner[gone]) != 0) | (np.diff(start[gone]) != 1)][:len(gone)])
                last = gone[np.r_[fresh[1:], len(gone)] - 1] if len(gone) else gone
                gone = gone[fresh]
                rows = np.r_[first, gone]
                texts = [data[b:b + LENGTH].tobytes() for b in at[first]] + [None] * len(gone)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.r_[np.zeros(len(first), np.int32), np.ones(len(gone), np.int32)]), pa.array(doc[rows]),
                     pa.array(tie[rows]), pa.array(start[rows]), pa.array(start[np.r_[first, last]] + LENGTH),
                     pa.array(texts, pa.binary()), pa.array(code[rows])],
                    names=["kind", "doc", "hash", "begin", "end", "text", "deal"])
    return cut


def _level(source: DataFrame, gram: int, scratch: list) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One level of keys over texts (doc, hash, start, text): spans of later equal segments, first
    segments of calm keys and of hot ones."""
    def stored(frame: DataFrame, name: str) -> DataFrame:
        scratch.append(materialize(frame, name))
        return scratch[-1]

    keys = stored(source.select("text").mapInArrow(_count_keys(gram), "key long, n long, low long, high long")
                  .groupBy("key").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
                  .where("n > 1").select("key", ((F.col("n") >= INSIDE) | (F.col("low") != F.col("high"))).alias("varied"),
                                         (F.col("n").bitwiseAND(INSIDE - 1) > min(FEW, HOT)).alias("many")), "keys")
    repeated, varied, many = _bitmap(keys), _bitmap(keys.where("varied")), _bitmap(keys.where("many"), MANY_BITS)
    release(keys)
    found = stored(source.mapInArrow(_find(repeated, varied, many, gram), _FOUND), "segments")
    told = {r["many"]: r for r in found.where("kind = 0").groupBy("many").agg(
        F.count("*").alias("rows"), F.sum("size").alias("size")).collect()}
    rows, size = ([told[m][c] if m in told else 0 for m in (False, True)] for c in ("rows", "size"))
    place = ["doc", "hash", "start"]
    # Keys are judged in passes, whose shuffles are on disk one after the other.
    passes = min(PASSES, 1 + rows[0] // JUDGED)
    groups = max(1, -(-size[0] // (passes * DEALT_BYTES)))
    few = found.where("kind = 0 and not many").withColumn("group", F.pmod(F.xxhash64("key"), F.lit(groups)))
    whole = [stored(few.where(F.pmod("key", F.lit(passes)) == k).select("group", "key", "seg", *place, "n", "text")
                    .groupBy("group").applyInArrow(_judge_group, _SPANS), "judged") for k in range(passes)]
    # What is asked of equal segments and of a key is summed before it is dealt, and rows are told
    # from the first of their kind by their places, so no such key or segment is gathered in a task.
    passes = min(PASSES, 1 + rows[1] // JUDGED)
    parts = []
    for k in range(passes):
        same = found.where(F.expr("kind = 0 and many") & (F.pmod("key", F.lit(passes)) == k))
        first = same.groupBy("key", "seg").agg(F.min(F.struct(*place)).alias("at"), F.max("n").alias("n"))
        # At most one key for HOT segments or GROUP_BYTES of text; the planner looks at their number.
        crowded = (first.groupBy("key").agg(F.count("*").alias("segs"), F.sum(F.col("n") + LENGTH - 1).alias("bytes"))
                   .where((F.col("segs") > HOT) | ((F.col("segs") > 1) & (F.col("bytes") > GROUP_BYTES)))
                   .select("key", F.lit(True).alias("hot")))
        marks = first.join(stored(crowded, "crowded"), "key", "left").select("at.*", F.coalesce("hot", F.lit(False)).alias("hot"))
        # Only a text's key is asked for later. A repeated row is no later copy of itself: rows of one
        # place meet here.
        told = same.select(*place, "n", "text", F.when(F.col("text").isNotNull(), F.col("key")).alias("key"))
        parts.append(stored(told.join(marks, place, "left").where("hot is null or text is not null")
                            .select("key", *place, "n", "hot", F.when(F.col("hot").isNotNull(), F.col("text")).alias("text"))
                            .dropDuplicates(place), "judged"))
    judged = reduce(DataFrame.unionByName, parts)
    spans = stored(found.where("kind = 1").select(*place, "n")
                   .unionByName(judged.where("hot is null").select(*place, "n"))
                   .select("doc", "hash", F.col("start").cast("long").alias("begin"),
                           (F.col("start") + F.col("n") + LENGTH - 1).cast("long").alias("end")), "later")
    release(found)
    spans = reduce(DataFrame.unionByName, whole, spans)
    texts = judged.where("hot is not null")
    return spans, texts.where("not hot"), texts.where("hot")


def _runs(ends: DataFrame) -> DataFrame:
    """Texts (doc, hash, start, text, deal) of the first and the last place of equal windows: windows
    that follow one another at both places are one text there, so what they share is written once."""
    by = [F.col(f"{e}.{c}").alias(f"{e}_{c}") for e in ("first", "last") for c in ("doc", "hash")]
    pair = [f"{e}_{c}" for e in ("first", "last") for c in ("doc", "hash")] + ["apart"]
    told = ends.select(*by, (F.col("last.begin") - F.col("first.begin")).alias("apart"), F.col("first.begin").alias("begin"), "text")
    along = Window.partitionBy(*pair).orderBy("begin")
    told = told.withColumn("run", F.col("begin") - F.row_number().over(along))
    byte = F.struct("begin", F.hex(F.substring("text", LENGTH, 1)).alias("byte"))
    runs = told.groupBy(*pair, "run").agg(F.min("begin").alias("begin"), F.min_by("text", "begin").alias("head"),
                                         F.array_sort(F.collect_list(byte)).alias("tail"))
    rest = F.unhex(F.array_join(F.transform(F.slice("tail", 2, F.greatest(F.size("tail") - 1, F.lit(1))), lambda t: t["byte"]), ""))
    text = F.concat("head", F.when(F.size("tail") > 1, rest).otherwise(F.lit(b"")))
    whole = runs.select(*pair, "begin", text.alias("text")).withColumn("deal", F.xxhash64(*pair, "begin"))
    ends_ = F.array(*[F.struct(F.col(f"{e}_doc").alias("doc"), F.col(f"{e}_hash").alias("hash"),
                               (F.col("begin") + (F.col("apart") if e == "last" else F.lit(0))).cast("int").alias("start")) for e in ("first", "last")])
    return whole.select(F.explode(ends_).alias("at"), "text", "deal").select("at.*", "text", "deal")


def removed_spans(docs: DataFrame, scratch: list | None = None) -> DataFrame:
    """Rows (doc, hash, begin, end): bytes to remove; spans of a document may overlap. ``scratch``
    is given the stored tables that the rows are made from, to be released once these are stored."""
    scratch = [] if scratch is None else scratch
    place = ["doc", "hash", "start"]
    level, spans, rows, size = docs.select("doc", "hash", F.lit(0).alias("start"), "text"), None, None, 0
    for depth, gram in enumerate(GRAMS):
        later, calm, hot = _level(level, gram, scratch)
        calm = calm.select(*place, "text", F.xxhash64(F.lit(depth), "key").alias("deal"))
        size += calm.agg(F.sum(F.length("text"))).first()[0] or 0
        spans = later if spans is None else spans.unionByName(later)
        rows = calm if rows is None else rows.unionByName(calm)
        level = materialize(hot.select(*place, "text"), "hot")
        scratch.append(level)
        if level.isEmpty():
            break
    else:
        # Most windows of a key with many different segments occur once: only the others are dealt.
        codes = (level.select("text").mapInArrow(_window_codes, "key long, n long").groupBy("key")
                 .agg(F.sum("n").alias("n")).where("n > 1").select("key"))
        windows = materialize(level.mapInArrow(_cut_windows(_bitmap(codes)), _WINDOWS), "windows")
        at = F.struct("doc", "hash", "begin")
        ends = windows.where("kind = 0").groupBy("deal", "text").agg(F.min(at).alias("first"), F.max(at).alias("last"))
        ends = materialize(ends.select("text", "first", "last"), "ends")
        runs = materialize(_runs(ends.where("first <> last")), "runs")
        scratch += [windows, ends, runs]
        rows = rows.unionByName(runs)
        told = ends.select(F.explode(F.array("first", "last")).alias("at")).select("at.*")
        between = windows.where("kind = 0").join(told, ["doc", "hash", "begin"], "left_anti")
        spans = spans.unionByName(windows.where("kind = 1").unionByName(between).select("doc", "hash", "begin", "end"))
        size += runs.agg(F.sum(F.length("text"))).first()[0] or 0
    groups = max(1, -(-size // DEALT_BYTES))
    merged = (rows.withColumn("group", F.pmod("deal", F.lit(groups)))
              .groupBy("group").applyInArrow(_merge_group, _SPANS))
    return spans.unionByName(merged)


def _joined(spans: list) -> list[tuple[int, int]]:
    """Maximal runs of the union of spans."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def _collected(docs: DataFrame) -> DataFrame:
    """Spans of each document that has some, in one row: doc, hash, spans; stored."""
    scratch: list = []
    spans = materialize(removed_spans(docs, scratch).groupBy("doc", "hash").agg(
        F.collect_list(F.struct(F.col("begin").alias("b"), F.col("end").alias("e"))).alias("spans")), "spans")
    release(*scratch)
    return spans


def _marked(doc: np.ndarray) -> np.ndarray:
    """Bitmap key of a document."""
    return _mixed(doc.astype(np.int64).view(np.uint64) + np.uint64(ODD)).view(np.int64)


def _marks(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(_marked(np.asarray(batch.column("doc"))))], names=["key"])


def _split(docs: DataFrame, spans: DataFrame, columns: list[str], digest: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``columns`` of documents without spans, and of those that may have some beside ``spans``.

    Which is which is told by a bitmap of fixed size that misses none, so the texts of most
    untouched documents are not shuffled. With ``digest``, a schema, the first are given as their
    digests, made in the same workers."""
    bitmap = _bitmap(spans.select("doc").mapInArrow(_marks, "key long"))
    wanted = list(dict.fromkeys([*columns, "doc", "hash"]))
    schema = docs.select(*wanted).schema

    def take(marked: bool, then=iter):
        def filtered(batches):
            for batch in batches:
                hit = _in_bitmap(bitmap, _marked(np.asarray(batch.column("doc"))))
                yield batch.filter(pa.array(hit == marked))
        return lambda batches: then(filtered(batches))

    if digest:
        free = docs.select(*wanted).mapInArrow(take(False, _digest), digest)
    else:
        free = docs.select(*wanted).mapInArrow(take(False), schema).select(*columns)
    rest = docs.select(*wanted).mapInArrow(take(True), schema).join(spans, ["doc", "hash"], "left")
    return free, rest.select(*columns, "spans")


def _apply(parts: list[tuple[int, int]], raw: bytes) -> bytes:
    kept, at = [], 0
    for begin, end in parts:
        kept.append(raw[at:begin])
        at = end
    kept.append(raw[at:])
    return b"".join(kept)


def _pairs(column) -> list[list[tuple[int, int]]]:
    return [[(s["b"], s["e"]) for s in row or ()] for row in column.to_pylist()]


def _slices(batches):
    """Pieces of the batches that hold about SLICE_BYTES of text."""
    for batch in batches:
        yield from chunks(batch, limit=SLICE_BYTES)


def _digest(batches):
    for batch in _slices(batches):
        out: list[tuple] = []
        found = _pairs(batch.column("spans")) if "spans" in batch.schema.names else [[]] * batch.num_rows
        for text, spans in zip(batch.column("text").to_pylist(), found):
            raw = (text or "").encode()
            parts = _joined(spans)
            out.append((len(raw), sum(e - b for b, e in parts), len(parts), hashlib.sha256(_apply(parts, raw)).hexdigest()))
        columns = list(zip(*out)) or [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    order = _identified(docs)
    schema = f"doc_id {dict(order.dtypes)['doc_id']}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    free, rest = _split(order, _collected(order), ["doc_id", "text"], schema)
    return free.unionByName(rest.mapInArrow(_digest, schema))


def _characters(spans: list, raw: bytes) -> list[tuple[int, int]]:
    """Spans widened to whole UTF-8 characters."""
    out = []
    for begin, end in spans:
        while begin > 0 and raw[begin] & 0xC0 == 0x80:
            begin -= 1
        while end < len(raw) and raw[end] & 0xC0 == 0x80:
            end += 1
        out.append((begin, end))
    return _joined(out)


def _cut(batches):
    for batch in _slices(batches):
        texts = []
        for text, spans in zip(batch.column("text").to_pylist(), _pairs(batch.column("spans"))):
            raw = (text or "").encode()
            texts.append(_apply(_characters(spans, raw), raw).decode() if spans else text)
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string()), batch.column("cut")],
                                         names=["row", "left", "cut"])


def cut_documents(docs: DataFrame) -> DataFrame:
    """Pipeline form: documents with repeats cut out of ``text`` and ``n_chars`` (if there) counted
    anew; a character of which a byte was cut goes as a whole. A document of which only white
    space is left after a cut goes; all others stay."""
    columns = docs.columns
    others = [c for c in columns if c != "text"]
    row = F.struct(*[F.col(f"`{c}`") for c in others])
    order = _identified(docs.select(row.alias("row"), F.col("doc_id").alias("doc_id"), F.col("text").alias("text")), "row")
    free, rest = _split(order, _collected(order), ["row", "text"])
    found = rest.select("row", "text", "spans", F.col("spans").isNotNull().alias("cut"))
    left = found.mapInArrow(_cut, f"row {found.schema['row'].dataType.simpleString()}, left string, cut boolean")
    left = left.where(~F.col("cut") | (F.trim("left") != ""))
    of = {c: F.col("row").getField(c) for c in others}
    whole = {**of, "text": F.col("text")}
    of["text"] = F.col("left")
    if "n_chars" in of:
        of["n_chars"] = F.when(F.col("cut"), F.length("left").cast(docs.schema["n_chars"].dataType)).otherwise(of["n_chars"])
    return (free.select(*[whole[c].alias(c) for c in columns])
            .unionByName(left.select(*[of[c].alias(c) for c in columns])))
