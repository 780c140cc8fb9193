"""Substring dedup by suffix automata: every word goes that a repeated run of 35 words covers.

The reference texts are dealt into shards of bounded size, and each shard becomes one suffix
automaton over its words. A state stands for runs of words that end at the same places; its count
says at how many. The pieces of documents that could match a shard are streamed through its
automaton: at every word the walk knows the longest run ending there that occurs twice or more (the
matching statistics), and the maximal spans of 35 words or more are removed. All copies go, the
first one too.

All automata together grow with the corpus, so none is sent to all tasks: pieces are routed to the
shard that they can match instead, without loss. Windows of 35 words that are equal have the same
least hashed run of 12 words inside, their key. A piece is a run of neighbouring windows with one
key. (1) Keys are counted over the corpus; only those that occur twice can hold a repeat, told to
the tasks as a bitmap of fixed size, which lets some others through at no harm. (2) Equal pieces
are counted and streamed once; what is found in them goes back to their places over a join by the
sha256 of their words, those with very many places apart from the rest. (3) A key whose different
texts are more than a shard holds is cut again by the least run of 24 words, then by the windows
themselves, where one key has one text.

With ``reference`` given, the words go that the reference repeats instead: a window counts if it
starts anywhere in the reference, however often in the documents.

Defined results: null text has no words; texts under 35 words keep everything. Every row is a
document of its own, so rows that repeat doc_id and text repeat each other's windows. Rows that
share doc_id otherwise are told apart by the hash of their texts; null doc_ids are kept. Words
above 32 bytes are compared by their sha256. Very long texts are cut into bounded pieces; a single
text is held in a task as a whole. Order and ties play no part, as all copies go. An empty table
gives no rows. Other columns of the input are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import chunks, documents, materialize, text_bytes
from attrition.llm.suffixes import (_bitmap, _hash, _identified, _in_bitmap, _joined, _least, _pairs, _prefix,
                                    _split)
from attrition.session import release

LENGTH = 35
#: Words of the runs that make keys, level by level; at the last one the key is the window.
GRAMS = (12, 24, LENGTH)
#: Windows that a piece has at most.
PIECE = 2048
#: Different texts of a shard.
SHARD_BYTES = 1 << 18
#: Places of one text from which it is joined apart from the others.
COPIES = 4096
#: Text whose pieces are worked out at once.
SLICE_BYTES = 1 << 19
#: Bytes from which a word stands as its digest in pieces.
LONG_WORD = 32
#: Bits of a place among the grams of a slice; the same in all slices, so that ties fall alike.
PLACE_BITS = np.uint64(32)


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and text of every word: runs of bytes other than 0x20 and 0x09-0x0D."""
    if not len(data):
        return tuple(np.empty(0, np.int64) for _ in range(3))
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = np.flatnonzero(~space & (edge[:-1] | np.r_[True, space[:-1]]))
    ends = np.flatnonzero(~space & (edge[1:] | np.r_[space[1:], True])) + 1
    return begins, ends, np.searchsorted(offsets, begins, side="right") - 1


def keyed_runs(data: np.ndarray, offsets: np.ndarray, gram: int):
    """Runs of windows with one key: text, first word within it, windows, key, key repeated inside."""
    none = np.empty(0, np.int64)
    begins, ends, owner = word_bounds(data, offsets)
    if len(begins) < LENGTH:
        return none, none, none, none, none.astype(bool)
    total = _prefix(_hash(_prefix(data), begins, ends))
    places = len(begins) - gram + 1
    code = _hash(total, slice(0, places), slice(gram, gram + places))
    coarse = (code >> PLACE_BITS) << PLACE_BITS
    mask = (np.uint64(1) << PLACE_BITS) - np.uint64(1)
    place = np.arange(places, dtype=np.uint64)
    width = LENGTH - gram + 1
    left = (_least(coarse | place, width) & mask).astype(np.int64)
    right = (mask - (_least(coarse | (mask - place), width) & mask)).astype(np.int64)
    words = np.bincount(owner, minlength=len(offsets) - 1)
    windows = np.maximum(words - LENGTH + 1, 0)
    first = np.cumsum(words) - words
    own = np.repeat(np.arange(len(words)), windows)
    at = np.arange(len(own)) - np.repeat(np.cumsum(windows) - windows, windows) + first[own]
    if not len(at):
        return none, none, none, none, none.astype(bool)
    key = code[left[at]].view(np.int64)
    within = at - first[own]
    # A run also ends after PIECE windows; the next piece has the same key.
    changes = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (own[1:] != own[:-1])])
    run = np.arange(len(at)) - np.repeat(changes, np.diff(np.r_[changes, len(at)]))
    fresh = np.flatnonzero(run % PIECE == 0)
    last = np.r_[fresh[1:], len(at)] - 1
    return own[fresh], within[fresh], last - fresh + 1, key[fresh], left[at[fresh]] != right[at[last]]


def _count_keys(gram: int):
    def count(batches):
        for batch in batches:
            for part in chunks(batch, limit=SLICE_BYTES):
                own, _, _, key, inside = keyed_runs(*text_bytes(part.column("text")), gram)
                if len(key):
                    many = np.asarray(part.column("weight"))[own] * (1 + inside)
                    codes, at = np.unique(key, return_inverse=True)
                    yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(np.bincount(at, many).astype(np.int64))],
                                                     names=["key", "n"])
    return count


def _told(word: bytes) -> bytes:
    """A word as it stands in pieces; no word holds a tab."""
    return word if len(word) <= LONG_WORD else b"\t" + hashlib.sha256(word).digest().hex().encode()


_PIECES = "key long, doc long, hash long, start int, many int, digest binary, text binary"


def _cut_pieces(repeated: np.ndarray, gram: int):
    def cut(batches):
        for batch in batches:
            for part in chunks(batch, limit=SLICE_BYTES):
                data, offsets = text_bytes(part.column("text"))
                own, start, windows, key, _ = keyed_runs(data, offsets, gram)
                take = _in_bitmap(repeated, key)
                own, start, windows, key = own[take], start[take], windows[take], key[take]
                if not len(own):
                    continue
                words, texts, of = [], [], -1
                for o, s, n in zip(own.tolist(), start.tolist(), (windows + LENGTH - 1).tolist()):
                    if o != of:
                        words, of = [_told(w) for w in data[offsets[o]:offsets[o + 1]].tobytes().split()], o
                    texts.append(b" ".join(words[s:s + n]))
                base, weight = (np.asarray(part.column(c))[own] for c in ("start", "weight"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), part.column("doc").take(pa.array(own)), part.column("hash").take(pa.array(own)),
                     pa.array((base + start).astype(np.int32)), pa.array(weight.astype(np.int32)),
                     pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()), pa.array(texts, pa.binary())],
                    names=["key", "doc", "hash", "start", "many", "digest", "text"])
    return cut


class Automaton:
    """Suffix automaton of several word sequences; ``count`` of a state is the weight of its ends."""

    def __init__(self):
        self.step, self.link, self.length, self.count = [{}], [-1], [0], [0]

    def _split(self, state: int, symbol: int, to: int) -> int:
        """A state for the longest run of ``state`` and the symbol, which ``to`` holds among longer ones."""
        step, link, length = self.step, self.link, self.length
        copy = len(link)
        step.append(step[to].copy())
        link.append(link[to])
        length.append(length[state] + 1)
        self.count.append(0)
        link[to] = copy
        while state >= 0 and step[state].get(symbol) == to:
            step[state][symbol] = copy
            state = link[state]
        return copy

    def add(self, symbols: list[int], weight: int) -> None:
        step, link, length, count = self.step, self.link, self.length, self.count
        last = 0
        for symbol in symbols:
            to = step[last].get(symbol)
            if to is None:
                fresh, state = len(link), last
                step.append({})
                link.append(0)
                length.append(length[last] + 1)
                count.append(0)
                while state >= 0:
                    to = step[state].get(symbol)
                    if to is not None:
                        link[fresh] = to if length[to] == length[state] + 1 else self._split(state, symbol, to)
                        break
                    step[state][symbol] = fresh
                    state = link[state]
                last = fresh
            elif length[to] == length[last] + 1:
                last = to
            else:
                last = self._split(last, symbol, to)
            count[last] += weight

    def settle(self) -> None:
        """Counts of all states from those of the ends; to be called once, after all texts."""
        link, count = self.link, self.count
        for state in np.argsort(self.length, kind="stable")[:0:-1].tolist():
            count[link[state]] += count[state]

    def spans(self, symbols: list[int], least: int = LENGTH) -> list[tuple[int, int]]:
        """Maximal spans of ``symbols`` covered by runs of ``least`` or more that occur at least twice."""
        step, link, length, count = self.step, self.link, self.length, self.count
        out: list[tuple[int, int]] = []
        state = run = begin = 0
        end = -1
        for i, symbol in enumerate(symbols):
            to = step[state].get(symbol)
            while (to is None or count[to] < 2) and state:
                state = link[state]
                run = length[state]
                to = step[state].get(symbol)
            if to is None or count[to] < 2:
                run = 0
                continue
            state = to
            run += 1
            if run >= least:
                if i - run >= end:
                    if end >= 0:
                        out.append((begin, end))
                    begin = i - run + 1
                end = i + 1
        if end >= 0:
            out.append((begin, end))
        return out


_FOUND = "deal long, digest binary, n long, spans array<struct<b:bigint,e:bigint>>"


def _stream(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Spans of a shard's texts under the automaton of its reference texts."""
    ids: dict[bytes, int] = {}
    texts = [[ids.setdefault(w, len(ids)) for w in t.split(b" ")] for t in table.column("text").to_pylist()]
    machine = Automaton()
    for symbols, weight in zip(texts, table.column("weight").to_pylist()):
        if weight:
            machine.add(symbols, weight)
    machine.settle()
    spans = [machine.spans(symbols) if n else [] for symbols, n in zip(texts, table.column("n").to_pylist())]
    told = [i for i, s in enumerate(spans) if s]
    some = table.select(["deal", "digest", "n"]).take(pa.array(told, pa.int64()))
    return some.append_column("spans", pa.array([[{"b": b, "e": e} for b, e in spans[i]] for i in told],
                                                pa.list_(pa.struct([("b", pa.int64()), ("e", pa.int64())]))))


def _routed(source: DataFrame, scratch: list) -> tuple[DataFrame, DataFrame]:
    """Places of pieces (deal, digest, doc, hash, start) and their different texts (deal, digest,
    text, weight, n), n the number of places in documents."""
    places, texts, level = [], [], source
    for depth, gram in enumerate(GRAMS):
        keys = (level.select("text", "weight").mapInArrow(_count_keys(gram), "key long, n long")
                .groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key"))
        found = materialize(level.mapInArrow(_cut_pieces(_bitmap(keys), gram), _PIECES), "pieces")
        known = materialize(found.groupBy("key", "digest", "text").agg(F.sum("many").alias("weight"), F.count("doc").alias("n")), "texts")
        # One key at most for SHARD_BYTES of different texts.
        crowded = materialize(known.groupBy("key").agg(F.count("*").alias("texts"), F.sum(F.length("text")).alias("bytes"))
                              .where(f"texts > 1 and bytes > {SHARD_BYTES}").select("key"), "crowded")
        scratch += [found, known, crowded]
        last = gram == GRAMS[-1] or crowded.isEmpty()
        deal = F.xxhash64(F.lit(depth), "key").alias("deal")
        calm = [t if last else t.join(crowded, "key", "left_anti") for t in (found, known)]
        places.append(calm[0].where("doc is not null").select(deal, "digest", "doc", "hash", "start"))
        texts.append(calm[1].select(deal, "digest", "text", "weight", "n"))
        if last:
            break
        level = found.join(crowded, "key", "left_semi").select("doc", "hash", "start", "text", F.col("many").alias("weight"))
    for more in (places, texts):
        while len(more) > 1:
            more.append(more.pop(0).unionByName(more.pop(0)))
    return places[0], texts[0]


def repeated_spans(docs: DataFrame, reference: DataFrame | None = None, scratch: list | None = None) -> DataFrame:
    """Rows (doc, hash, spans) of documents (doc, hash, text): spans of words to remove, which may
    overlap, one row for each place with some. ``scratch`` is given the stored tables that the rows
    are made from, to be released once these are stored."""
    scratch = [] if scratch is None else scratch
    weight = F.lit(1 if reference is None else 0)
    source = docs.select("doc", "hash", F.lit(0).alias("start"), "text", weight.alias("weight"))
    if reference is not None:
        source = source.unionByName(documents(reference, "text").select(
            F.lit(None).cast("long").alias("doc"), F.lit(None).cast("long").alias("hash"), F.lit(0).alias("start"), "text", F.lit(2).alias("weight")))
    places, texts = _routed(source, scratch)
    size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    shard = F.pmod("deal", F.lit(max(1, -(-size // SHARD_BYTES)))).cast("int").alias("shard")
    found = materialize(texts.select(shard, "*").groupBy("shard").applyInArrow(_stream, _FOUND), "found")
    scratch.append(found)
    # A text with many places is one row of a table with at most one row for COPIES places.
    hot = materialize(found.where(F.col("n") >= COPIES).select("deal", "digest", "spans"), "hot")
    scratch.append(hot)
    by = ["deal", "digest"]
    rare = places.join(hot.select(*by), by, "left_anti").join(found.where(F.col("n") < COPIES).select(*by, "spans"), by)
    moved = F.transform("spans", lambda s: F.struct((s["b"] + F.col("start")).alias("b"), (s["e"] + F.col("start")).alias("e")))
    return rare.unionByName(places.join(hot, by)).select("doc", "hash", moved.alias("spans"))


def _slices(batches):
    """Pieces of the batches that hold about SLICE_BYTES of text."""
    for batch in batches:
        yield from chunks(batch, limit=SLICE_BYTES)


def _digest(batches):
    for batch in _slices(batches):
        out: list[tuple] = []
        for text, spans in zip(batch.column("text").to_pylist(), _pairs(batch.column("spans"))):
            words = (text or "").encode().split()
            n, gone = len(words), _joined(spans)
            for begin, end in reversed(gone):
                del words[begin:end]
            out.append((n, n - len(words), len(gone), hashlib.sha256(b" ".join(words)).hexdigest()))
        columns = list(zip(*out)) or [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[3], pa.string()),
             pa.array(columns[2], pa.int64())], names=["doc_id", "n_words", "n_removed", "kept_sha256", "n_spans"])


def _kept_words(batches):
    for batch in _slices(batches):
        texts = []
        for text, spans in zip(batch.column("text").to_pylist(), _pairs(batch.column("spans"))):
            words = (text or "").encode().split()
            for begin, end in reversed(_joined(spans)):
                del words[begin:end]
            texts.append(b" ".join(words).decode())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])


def _with_spans(docs: DataFrame, reference: DataFrame | None) -> tuple[DataFrame, str]:
    """Rows (doc_id, text, spans) and the type of doc_id; only texts that may have spans are shuffled."""
    order = _identified(docs)
    scratch: list = []
    spans = materialize(repeated_spans(order, reference, scratch).groupBy("doc", "hash").agg(
        F.flatten(F.collect_list("spans")).alias("spans")), "word-spans")
    release(*scratch)
    free, rest = _split(order, spans, ["doc_id", "text"])
    none = free.select("*", F.expr("CAST(null AS array<struct<b:bigint,e:bigint>>)").alias("spans"))
    return none, rest, dict(free.dtypes)["doc_id"]


def remove_repeats(docs: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, n_spans."""
    free, rest, kind = _with_spans(docs, reference)
    schema = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, n_spans long"
    return free.mapInArrow(_digest, schema).unionByName(rest.mapInArrow(_digest, schema))


def cut_texts(docs: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id and the kept words, joined by one space."""
    free, rest, kind = _with_spans(docs, reference)
    schema = f"doc_id {kind}, text string"
    return free.mapInArrow(_kept_words, schema).unionByName(rest.mapInArrow(_kept_words, schema))


def sql() -> str:
    """The same rows in DuckDB: all windows as texts, counted."""
    return f"""WITH words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS MATERIALIZED (
  SELECT doc_id, i, array_to_string(w[i : i + {LENGTH - 1}], ' ') AS t
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {LENGTH - 2})) AS i FROM words WHERE len(w) >= {LENGTH})),
starts AS (SELECT doc_id, i FROM windows WHERE t IN (SELECT t FROM windows GROUP BY t HAVING count(*) > 1)),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM starts, (SELECT unnest(range({LENGTH})) AS j)),
each_word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n FROM each_word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
spans AS (SELECT doc_id, count(*) AS n FROM gone g ANTI JOIN gone b ON b.doc_id = g.doc_id AND b.i = g.i - 1 GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.t, '')) AS kept_sha256, CAST(coalesce(s.n, 0) AS BIGINT) AS n_spans
FROM words d LEFT JOIN kept k ON k.doc_id = d.doc_id LEFT JOIN spans s ON s.doc_id = d.doc_id"""
