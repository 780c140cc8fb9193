"""Near-duplicate documents by DartMinHash signatures, banded joining and exact verification.

A document is its multiset of five-word shingles; two documents are linked when the weighted
Jaccard similarity (sum of least over sum of greatest counts) is at least 0.8. Classes are the
connected components of the links.

DartMinHash: every unit of an element's weight throws darts, hashed Poisson points with a rank
and a coordinate, into cells of the rank axis. A document only looks at the lowest cells that
its total weight needs to fill all coordinates, and keeps the earliest dart per coordinate. So a
signature costs time linear in the document plus k log k, and equal coordinates occur with the
weighted Jaccard similarity. Cells do not depend on the document, so signatures are comparable.

Search, without pairs of all members of a bucket:

1. Exact copies are collapsed by digest (combined map-side), signatures cut into bands.
2. In each bucket the member that shares most buckets overall is the pivot; every member is
   verified against it by the exact similarity, and links are joined to components.
3. Buckets that still hold several components are finished exactly: their members, less those
   that the triangle inequality through the pivot excludes, are compared across components in
   blocks of bounded size that return a spanning set of links.

Two documents of similarity 0.8 share no band with probability (1 - 0.8^4)^32 < 1e-7.

Defined results: fewer than five words form one shingle; null texts, texts without a word and
rows with a null doc_id are a class of their own; a class is named by its least doc_id; rows
that repeat a doc_id are rows of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import MIX, ODD, chunks, documents, lowered, materialize, word_keys
from attrition.llm.components import components

SHINGLE = 5
COORDINATES = 128
ROWS = 4
BANDS = COORDINATES // ROWS
#: Similarity as a fraction, so that the comparison is exact in whole numbers.
SIMILAR = (4, 5)
LOWEST = -12
BLOCK = 512


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def elements(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(element, owner): one id per unit of shingle weight, i.e. (shingle, how manieth), sorted by owner."""
    low, offsets = lowered(part)
    key, owner = word_keys(low, offsets)
    key = key.view(np.uint64)
    rows = len(offsets) - 1
    if not len(key):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    count = np.bincount(owner, minlength=rows)
    start = np.cumsum(count) - count
    at = np.flatnonzero((np.arange(len(key)) - start[owner] <= np.maximum(count[owner] - SHINGLE, 0)))
    shingle = np.zeros(len(at), np.uint64)
    for k in range(SHINGLE):
        place = at + k
        inside = place < (start + count)[owner[at]]
        word = np.where(inside, key[np.minimum(place, len(key) - 1)], np.uint64(0))
        shingle = _mixed(shingle * np.uint64(ODD) + word + np.uint64(1))
    holder = owner[at]
    order = np.lexsort((shingle, holder))
    shingle, holder = shingle[order], holder[order]
    fresh = np.r_[True, (shingle[1:] != shingle[:-1]) | (holder[1:] != holder[:-1])]
    first = np.flatnonzero(fresh)
    nth = np.arange(len(shingle)) - np.repeat(first, np.diff(np.r_[first, len(shingle)]))
    return _mixed(shingle + np.uint64(ODD) * nth.astype(np.uint64)), holder


def _poisson_steps(mean: float) -> np.ndarray:
    """Cumulative probabilities of a Poisson count, until all but 1e-12."""
    p, total, out = np.exp(-mean), 0.0, []
    for n in range(60):
        total += p
        out.append(total)
        if 1 - total < 1e-12:
            break
        p *= mean / (n + 1)
    return np.array(out)


def signatures(element: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """Least dart rank per coordinate (rows x COORDINATES); infinite for a row without elements."""
    out = np.full(rows * COORDINATES, np.inf)
    weight = np.bincount(owner, minlength=rows)
    open_ = weight > 0
    need = COORDINATES * (np.log(COORDINATES) + 2) / np.maximum(weight, 1)
    low, width, layer = 0.0, 2.0 ** LOWEST, 0
    own, mine = element, owner
    while len(own):
        # One layer [low, low + width), in cells of at most unit width so that counts stay small.
        cells = max(1, int(width))
        steps = _poisson_steps(width / cells)
        # Long layers are needed by light documents only, which have few elements.
        for cell in range(cells):
            seed = _mixed(own + np.uint64((ODD * (layer * (1 << 40) + cell + 1)) & ((1 << 64) - 1)))
            times = np.searchsorted(steps, (seed >> np.uint64(11)).astype(np.float64) / (1 << 53), side="right")
            hit = np.flatnonzero(times)
            nth = 0
            while len(hit):
                dart = _mixed(seed[hit] + np.uint64(ODD * (nth + 1) & ((1 << 64) - 1)))
                rank = low + width / cells * (cell + (dart >> np.uint64(11)).astype(np.float64) / (1 << 53))
                coordinate = (_mixed(dart + np.uint64(ODD)) >> np.uint64(57)).astype(np.int64)
                np.minimum.at(out, mine[hit] * COORDINATES + coordinate, rank)
                nth += 1
                hit = hit[times[hit] > nth]
        low, width, layer = low + width, max(width, low + width) if layer else width, layer + 1
        full = np.isfinite(out.reshape(rows, COORDINATES)).all(1)
        open_ &= ~((low >= need) & full)
        stay = open_[mine]
        own, mine = own[stay], mine[stay]
    return out.reshape(rows, COORDINATES)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """BANDS hashes of ROWS coordinates each."""
    bits = np.ascontiguousarray(signature).view(np.uint64).reshape(len(signature), BANDS, ROWS)
    key = np.zeros(bits.shape[:2], np.uint64)
    for k in range(ROWS):
        key = _mixed(key * np.uint64(ODD) + bits[:, :, k])
    return key.view(np.int64)


def _sketch(batches):
    for batch in batches:
        for part in chunks(batch):
            element, owner = elements(part)
            bands = band_keys(signatures(element, owner, part.num_rows))
            worded = np.bincount(owner, minlength=part.num_rows) > 0
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("digest"),
                 pa.array([b if w else None for b, w in zip(bands, worded)], pa.list_(pa.int64()))],
                names=["doc_id", "digest", "bands"])


def _sets(batches):
    for batch in batches:
        for part in chunks(batch):
            element, owner = elements(part)
            cut = np.searchsorted(owner, np.arange(part.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [part.column("rep"), pa.array([np.sort(element[cut[i]:cut[i + 1]].view(np.int64))
                                               for i in range(part.num_rows)], pa.list_(pa.int64()))],
                names=["rep", "items"])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with ``both`` and ``either``: sizes of intersection and union."""
    one = sets.select(F.col("rep").alias("a"), F.col("items").alias("x"))
    two = sets.select(F.col("rep").alias("b"), F.col("items").alias("y"))
    met = pairs.join(one, "a").join(two, "b").select(
        "a", "b", F.size(F.array_intersect("x", "y")).alias("both"), (F.size("x") + F.size("y")).alias("sum"))
    return met.select("a", "b", "both", (F.col("sum") - F.col("both")).alias("either"))


def _similar(both, either):
    return both * SIMILAR[1] >= either * SIMILAR[0]


def _cross_links(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Spanning links between components within one pair of blocks."""
    rep = np.asarray(table.column("rep"))
    _, label = np.unique(np.asarray(table.column("label")), return_inverse=True)
    lists = table.column("items").combine_chunks()
    bound = np.asarray(lists.offsets).astype(np.int64)
    items = np.asarray(lists.values)
    holder = np.repeat(np.arange(len(rep)), np.diff(bound))
    items = items[bound[0]:bound[-1]]
    order = np.argsort(items, kind="stable")
    value, held = items[order], holder[order]
    size = np.diff(bound)
    bound = bound - bound[0]
    found: list[tuple[int, int]] = []
    largest = np.bincount(label).argmax()
    for i in np.flatnonzero(label != largest):
        mine = items[bound[i]:bound[i + 1]]
        start, end = np.searchsorted(value, mine), np.searchsorted(value, mine, side="right")
        total = end - start
        where = np.repeat(start - np.r_[0, np.cumsum(total)[:-1]], total) + np.arange(total.sum())
        both = np.bincount(held[where], minlength=len(rep))
        near = np.flatnonzero(_similar(both, size + size[i] - both) & (label != label[i]))
        for j in near:
            if label[j] != label[i]:
                found.append((rep[i], rep[j]))
                label[label == label[j]] = label[i]
    return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, digest of the text, bands (null for texts without a word); stored."""
    narrow = documents(docs, "doc_id", "text").select(
        "doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest"), "text")
    kind = dict(narrow.dtypes)["doc_id"]
    return materialize(narrow.mapInArrow(_sketch, f"doc_id {kind}, digest string, bands array<long>"), "sketch")


def classes(docs: DataFrame, sketched: DataFrame) -> DataFrame:
    """Distinct texts with a word: digest, class_id."""
    texts = materialize(
        sketched.where(F.col("bands").isNotNull()).groupBy("digest")
        .agg(F.min("doc_id").alias("rep"), F.any_value("bands").alias("bands")).where(F.col("rep").isNotNull()), "texts")
    banded = texts.select("rep", F.posexplode("bands").alias("band", "key"))
    shared = banded.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    spots = materialize(banded.join(shared, ["band", "key"]), "spots")
    weight = spots.groupBy("rep").agg(F.sum("n").alias("weight"))
    pivots = materialize(spots.join(weight, "rep").groupBy("band", "key")
                         .agg(F.max(F.struct("weight", (-F.col("rep")).alias("minus"))).alias("top"))
                         .select("band", "key", (-F.col("top.minus")).alias("pivot")), "pivots")
    starred = materialize(spots.join(pivots, ["band", "key"]).select("band", "key", "rep", "pivot"), "starred")
    pairs = starred.where("rep <> pivot").select(F.col("rep").alias("a"), F.col("pivot").alias("b")).distinct()
    candidates = weight.select("rep", F.col("rep").alias("doc_id"))
    chosen = texts.select("rep", F.col("rep").alias("doc_id"), "digest").join(candidates.select("rep"), "rep", "left_semi")
    text = documents(docs, "doc_id", "text")
    sets = materialize(
        text.join(chosen, "doc_id").where(F.md5(F.coalesce("text", F.lit("")).cast("binary")) == F.col("digest"))
        .select("rep", "text").mapInArrow(_sets, "rep long, items array<long>").dropDuplicates(["rep"]), "sets")
    tested = materialize(_verified(pairs, sets), "tested")
    links = tested.where(_similar(F.col("both"), F.col("either"))).select("a", "b")
    first = materialize(components(links), "components")
    # What is left: buckets whose members are in several components.
    labelled = (starred.join(first.withColumnRenamed("node", "rep"), "rep", "left")
                .withColumn("label", F.coalesce("component", "rep")).drop("component"))
    away = tested.select(F.col("a").alias("rep"), F.col("b").alias("pivot"),
                         (1 - F.col("both") / F.col("either")).alias("away"))
    labelled = materialize(labelled.join(away, ["rep", "pivot"], "left")
                           .withColumn("away", F.coalesce("away", F.lit(0.0))), "labelled")
    pivot_label = labelled.where("rep = pivot").select("band", "key", F.col("label").alias("pivot_label"))
    placed = labelled.join(pivot_label, ["band", "key"])
    stray = F.when(F.col("label") != F.col("pivot_label"), F.col("away"))
    open_ = (placed.groupBy("band", "key").agg(
        F.min(stray).alias("nearest"), F.min("label").alias("low"), F.max("label").alias("high"),
        F.count("*").alias("n"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("print"))
        .where("low < high").groupBy("n", "print").agg(F.min(F.struct("band", "key", "nearest")).alias("one"))
        .select("one.*"))
    limit = 1 - SIMILAR[0] / SIMILAR[1] + 1e-9
    rest = (placed.join(open_, ["band", "key"])
            .where((F.col("label") != F.col("pivot_label")) | (F.col("away") >= F.col("nearest") - limit))
            .select("band", "key", "rep", "label"))
    rest = materialize(rest, "rest")
    blocks = rest.groupBy("band", "key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = (rest.join(blocks, ["band", "key"])
             .withColumn("block", F.pmod(F.xxhash64(F.lit(41), "rep"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("one", F.least("block", "other")).withColumn("two", F.greatest("block", "other"))
             .join(sets, "rep").select("band", "key", "one", "two", "rep", "label", "items"))
    more = materialize(dealt.groupBy("band", "key", "one", "two").applyInArrow(_cross_links, "a long, b long"), "more")
    final = first if more.isEmpty() else components(first.select(F.col("node").alias("a"), F.col("component").alias("b"))
                                                    .unionByName(more))
    return texts.join(final, F.col("rep") == F.col("node"), "left").select(
        "digest", F.coalesce("component", "rep").alias("class_id"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id (least doc_id of its class), kept."""
    sketched = sketches(docs)
    found = classes(docs, sketched)
    out = sketched.select("doc_id", "digest", F.col("bands").isNotNull().alias("worded")).join(found, "digest", "left")
    named = F.when(F.col("worded") & F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", named.alias("class_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """Pipeline form: one document of each class, all columns; copies under one doc_id leave one row."""
    sketched = sketches(docs)
    found = classes(docs, sketched)
    told = materialize(sketched.where("bands is not null and doc_id is not null").select("doc_id", "digest")
                       .join(found, "digest"), "told")
    gone = told.where("doc_id <> class_id").select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest")).distinct()
    twice = told.groupBy("doc_id", "digest").count().where("count > 1").select(
        F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"))
    digest = F.md5(F.coalesce(docs["text"], F.lit("")).cast("binary"))
    same = (docs["doc_id"] == F.col("__id")) & (digest == F.col("__digest"))
    kept = docs.join(gone, same, "left_anti")
    if twice.isEmpty():
        return kept
    repeated = materialize(twice, "twice")
    return kept.join(repeated, same, "left_anti").unionByName(
        kept.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"]))
