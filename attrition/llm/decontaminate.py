"""Benchmark decontamination by spaced-seed hashing.

A mask names the token positions of a window that count; the others may differ. Every window of
every benchmark item and of every document is hashed under each mask, and equal hashes are
joined. The masks are chosen by enumeration so that wherever up to ``SUBSTITUTIONS`` tokens differ,
one of them fits between: no pair that is to be reported is missed. A hit fixes an alignment of
document and item; on it the item's tokens are compared one by one, and the pair is reported when
some ``WINDOW`` aligned tokens in a row hold at most ``SUBSTITUTIONS`` differences (an item shorter
than that is compared as a whole). An item of fewer than ``SPAN`` tokens must occur as it is: its
mask is all of it. Tokens are runs of letters and digits; of scripts written without spaces, every
character is a token.

DataFrame functions alone. The benchmark side is broadcast only after its hashes were counted
and found to be at most ``BROADCAST_ROWS``; beyond that the planner joins hashes by shuffle, without
the texts, which are fetched for the hits. Hits are collapsed to one row per (document, item,
alignment) before any shuffle.

Defined results: null or empty texts and documents shorter than a mask have no hit, and items
without a token are in no document; either table may be empty and gives no rows. Documents are told
apart by doc_id and text; repeated rows give one result row, and so do repeated items. Of several
alignments of a pair the one with most equal tokens is returned, ties to the longer one. Texts of
any length are read whole. Only doc_id, item_id and text are read, so other columns cannot clash.
Only contaminated (document, item) pairs are returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import documents, materialize

#: Positions that count, one tuple per mask: every 3 differences in WINDOW tokens leave one of these
#: whole somewhere; for items of SPAN to WINDOW - 1 tokens, every 3 in SPAN tokens one of those.
SEEDS = ((0, 1, 3, 5, 6, 7), (0, 1, 2, 5, 8, 9), (0, 1, 2, 3, 4, 5), (0, 1, 4, 6, 9, 10), (0, 1, 3, 4, 8, 9),
         (0, 1, 6, 7, 9, 11))
SHORT_SEEDS = ((0, 1, 3, 4), (0, 1, 5, 6), (0, 1, 2, 3), (0, 2, 4, 8), (0, 1, 7, 8))
#: Fewest tokens of an item in which substitutions are allowed, and first number of the masks of those below.
SPAN = 9
WHOLE = 100
WINDOW = 13
SUBSTITUTIONS = 3
BROADCAST_ROWS = 1_000_000


#: Scripts written without spaces between words.
UNSPACED = ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits; characters of unspaced scripts one by one."""
    scripts = "".join(rf"\p{{Is{s}}}" for s in UNSPACED)
    apart = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), f"([{scripts}])", " $1 ")
    return F.array_remove(F.split(apart, r"[^\p{L}\p{N}]+"), "")


def _windows(frame: DataFrame, masks: dict[int, tuple[int, ...]]) -> DataFrame:
    """One row per window and mask that fits: ``at`` and ``seed``; ``frame`` has ``words``."""
    last = F.size("words") - 1 - min(mask[-1] for mask in masks.values())
    starts = F.when(last >= 0, F.sequence(F.lit(0), last))
    frame = frame.withColumn("at", F.explode(starts))
    seeds = [F.when(F.col("at") + mask[-1] < F.size("words"),
                    F.xxhash64(F.lit(n), *[F.get("words", F.col("at") + o) for o in mask]))
             for n, mask in masks.items()]
    return frame.withColumn("seed", F.explode(F.array(*seeds))).where("seed is not null")


def _best_run(equal: Column) -> Column:
    """Most equal tokens in any WINDOW aligned tokens in a row."""
    size = F.least(F.size(equal), F.lit(WINDOW))
    starts = F.sequence(F.lit(1), F.size(equal) - size + 1)
    return F.array_max(F.transform(starts, lambda s: F.size(F.filter(F.slice(equal, s, size), lambda x: x))))


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Contaminated pairs: doc_id, item_id, n_equal, n_aligned, best_run, item_words."""
    items = materialize(documents(benchmark, "item_id", "text").select("item_id", words(F.col("text")).alias("words"))
                        .where(F.size("words") > 0).distinct(), "items")
    size = F.size("words")
    # Lengths below WINDOW that the benchmark has: a dozen at most.
    lengths = {r[0] for r in items.where(size < WINDOW).select(size).distinct().collect()}
    masks = dict(enumerate(SEEDS))
    windows = _windows(items.where(size >= WINDOW), masks)
    if any(n >= SPAN for n in lengths):
        short = dict(enumerate(SHORT_SEEDS, len(SEEDS)))
        windows = windows.unionByName(_windows(items.where((size >= SPAN) & (size < WINDOW)), short))
        masks |= short
    for n in sorted(n for n in lengths if n < SPAN):
        whole = {WHOLE + n: tuple(range(n))}
        windows = windows.unionByName(_windows(items.where(size == n), whole))
        masks |= whole
    seeds = materialize(windows.select("seed", "item_id", F.col("at").alias("item_at"), "words")
                        .withColumn("n_item", F.size("words"))
                        .withColumn("item_key", F.xxhash64("item_id", "words")).drop("words").distinct(), "seeds")
    small = seeds.count() <= BROADCAST_ROWS
    bound = F.broadcast if small else (lambda x: x)
    texts = documents(docs, "doc_id", "text").select(
        "doc_id", F.xxhash64("text").alias("text_key"), words(F.col("text")).alias("words"))
    off = F.col("at") - F.col("item_at")
    first = F.greatest(F.col("off"), F.lit(0))
    length = F.least(F.col("n_item") - F.greatest(-F.col("off"), F.lit(0)), F.size("words") - first)
    part = F.slice("words", first + 1, length).alias("part")
    pair = ["doc_id", "text_key", "item_id", "item_key", "off"]
    if small:
        hits = _windows(texts, masks).join(bound(seeds), "seed").withColumn("off", off)
        aligned = hits.select(*pair, part).groupBy(*pair).agg(F.first("part").alias("part"))
    else:
        narrow = _windows(texts, masks).select("doc_id", "text_key", "at", "seed")
        hits = materialize(narrow.join(seeds, "seed").select("doc_id", "text_key", "item_id", "item_key", "n_item", off.alias("off")).distinct(), "hits")
        own = texts.withColumnsRenamed({"doc_id": "own_id", "text_key": "own_key"}).dropDuplicates(["own_id", "own_key"])
        aligned = (hits.join(own, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_key") == F.col("own_key")))
                   .select(*pair, part))
    whole = items.select(F.xxhash64("item_id", "words").alias("item_key"), F.col("words").alias("item"))
    item_part = F.slice("item", F.greatest(-F.col("off"), F.lit(0)) + 1, F.size("part"))
    judged = (aligned.join(bound(whole), "item_key")
              .withColumn("equal", F.zip_with("part", item_part, lambda a, b: a == b))
              .withColumn("best_run", _best_run(F.col("equal")))
              .where(F.col("best_run") >= F.least(F.size("equal"), F.lit(WINDOW)) - F.when(F.size("item") < SPAN, 0).otherwise(SUBSTITUTIONS))
              .where((F.size("equal") >= WINDOW) | (F.size("equal") == F.size("item"))))
    best = F.max(F.struct(F.size(F.filter("equal", lambda x: x)).alias("n_equal"),
                          F.size("equal").alias("n_aligned"), "best_run",
                          F.size("item").alias("item_words"))).alias("best")
    return judged.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pipeline form: documents without any overlap, all columns."""
    found = materialize(overlaps(docs, benchmark).select(F.col("doc_id").alias("__found")).distinct(), "leaks")
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col("__found")), "left_anti")


def sql(docs: str = "documents", benchmark: str = "benchmark") -> str:
    """The same pairs in DuckDB SQL, without seeds: every alignment on which enough tokens are equal."""
    scripts = "".join(rf"\p{{{s}}}" for s in UNSPACED)
    words_ = (f"list_filter(string_split_regex(regexp_replace(lower(coalesce(text, '')), '([{scripts}])', ' \\1 ', 'g'), "
              "'[^\\p{L}\\p{N}]+'), lambda x: x <> '')")
    allowed = lambda n: f"CASE WHEN {n} < {SPAN} THEN 0 ELSE {SUBSTITUTIONS} END"
    return f"""
WITH items AS MATERIALIZED (SELECT *, row_number() OVER () AS item FROM (SELECT DISTINCT item_id, {words_} AS words FROM {benchmark})
    WHERE len(words) > 0),
  texts AS MATERIALIZED (SELECT *, row_number() OVER () AS doc FROM (SELECT DISTINCT doc_id, text, {words_} AS words FROM {docs})),
  doc_tokens AS (SELECT doc, unnest(words) AS token, unnest(range(len(words))) AS pos FROM texts),
  item_tokens AS (SELECT item, len(words) AS n, unnest(words) AS token, unnest(range(len(words))) AS item_pos FROM items),
  hits AS (SELECT doc, item, pos - item_pos AS off FROM doc_tokens JOIN item_tokens USING (token) GROUP BY doc, item, pos - item_pos, n
           HAVING count(*) >= least(n, {WINDOW}) - {allowed('n')}),
  cut AS (SELECT doc_id, item_id, t.words AS dw, i.words AS iw, greatest(off, 0) AS d0, greatest(-off, 0) AS i0,
          least(len(i.words) - greatest(-off, 0), len(t.words) - greatest(off, 0)) AS n FROM hits JOIN texts t USING (doc) JOIN items i USING (item)),
  equal AS (SELECT doc_id, item_id, len(iw) AS item_words, n AS n_aligned,
            list_transform(range(0, n), lambda k: CAST(dw[d0 + k + 1] = iw[i0 + k + 1] AS INTEGER)) AS eq FROM cut),
  judged AS (SELECT *, list_sum(eq) AS n_equal, list_max(list_transform(range(0, n_aligned - least(n_aligned, {WINDOW}) + 1),
             lambda s: list_sum(eq[s + 1:s + least(n_aligned, {WINDOW})]))) AS best_run FROM equal),
  good AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id
             ORDER BY n_equal DESC, n_aligned DESC, best_run DESC, item_words DESC) AS place FROM judged
           WHERE best_run >= least(n_aligned, {WINDOW}) - {allowed('item_words')} AND (n_aligned >= {WINDOW} OR n_aligned = item_words))
SELECT doc_id, item_id, CAST(n_equal AS INTEGER) AS n_equal, CAST(n_aligned AS INTEGER) AS n_aligned,
       CAST(best_run AS INTEGER) AS best_run, CAST(item_words AS INTEGER) AS item_words FROM good WHERE place = 1"""
