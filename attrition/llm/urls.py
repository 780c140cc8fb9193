"""URL verdicts: longest matching rule, else naive Bayes over segmented host and path words.

Words of the page texts give a unigram dictionary. Concatenated host and path names are split
into its words by the Viterbi path of highest unigram probability. URLs that a rule decides are
the training rows of a multinomial naive Bayes over the tokens; it judges the others.

Defined results: a null url or one without ``://`` has empty host and path, fits no rule and is
judged by the prior alone; without any training row the verdict is ``allow`` with p_block 0.5;
equal odds mean ``allow``. Repeated rows are judged one by one.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import documents, materialize

# The rules as (rule, verdict).
RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
         ("com/fr/", "allow"), ("com/de/", "block")]

#: Longest word, and strings that a task holds before it passes them on.
LONGEST = 24
HELD = 200_000
_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    found = F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(found, *_LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host_: Column, path_: Column, rules) -> Column:
    """The longest rule whose host is this host or a parent domain and whose path is a prefix."""
    cases = []
    for rule, _ in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        domain, _, tail = rule.partition("/")
        cases.append(F.when(((host_ == domain) | host_.endswith("." + domain))
                            & path_.startswith("/" + tail), F.lit(rule)))
    return F.coalesce(*cases)


def _words(pages: DataFrame) -> DataFrame:
    """Counts of all a-z words in all page texts outside of tags."""
    plain = F.translate(F.regexp_replace(F.col("html"), r"<[^>]*>", " "), *_LOWER)
    return (pages.select(F.explode(F.split(plain, r"[^a-z]+")).alias("word"))
            .where(F.length("word").between(1, LONGEST)).groupBy("word").count())


def unigrams(pages: DataFrame) -> dict[str, int]:
    """All words of ``pages`` and their counts."""
    return {r["word"]: r["count"] for r in _words(pages).collect()}


def _inside(batches):
    """Strings of up to LONGEST letters inside the a-z runs of hosts and paths."""
    runs: set[str] = set()
    found: set[str] = set()
    pack = lambda x: pa.RecordBatch.from_arrays([pa.array(list(x), pa.string())], names=["word"])
    for batch in batches:
        for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist()):
            for run in _RUNS.findall(h) + _RUNS.findall(p.lower()):
                if run in runs or not "a" <= run[0] <= "z":
                    continue
                runs.add(run)
                for start in range(len(run)):
                    found.update(run[start:end] for end in range(start + 1, min(len(run), start + LONGEST) + 1))
                    if len(found) > HELD:
                        yield pack(found)
                        found, runs = set(), set()
    yield pack(found)


def dictionary(pages: DataFrame, names: DataFrame) -> tuple[dict[str, int], int]:
    """Counts of the words that occur inside the hosts and paths of ``names``, which are all that a
    segmentation can use, and the number of words in all page texts."""
    words = materialize(_words(pages), "words")
    total = words.agg(F.sum("count")).first()[0] or 0
    used = words.join(names.select("host", "path").mapInArrow(_inside, "word string").distinct(), "word", "left_semi")
    return {r["word"]: r["count"] for r in used.collect()}, total


def segmenter(counts: dict[str, int], total: int | None = None):
    """Viterbi splitter of a-z runs; a character outside all words costs as a rare word. ``total`` is
    the number of words counted, if ``counts`` does not hold them all."""
    total = (sum(counts.values()) if total is None else total) + 1
    price = {w: math.log(total) - math.log(c) for w, c in counts.items()}
    unknown = math.log(total) + math.log(10)
    longest = max(map(len, price), default=1)

    @functools.lru_cache(maxsize=100_000)
    def split(run: str) -> tuple[str, ...]:
        best = [0.0] + [math.inf] * len(run)
        came = [0] * (len(run) + 1)
        for end in range(1, len(run) + 1):
            for start in range(max(0, end - longest), end):
                cost = price.get(run[start:end])
                if cost is None:
                    if end - start > 1:
                        continue
                    cost = unknown
                if best[start] + cost < best[end]:
                    best[end], came[end] = best[start] + cost, start
        words, end = [], len(run)
        while end:
            words.append(run[came[end]:end])
            end = came[end]
        return tuple(w if w in price else "?" for w in reversed(words))

    return split


_RUNS = re.compile(r"[a-z]+|[0-9]+|[^\x00-\x7f]+")


def tokens(host_: str, path_: str, split) -> list[str]:
    """Tokens of the host (``h:``) and the path (``p:``); digits by length up to 9."""
    out = []
    for side, text in (("h:", host_), ("p:", path_.lower())):
        for run in _RUNS.findall(text):
            if run[0].isascii():
                out += ([f"{side}#{min(len(run), 9)}"] if run[0].isdigit()
                        else [side + w for w in split(run)])
            else:
                out.append(side + "?")
    return out


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """Every page: page_id, host, path, rule, verdict, p_block.

    The dictionary holds every word of the page texts that occurs inside some host or path, whatever
    its count, and the naive Bayes vocabulary is made of its words. Scoring is map-only; names are split once per task and distinct run."""
    narrow = documents(pages, "page_id", "url")
    parts = narrow.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    parts = parts.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    words, total = dictionary(documents(pages, "html"), parts)
    verdict_of = dict(rules)

    def count(batches):
        split = segmenter(words, total)
        seen: dict[str, Counter] = {"allow": Counter(), "block": Counter()}
        for batch in batches:
            for h, p, r in zip(*(batch.column(c).to_pylist() for c in ("host", "path", "rule"))):
                into = seen[verdict_of[r]]
                into[""] += 1
                into.update(tokens(h, p, split))
        names = sorted({*seen["allow"], *seen["block"]})
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([seen["allow"][n] for n in names], pa.int64()),
             pa.array([seen["block"][n] for n in names], pa.int64())],
            names=["token", "allow", "block"])

    learned = (parts.where(F.col("rule").isNotNull()).select("host", "path", "rule")
               .mapInArrow(count, "token string, allow long, block long")
               .groupBy("token").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
               ).collect()
    counts = {r["token"]: (r["allow"], r["block"]) for r in learned}
    prior = counts.pop("", (0, 0))
    vocabulary = len(counts) + 1
    size = [sum(c[k] for c in counts.values()) for k in (0, 1)]
    odds = {t: math.log((b + 1) / (size[1] + vocabulary)) - math.log((a + 1) / (size[0] + vocabulary))
            for t, (a, b) in counts.items()}
    start = math.log(prior[1] + 1) - math.log(prior[0] + 1) if sum(prior) else 0.0

    def score(batches):
        split = segmenter(words, total)
        for batch in batches:
            p_block = []
            for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist()):
                x = start + sum(odds.get(t, 0.0) for t in tokens(h, p, split))
                p_block.append(1 / (1 + math.exp(-max(-700.0, min(700.0, x)))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p_block, pa.float64())],
                                             names=[*batch.schema.names, "p_block"])

    fields = [parts.schema[c] for c in parts.columns]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    scored = parts.mapInArrow(score, schema + ", p_block double")
    by_rule = F.coalesce(*[F.when(F.col("rule") == r, F.lit(v)) for r, v in rules])
    return scored.select("page_id", "host", "path", "rule",
                         F.coalesce(by_rule, F.when(F.col("p_block") > 0.5, "block")
                                    .otherwise("allow")).alias("verdict"), "p_block")
