"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing column names."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from attrition.llm import (ctw, decontaminate, langid, licences, mixing, neardup, quality, queries, suffixes,
                           urls, vectors)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASHING = ["key", "row", "spans", "score", "words", "epoch", "n_tokens", "digest", "bands", "rep", "doc", "hash", "at", "seed", "left"]


def rows():
    words = " ".join(f"word{i % 97} and the other" for i in range(60))
    out = [(1, words, "en", "src0", 10), (2, words, "en", "src1", 10), (2, words, "en", "src1", 10),
           (3, None, None, None, None), (4, "", "en", "src0", 0), (5, " \n\t ", "de", "src2", 4),
           (6, "12345 %%%", "de", "src2", 9), (None, words + " x", "en", "src0", 1), (None, None, None, None, None),
           (7, "der die das und " * 30, "de", "src3", 5), (8, "ab" * 50_000, "en", "odd", 7), (8, "another text", "en", "odd", 7),
           (9, "é" * 300, "fr", "src99999999999", 3), (10, "one", "fr", "src2", 3)]
    return out + [(20 + i, f"{words[i * 7:i * 7 + 700]} und der {i}", "en" if i % 2 else "de", f"src{i % 5}", i) for i in range(20)]


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(rows(), DOCS)
    return frame.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING]).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("1 = 0")


BENCH = "item_id long, text string"


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(0, " ".join(f"word{i}" for i in range(30, 60))), (1, None), (2, ""), (3, "der die das"),
                                  (4, " ".join(f"q{i}" for i in range(20)))], BENCH)


LABELS = "doc_id long, quality int, toxic int"


def operators(spark, docs, bench):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 40)] + [(None, 1, 0), (5, None, 0)], LABELS)
    return {
        "quality": lambda: quality.classify(docs, labels), "licences": lambda: licences.scan(docs),
        "mixing": lambda: mixing.mix(docs), "langid": lambda: langid.classify(docs),
        "decontaminate": lambda: decontaminate.overlaps(docs, bench), "ctw": lambda: ctw.score(docs),
        "neardup": lambda: neardup.near_duplicates(docs), "suffixes": lambda: suffixes.remove_repeats(docs)}


PER_ROW = ["quality", "licences", "langid", "ctw", "neardup", "suffixes"]


@pytest.mark.parametrize("name", [*PER_ROW, "mixing", "decontaminate"])
def test_odd_rows(spark, docs, bench, name):
    got = operators(spark, docs, bench)[name]().collect()
    if name in PER_ROW:
        assert len(got) == len(rows())
        key = lambda x: (x is None, x or 0)
        assert sorted((r["doc_id"] for r in got), key=key) == sorted((r[0] for r in rows()), key=key)
    of = {}
    for r in got:
        of.setdefault(r["doc_id"], []).append(r)
    if name == "langid":
        for i in (3, 4, 5, 6):
            assert (of[i][0]["lang_pred"], of[i][0]["score"]) == ("und", 0.0)
    if name == "neardup":
        assert of[2][0]["class_id"] == of[2][1]["class_id"] == 1 and not of[2][0]["kept"]
        assert all(of[i][0]["class_id"] == i for i in (3, 4, 5))
        assert all(r["class_id"] is None and r["kept"] for r in of[None])
    if name == "suffixes":
        assert of[2][0] == of[2][1] and of[2][0]["n_removed"] == of[2][0]["n_bytes"] > 0
        assert of[1][0]["n_removed"] < of[1][0]["n_bytes"] and of[3][0]["n_bytes"] == 0
        assert sorted(r["n_removed"] for r in of[8]) == [0, 99_998 - 0] or sorted(r["n_removed"] for r in of[8])[0] == 0
    if name == "ctw":
        assert of[3][0]["n_tokens"] == 1 and of[3][0]["score"] == of[4][0]["score"] < 0
        assert of[2][0]["score"] == pytest.approx(of[2][1]["score"])
    if name == "mixing":
        assert all(r["n_tokens"] > 0 for r in got) and len({r["doc_id"] for r in got} & {3, 4, 5}) == 0
        assert {(r["doc_id"], r["epoch"]) for r in got if r["doc_id"] == 2} == {(2, e) for e in {r["epoch"] for r in of.get(2, [])}}
    if name == "decontaminate":
        # A short item must occur as it is, and does.
        assert {(r["doc_id"], r["item_id"]) for r in got} == {(7, 3)}


@pytest.mark.parametrize("name", [*PER_ROW, "mixing", "decontaminate"])
def test_empty_tables(spark, empty, bench, name):
    assert operators(spark, empty, bench)[name]().collect() == []


def test_empty_companions(spark, docs, bench):
    assert decontaminate.overlaps(docs, bench.where("1 = 0")).collect() == []
    got = quality.classify(docs, spark.createDataFrame([], LABELS)).collect()
    assert len(got) == len(rows()) and {(r["score"], r["keep"]) for r in got} == {(0.5, True)}
    assert urls.judge(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
    assert vectors.link(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


def test_nothing_to_learn_from(spark):
    held = spark.createDataFrame([(1, "text", None, "s", 1), (2, None, "en", "s", 1)], DOCS)
    assert {r["lang_pred"] for r in langid.classify(held).collect()} == {"und"}
    pages = spark.createDataFrame([(1, None, None), (2, "a://b.net/x", None)], "page_id long, url string, html string")
    assert {(r["verdict"], r["p_block"]) for r in urls.judge(pages).collect()} == {("allow", 0.5)}


def test_vectors_with_null_ids_and_repeats(spark):
    frame = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (2, [], 1)],
                                  "vec_id long, embedding array<float>, label int")
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in vectors.link(frame).collect())
    assert got == [(0, 0, None, True), (1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True)]


def test_substitutions_and_hits_across_masks(spark):
    item = [f"t{i}" for i in range(40)]
    def changed(*places):
        return " ".join("zz" if i in places else w for i, w in enumerate(item))
    texts = [changed(), changed(3, 9, 15, 21, 27, 33), "x " * 50 + changed(5, 17) + " y", " ".join(item[:8]), changed(*range(0, 40, 2)),
             "T0! T1, t2; " + changed()[9:].upper()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.overlaps(docs, spark.createDataFrame([(7, " ".join(item))], BENCH)).collect()}
    assert set(got) == {0, 1, 2, 5}
    assert got[0]["n_equal"] == 40 and got[1]["n_equal"] == 34 and got[2]["n_equal"] == 38 and got[5]["n_equal"] == 40


def test_licences_in_any_typesetting(spark):
    mit = dict(licences.TEXTS)["ISC"]
    odd = "Copyright (c) 2020 Someone\nALL RIGHTS RESERVED.\n\n" + mit.upper().replace(" ", "\n * ").replace(",", " ,")
    rows_ = [(1, odd), (2, mit + " more"), (3, "Some text.\nReleased under the MIT Licence\nMore"), (4, None)]
    got = {r["doc_id"]: r for r in licences.scan(spark.createDataFrame(rows_, "doc_id long, text string")).collect()}
    assert got[1]["license"] == "ISC" and got[2]["license"] is None and got[4]["license"] is None
    assert got[3]["notices"] == "MIT" and got[1]["notices"] is None


def test_budgets_flow_to_siblings_first(spark):
    leaves = spark.createDataFrame([("a", "x", "s", 10), ("a", "y", "s", 1000), ("b", "x", "s", 1000), ("c", "x", "s", 50)],
                                   "domain string, lang string, source string, tokens long")
    weights = {"domain": {"a": 4, "b": 1, "c": 1}, "lang": {"x": 9, "y": 1}}
    got = {(r["domain"], r["lang"]): r["budget"] for r in mixing.budgets(leaves, weights=weights, budget=(1, 2), max_epochs=1).collect()}
    # 1030 tokens: c takes its 50 of 171; a and b share 980 as 4:1; in a, x is filled and y has the rest.
    assert got == {("a", "x"): 10, ("a", "y"): 774, ("b", "x"): 196, ("c", "x"): 50}


def test_every_operator_is_registered_with_its_number():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))


@pytest.fixture(scope="module")
def folder(spark, docs, bench, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    bench.write.parquet(os.path.join(path, "benchmark.parquet"))
    docs.where("doc_id is null or doc_id <> 3").write.parquet(os.path.join(path, "documents.parquet"))
    return path


def test_stages_keep_columns_and_take_odd_rows(spark, docs, folder):
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, folder)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        assert stage(spark, frame.where("1 = 0"), folder).collect() == [], name
        assert 0 < out.count() <= frame.count()
    assert corpus_pipeline.STAGES[-1][1](spark, frame, folder).count() > 0


def test_stages_decide_as_the_operators_do(spark, folder):
    """Each stage against what its operator's own query says of the same rows."""
    from test_brute_force import made_documents, removed_by_hand
    texts = made_documents(11, 50)
    frame = spark.createDataFrame([(i, t, "en", "src1", len(t)) for i, t in enumerate(texts)], DOCS).repartition(3)
    stage = dict(corpus_pipeline.STAGES)
    kept = {r["doc_id"] for r in stage["near_duplicates"](spark, frame, folder).collect()}
    assert kept == {r["doc_id"] for r in neardup.near_duplicates(frame).collect() if r["kept"]}
    hand = removed_by_hand(list(enumerate(texts)))
    for r in stage["repeated_strings"](spark, frame, folder).collect():
        size, gone, _, _ = hand[r["doc_id"]]
        # Whole characters go: a cut may take up to three more bytes at either end of a span.
        assert size - gone - 6 * hand[r["doc_id"]][2] <= len(r["text"].encode()) <= size - gone
        assert r["n_chars"] == len(r["text"])
    lost = {r["doc_id"] for r in stage["language_id"](spark, frame, folder).collect()} ^ set(range(len(texts)))
    assert lost == {r["doc_id"] for r in langid.classify(frame).collect() if r["ambiguous"]}


def test_run_applies_all_stages(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "text", "lang", "source", "n_tokens", "epoch"} <= set(out.columns) and out.count() > 0
