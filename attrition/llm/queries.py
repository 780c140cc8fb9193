"""Registered queries of the training-data operators, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from attrition.llm import (automata, ctw, decontaminate, langid, licences, mixing, neardup, pq, quality, suffixes,
                           urls, vectors, whitening)
from attrition.llm.common import read

QUERIES: dict = {}
ORACLE: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_language_id(spark, sf_dir):
    return langid.classify(read(spark, sf_dir, "documents"))


@query
def op5_url_filter(spark, sf_dir):
    return urls.judge(read(spark, sf_dir, "pages"))


@query
def op3_mixture(spark, sf_dir):
    return mixing.mix(read(spark, sf_dir, "documents"))


ORACLE["op3_mixture"] = mixing.sql()


@query
def op2_license_scan(spark, sf_dir):
    return licences.scan(read(spark, sf_dir, "documents"))


ORACLE["op2_license_scan"] = licences.sql()


@query
def op10_embedding_links(spark, sf_dir):
    return vectors.link(read(spark, sf_dir, "embeddings"))


@query
def op6_decontaminate(spark, sf_dir):
    return decontaminate.overlaps(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


ORACLE["op6_decontaminate"] = decontaminate.sql()


@query
def op1_quality(spark, sf_dir):
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op7_lm_score(spark, sf_dir):
    return ctw.score(read(spark, sf_dir, "documents"))


@query
def op8_near_duplicates(spark, sf_dir):
    return neardup.near_duplicates(read(spark, sf_dir, "documents"))


@query
def op9_repeated_strings(spark, sf_dir):
    return suffixes.remove_repeats(read(spark, sf_dir, "documents"))


@query
def op11_repeated_words(spark, sf_dir):
    return automata.remove_repeats(read(spark, sf_dir, "documents"))


ORACLE["op11_repeated_words"] = automata.sql()


@query
def op12_embedding_whitening(spark, sf_dir):
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


@query
def op13_vector_codes(spark, sf_dir):
    return pq.compress(read(spark, sf_dir, "embeddings"))


ORACLE["op13_vector_codes"] = pq.sql()
