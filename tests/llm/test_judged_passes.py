"""Segments judged in passes by key, and shuffles that go with the write they served."""

from pyspark.sql import DataFrameWriter

from attrition import session
from attrition.llm import suffixes


def removed(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffixes.remove_repeats(docs).collect()}


def test_passes_judge_each_key_once(spark, monkeypatch):
    """Check finding: all keys were judged at once, with every shuffle of it on disk."""
    text = lambda k, n: " ".join(f"w{(k * 7919 + i * i) % 9973}" for i in range(n))
    rows = [(k, text(k, 60) + " " + text(1000 + k % 4, 50) + text(k + 500, 20)) for k in range(24)]
    rows += [(50, rows[3][1]), (51, rows[3][1]), (51, rows[3][1]), (None, rows[5][1]), (60, None)]
    names, plain = [], suffixes.materialize
    monkeypatch.setattr(suffixes, "materialize", lambda df, name="table": names.append(name) or plain(df, name))
    whole = removed(spark, rows)
    once = names.count("judged")
    names.clear()
    monkeypatch.setattr(suffixes, "JUDGED", 8)
    monkeypatch.setattr(suffixes, "PASSES", 3)
    assert removed(spark, rows) == whole and sum(r[2] for r in whole) > 0
    assert names.count("judged") > once


def test_shuffle_files_of_a_write_go_with_it(spark, monkeypatch):
    """Check finding: shuffle files stayed until the driver's memory was collected."""
    seen, plain = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: seen.append(spark.conf.get(session.CLEANUP)) or plain(self, path))
    before = spark.conf.get(session.CLEANUP, "false")
    out = session.materialize(spark.range(5000).groupBy("id").count(), "grouped")
    assert seen == ["true"] and spark.conf.get(session.CLEANUP, "false") == before
    assert out.count() == 5000
