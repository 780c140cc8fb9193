"""Groups of the merged transforms, whatever their size, give the same rows."""

import numpy as np

from attrition.llm import suffixes


def test_groups_of_the_transforms_are_small(spark, monkeypatch):
    """op9: a group held GROUP_BYTES beside keys of up to as much; now a share of it."""
    assert suffixes.DEALT_BYTES * 4 <= suffixes.GROUP_BYTES
    rng = np.random.default_rng(2)
    words = [bytes(rng.integers(97, 123, 120, dtype=np.uint8)).decode() for _ in range(40)]
    texts = ["".join(rng.permutation(words)[:12]) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = sorted(map(tuple, suffixes.remove_repeats(docs).collect()))
    monkeypatch.setattr(suffixes, "DEALT_BYTES", 1 << 10)
    monkeypatch.setattr(suffixes, "SLICE_BYTES", 1 << 11)
    assert sorted(map(tuple, suffixes.remove_repeats(docs).collect())) == whole and any(r[2] for r in whole)
