"""Isotonic pooling by ranges against the plain algorithm, and without gathering scores."""

import random

import pytest
from pyspark.sql import functions as F

from attrition.operators import calibrate, pooling


def pooled_by_hand(rows):
    """Pool-adjacent-violators over (score, label, weight) rows: value of every distinct score."""
    sums = {}
    for x, y, w in rows:
        s, t = sums.get(x, (0.0, 0.0))
        sums[x] = (s + y * w, t + w)
    stack = []
    for x in sorted(sums):
        stack.append([*sums[x], [x]])
        while len(stack) > 1 and stack[-2][0] / stack[-2][1] >= stack[-1][0] / stack[-1][1]:
            s, w, xs = stack.pop()
            stack[-1] = [stack[-1][0] + s, stack[-1][1] + w, stack[-1][2] + xs]
    return {x: s / w for s, w, xs in stack for x in xs}


CASES = {
    "noise": lambda r, i: (round(r.random(), 3), r.randint(0, 1), 1.0),
    "rising": lambda r, i: (i / 700, int(r.random() < i / 700), 1.0),
    "falling": lambda r, i: (i / 700, int(r.random() > i / 700), 1.0),
    "steps": lambda r, i: (i / 700, (i // 50) / 14, 1.0),
    "valley": lambda r, i: (i / 700, int(i < 250 or i > 600), r.choice([1.0, 2.0, 0.5])),
    "heavy end": lambda r, i: (i / 700, 0.0 if i == 699 else i / 700, 500.0 if i == 699 else 1.0),
    "heavy start": lambda r, i: (i / 700, 1.0 if i == 0 else i / 700, 300.0 if i == 0 else 1.0),
}


@pytest.mark.parametrize("case", CASES)
def test_blocks_against_the_plain_algorithm(spark, case):
    rng = random.Random(1)
    rows = [tuple(map(float, CASES[case](rng, i))) for i in range(700)]
    frame = spark.createDataFrame(rows, "p double, y double, w double").repartition(4)
    hand = pooled_by_hand(rows)
    got = [(b["lo"], b["hi"], b["value"], b["weight"]) for b in
           calibrate.isotonic_blocks(frame, weight="w").orderBy("lo").collect()]
    assert all(a[1] < b[0] and a[2] <= b[2] + 1e-12 for a, b in zip(got, got[1:]))
    assert sum(b[3] for b in got) == pytest.approx(sum(r[2] for r in rows))
    for x, value in hand.items():
        own = [b for b in got if b[0] <= x <= b[1]]
        assert len(own) == 1 and own[0][2] == pytest.approx(value, abs=1e-12)
    model = calibrate.fit_isotonic(frame, weight="w")
    table = {r["p"]: r["calibrated"] for r in calibrate.isotonic_table(model, frame).collect()}
    assert all(table[x] == pytest.approx(v, abs=1e-12) for x, v in hand.items())


def test_a_million_scores_with_falling_labels(spark, monkeypatch):
    """One block is left, and the driver has seen a few vertices of each range only."""
    seen = []
    plain = pooling.lower_hull
    monkeypatch.setattr(pooling, "lower_hull", lambda w, s: seen.append(len(w)) or plain(w, s))
    frame = spark.range(1_000_000).select((F.col("id") / 1e6).alias("p"), (F.col("id") < 300_000).cast("int").alias("y"))
    got = calibrate.isotonic_blocks(frame).collect()
    assert [(b["lo"], b["hi"], b["weight"]) for b in got] == [(0.0, 0.999999, 1e6)] and got[0]["value"] == pytest.approx(0.3)
    assert max(seen) < 100


def test_many_blocks_stay_off_the_driver(spark, monkeypatch):
    """Labels that rise with every score: as many blocks as scores, none of them pooled."""
    seen = []
    plain = pooling.lower_hull
    monkeypatch.setattr(pooling, "lower_hull", lambda w, s: seen.append(len(w)) or plain(w, s))
    frame = spark.range(50_000).select((F.col("id") / 5e4).alias("p"), (F.col("id") / 5e4).alias("y"))
    assert calibrate.isotonic_blocks(frame).count() == 50_000 and max(seen) < 100


def test_edge_tables(spark):
    none = spark.createDataFrame([], "p double, y double")
    assert calibrate.isotonic_blocks(none).collect() == []
    one = spark.createDataFrame([(0.4, 1.0), (0.4, 0.0)], "p double, y double")
    assert [tuple(b) for b in calibrate.isotonic_blocks(one).collect()] == [(0.4, 0.4, 0.5, 2.0)]
