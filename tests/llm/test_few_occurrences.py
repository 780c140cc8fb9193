"""Keys that occur a few times are judged in one group, and texts are trimmed before the transforms."""

import random

import numpy as np

from attrition.llm import suffixes
from test_brute_force import removed_by_hand


def test_keys_of_few_segments_are_dealt_once(spark, monkeypatch):
    """Check finding: all segments were shuffled by segment, key and place before those left were dealt by
    key; 5.56 x the input on disk at 30 GB."""
    rng = random.Random(4)
    write = lambda k: "".join(rng.choice("abcdefghij é") for _ in range(k))
    shared = [write(150) for _ in range(6)]
    rows = [(i, write(rng.randint(0, 40)) + rng.choice(shared)[:140] + write(rng.randint(0, 40))) for i in range(60)]
    rows += [(100 + i, rows[3 * i][1]) for i in range(8)] + [(200, "=" * 400), (201, None), (202, "x" + "=" * 300)]
    expected = removed_by_hand(rows)
    rows += [(5, rows[5][1]), (5, rows[5][1])]  # repeated rows are one document
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    seen, plain = [], suffixes.materialize

    def counted(frame, name="table"):
        out = plain(frame, name)
        seen.append((name, out.where("kind = 0 and many").count() if name == "segments" else 0))
        return out

    monkeypatch.setattr(suffixes, "materialize", counted)
    got = {}
    for few in (1, 8, 256):
        monkeypatch.setattr(suffixes, "FEW", few)
        seen.clear()
        out = [tuple(r) for r in suffixes.remove_repeats(docs).collect()]
        assert len(out) == len(rows) and {r[0]: r[1:] for r in out} == expected
        got[few] = sum(n for name, n in seen if name == "segments")
    assert got[1] > got[8] > got[256] == 0


def test_trimmed_texts_lose_no_repeat():
    rng = random.Random(8)
    write = lambda k: bytes(rng.choice(b"abcd") for _ in range(k))
    shared = [write(130) for _ in range(3)]
    texts = [write(rng.randint(0, 50)) + rng.choice(shared)[rng.randint(0, 20):] + write(rng.randint(0, 50)) for _ in range(20)]
    texts += [write(160) for _ in range(10)] + [b"", b"ab", b"z" * 140]
    deal = np.zeros(len(texts), np.int64)
    low, high = suffixes._worth(texts, deal)
    whole = {(bytes(t[p:p + 100])) for t in texts for p in range(len(t) - 99)}
    places = {w: [(i, p) for i, t in enumerate(texts) for p in range(len(t) - 99) if t[p:p + 100] == w] for w in whole}
    again = [p for found in places.values() if len(found) > 1 for p in found]
    assert again and all(low[i] <= p and p + 100 <= high[i] for i, p in again)
    assert not high[20:32].any() and sum(high - low) < sum(map(len, texts))
    # Other deals share nothing.
    assert not suffixes._worth(texts[:-1], np.arange(len(texts) - 1))[1].any()
