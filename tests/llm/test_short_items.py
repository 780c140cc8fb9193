"""Short benchmark items, scripts without spaces, and the shuffled way, against brute force."""

import random
import re

import pytest

from attrition.llm import decontaminate as D

DOCS, BENCH = "doc_id long, text string", "item_id long, text string"


def tokens(text):
    apart = re.sub("([一-鿿぀-ヿ])", r" \1 ", (text or "").lower())
    return [w for w in re.split(r"[\W_]+", apart) if w]


def by_hand(docs, items):
    """Every alignment of every pair."""
    out = set()
    for d, text in docs:
        for i, item in items:
            a, b = tokens(text), tokens(item)
            for off in range(-len(b) + 1, len(a)):
                equal = [a[off + k] == b[k] for k in range(len(b)) if 0 <= off + k < len(a)]
                size = min(len(equal), D.WINDOW)
                best = max((sum(equal[k:k + size]) for k in range(len(equal) - size + 1)), default=0)
                allowed = 0 if len(b) < D.SPAN else D.SUBSTITUTIONS
                if equal and best >= size - allowed and (len(equal) >= D.WINDOW or len(equal) == len(b)):
                    out.add((d, i))
    return out


ITEMS = [(0, "What is the capital city of France?"), (1, "水的沸点是多少度?"), (2, "Paris"), (3, "one two three four five six seven eight nine ten"),
         (4, " ".join(f"q{i}" for i in range(20))), (5, "?!"), (6, None), (7, "日本の首都はどこですか")]
TEXTS = [(0, "He asked: what is the Capital city of france, and left."), (1, "问题：水的沸点是多少度？答案"), (2, "what is the capital town of france"),
         (3, "I saw Paris."), (4, "one two x four five y seven eight z ten"), (5, "one two x four w y seven eight z ten"), (6, ""), (7, None),
         (8, "水的沸点"), (9, "日本の首都はどこですか。東京"), (10, "parisian"), (11, " ".join(f"q{i}" if i not in (2, 7, 11, 15) else "zz" for i in range(20)))]


@pytest.mark.parametrize("shuffled", [False, True])
def test_items_of_every_length(spark, monkeypatch, shuffled):
    if shuffled:
        monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    got = D.overlaps(spark.createDataFrame(TEXTS, DOCS), spark.createDataFrame(ITEMS, BENCH)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == by_hand(TEXTS, ITEMS)
    assert {(0, 0), (1, 1), (3, 2), (4, 3), (9, 7), (11, 4)} == {(r["doc_id"], r["item_id"]) for r in got}


@pytest.mark.parametrize("shuffled", [False, True])
def test_random_pairs(spark, monkeypatch, shuffled):
    if shuffled:
        monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 4, 8, 9, 10, 12, 13, 14, 30])))) for i in range(30)]
    docs = []
    for d in range(60):
        text = [rng.choice(words) for _ in range(rng.randint(0, 25))]
        part = rng.choice(items)[1].split()
        for _ in range(rng.randint(0, 5)):
            part[rng.randrange(len(part))] = "other"
        docs.append((d, " ".join([*text, *part, *text[:5]])))
    got = {(r["doc_id"], r["item_id"]) for r in D.overlaps(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, BENCH)).collect()}
    assert got == by_hand(docs, items)


def test_the_shuffled_way_moves_no_texts(spark, monkeypatch):
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    seen = []
    plain = D.materialize
    monkeypatch.setattr(D, "materialize", lambda df, name: seen.append((name, df.columns)) or plain(df, name))
    D.overlaps(spark.createDataFrame(TEXTS, DOCS), spark.createDataFrame(ITEMS, BENCH)).count()
    assert ("hits", ["doc_id", "text_key", "item_id", "item_key", "n_item", "off"]) in seen
