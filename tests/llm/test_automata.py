"""Removal of repeated runs of words against brute force: all windows in a dictionary."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from attrition.llm import automata

SCHEMA = "doc_id long, text string"


def made_texts(seed, n=70):
    """Copies, shared passages between other words, repeats inside a text, periodic texts, odd spaces."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 6))) for _ in range(40)] + ["x" * 50, "x" * 49 + "y"]
    write = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    passages = [write(k) for k in (34, 35, 36, 50, 120)]
    twice = write(12)
    out = [None, "", " \n\t ", f"{twice} {twice} {write(30)}", f"{write(20)} {twice} x {twice} {write(20)}", "a " * 90, ("a " * 40 + "b ") * 4, "z" * 4000]
    for _ in range(n):
        kind = rng.random()
        if kind < 0.2:
            out.append(rng.choice(out))
        elif kind < 0.6:
            out.append(write(rng.randint(0, 30)) + rng.choice([" ", "\n", " \x0b\t"]) + rng.choice(passages) + " " + write(rng.randint(0, 30)))
        elif kind < 0.7:
            p = write(40)
            out.append(p + " " + write(5) + " " + p)
        elif kind < 0.8 and out[-1]:
            words = out[-1].split()
            words[len(words) // 2:len(words) // 2 + 1] = ["new"]
            out.append("  ".join(words))
        else:
            out.append(write(rng.randint(0, 150)))
    return out


def words_of(text):
    return (text or "").encode().split()


def by_hand(texts, known=None, length=35):
    seen = Counter(tuple(w[i:i + length]) for t in (texts if known is None else known) for w in [words_of(t)] for i in range(len(w) - length + 1))
    out = []
    for t in texts:
        w = words_of(t)
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i:i + length])] > (known is None):
                gone[i:i + length] = True
        out.append((len(w), int(gone.sum()), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_repeated_runs(spark, monkeypatch, small):
    if small:
        # Every key with two texts is cut again, shards and blocks are many, pieces short.
        monkeypatch.setattr(automata, "SHARD_BYTES", 300)
        monkeypatch.setattr(automata, "COPIES", 3)
        monkeypatch.setattr(automata, "PIECE", 3)
    texts = made_texts(1 + small)
    frame = spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(4)
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in automata.remove_repeats(frame).collect())
    assert got == [(i, *h) for i, h in enumerate(by_hand(texts))]


def test_runs_of_a_reference(spark):
    texts, known = made_texts(4), made_texts(5, 10)
    known += [" ".join(words_of(t)[i].decode() for i in range(3, 45)) for t in texts[20:30] if len(words_of(t)) > 50]
    frame = spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(4)
    reference = spark.createDataFrame([(t,) for t in known], "text string")
    hand = by_hand(texts, known)
    assert any(h[1] for h in hand)
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in automata.remove_repeats(frame, reference).collect())
    assert got == [(i, *h) for i, h in enumerate(hand)]
    cut = {r["doc_id"]: r["text"] for r in automata.cut_texts(frame, reference).collect()}
    assert all(hashlib.sha256(cut[i].encode()).hexdigest() == h[2] for i, h in enumerate(hand))


def test_counts_of_the_automaton():
    """Every run of words: the weight of its ends, by brute force."""
    rng = random.Random(3)
    texts = [([rng.randrange(3) for _ in range(rng.randint(1, 25))], rng.randint(1, 3)) for _ in range(12)]
    machine = automata.Automaton()
    runs = Counter()
    for symbols, weight in texts:
        machine.add(symbols, weight)
        for i in range(len(symbols)):
            for j in range(i, len(symbols)):
                runs[tuple(symbols[i:j + 1])] += weight
    machine.settle()
    for run, n in runs.items():
        state = 0
        for symbol in run:
            state = machine.step[state][symbol]
        assert machine.count[state] == n
    for least in (1, 2, 5):
        for symbols, _ in texts:
            gone = np.zeros(len(symbols), bool)
            for i in range(len(symbols) - least + 1):
                if runs[tuple(symbols[i:i + least])] >= 2:
                    gone[i:i + least] = True
            told = np.zeros(len(symbols), bool)
            for begin, end in machine.spans(symbols, least):
                assert not told[max(0, begin - 1):end].any()
                told[begin:end] = True
            assert (told == gone).all()


def test_odd_rows(spark):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(1, words), (1, words), (2, "one " + words[:200]), (None, "own " * 3), (None, None), (3, " ".join(f"v{i}" for i in range(30_000))), (1, "other")]
    frame = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("own").alias(c) for c in ("doc", "hash", "start", "weight", "spans", "key")])
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in automata.remove_repeats(frame).collect())
    assert got == Counter((i, *h) for (i, _), h in zip(rows, by_hand([t for _, t in rows])))
    assert automata.remove_repeats(frame.where("1 = 0")).collect() == []
    assert automata.remove_repeats(frame, frame.where("1 = 0")).where("n_removed > 0").collect() == []
