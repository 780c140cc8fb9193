"""Whitening and vector codes against brute force: numpy's eigenvectors, full rescans."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from attrition.llm import pq, whitening

SCHEMA = "vec_id long, embedding array<double>, label int"


def made_vectors(seed, n=700, width=8):
    """Clusters, copies, rows of one id, and rows to drop: nulls, NaN, infinities."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, width))
    out = []
    for i in range(n):
        v = (centres[rng.integers(12)] + rng.standard_normal(width) * 0.3).tolist()
        if i % 9 == 0 and out and out[-1][1]:
            v = list(out[-1][1])
        if i % 53 == 7:
            v = random.Random(i).choice([None, [*v[1:], None], [*v[1:], float("nan")], [*v[1:], float("-inf")]])
        out.append((None if i % 211 == 5 else int(n - i if i % 3 else i // 2), v, None if i % 5 == 0 else i % 4))
    return out


def is_kept(v):
    return v is not None and all(c is not None and np.isfinite(c) for c in v)


def codes_by_hand(rows, entries=256):
    kept = sorted((r for r in rows if is_kept(r[1])), key=lambda r: (r[0] is None, r[0] or 0, np.floor(1024 * np.array(r[1])).tolist()))
    x = np.floor(1024 * np.array([r[1] for r in kept])).astype(int).reshape(len(kept), 4, -1)
    books = [x[:entries, p].copy() for p in range(4)]
    for step in range(5):
        code, error = np.empty((len(x), 4), int), np.zeros(len(x), int)
        for p in range(4):
            for i, v in enumerate(x[:, p]):
                d = ((books[p] - v) ** 2).sum(1)
                code[i, p] = d.argmin()
                error[i] += d.min()
            if step < 4:
                for e in range(len(books[p])):
                    own = x[code[:, p] == e, p]
                    if len(own):
                        books[p][e] = own.sum(0) // len(own)
    told = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    labels = {}
    for r, e in zip(kept, error):
        labels[r[2]] = labels.get(r[2], 0) + int(e)
    return sorted((r[0] or -1, "".join(f"{c:02x}" for c in cs), int(e), labels[r[2]], told) for r, cs, e in zip(kept, code, error))


@pytest.mark.parametrize("salted", [False, True])
@pytest.mark.parametrize("entries", [256, 16])
def test_vector_codes(spark, monkeypatch, salted, entries):
    monkeypatch.setattr(pq, "ENTRIES", entries)
    if salted:
        monkeypatch.setattr(pq, "BROADCAST_LABELS", 0)
    rows = made_vectors(1)
    got = pq.compress(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert sorted((r["vec_id"] or -1, r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in got) == codes_by_hand(rows, entries)


def test_moved_entries_alone_decide_as_a_full_rescan():
    rng = np.random.default_rng(2)
    x, entries = rng.integers(-4, 5, (3000, 2)), rng.integers(-4, 5, (20, 2))
    code, distance = pq.nearest(x, entries)
    for _ in range(6):
        moved = rng.random(20) < 0.3
        entries = np.where(moved[:, None], rng.integers(-4, 5, (20, 2)), entries)
        code, distance = pq.reassign(x, entries, moved, code, distance)
        full = pq.nearest(x, entries)
        assert (code == full[0]).all() and (distance == full[1]).all()


def test_large_integers_stay_exact():
    limit = pq.bound(16)
    x, entries = np.full((2, 16), limit), np.array([[-limit] * 16, [limit - 1] * 16])
    x[1] = -limit
    index, distance = pq.nearest(x, entries)
    assert index.tolist() == [1, 0] and distance.tolist() == [16, 0]
    assert int(pq._distances(x, entries)[0, 0]) == 16 * (2 * limit) ** 2 < 1 << 63


def test_odd_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert pq.compress(empty).collect() == [] and whitening.whiten(empty).collect() == []
    odd = spark.createDataFrame([(1, [0.5] * 6, 1), (2, [0.25] * 3, None), (None, [], 1), (3, None, 1), (1, [0.5] * 6, 1)], SCHEMA)
    odd = odd.select("*", *[F.lit("own").alias(c) for c in ("x", "code", "n", "place", "block", "error")])
    got = {(r["vec_id"], r["code"], r["error"], r["label_error"]) for r in pq.compress(odd).collect()}
    # Filled up to eight components; zeros are nearest to the lowest entry that is zero there.
    assert got == {(1, "00000000", 0, 0), (2, "02020200", 0, 0), (None, "03030200", 0, 0)}
    rows = whitening.whiten(odd).collect()
    assert len(rows) == 4 * 6 and {r["n"] for r in rows} == {3}
    one = whitening.whiten(odd.where("vec_id = 1")).collect()
    assert len(one) == 2 * 6 and {(r["whitened"], r["explained"], r["identity_error"], r["deviation"]) for r in one} == {(None, 0.0, None, 0)}


def test_whitening(spark):
    rows = made_vectors(3, 900, 24)
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    kept = [r for r in rows if is_kept(r[1])]
    x = np.floor(64 * np.array([r[1] for r in kept])).astype(int) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    away = fit - fit.mean(0)
    values, axes = np.linalg.eigh(away.T @ away / n)
    values, axes = values[::-1], axes[:, ::-1]
    assert len(got) == 16 * len(kept) and {r["n"] for r in got} == {n}
    deviations = sorted((r[0] or -1, int(((n * v - sums) ** 2).sum())) for r, v in zip(kept, x))
    assert sorted((r["vec_id"] or -1, r["deviation"]) for r in got if r["component"] == 3) == deviations
    for c in range(16):
        mine = sorted(((r["vec_id"] or -1, r["deviation"]), r["whitened"]) for r in got if r["component"] == c + 1)
        hand = sorted(((r[0] or -1, int(((n * v - sums) ** 2).sum())), float((v - sums / n) @ axes[:, c] / values[c] ** 0.5))
                      for r, v in zip(kept, x))
        a, b = np.array([m[1] for m in mine]), np.array([h[1] for h in hand])
        assert np.abs(a - b * np.sign(a @ b)).max() < 1e-9
        assert {r["explained"] for r in got if r["component"] == c + 1}.pop() == pytest.approx(values[c] / values.sum(), rel=1e-12)
    assert {r["identity_error"] for r in got}.pop() < 1e-11


def test_corrections_are_least_residuals_of_their_steps():
    """MINRES against the least residual over the Krylov space, several shifts at once."""
    rng = np.random.default_rng(0)
    a = rng.standard_normal((30, 30))
    a, r, shifts = a + a.T, rng.standard_normal((30, 3)), np.array([0.1, 0.5, 30.0])
    for steps in (1, 2, 5, 9):
        t = whitening.corrections(lambda w: a @ w, shifts, r, np.zeros((30, 0)), steps, 0.0)
        for j, shift in enumerate(shifts):
            m, space = a - shift * np.eye(30), [-r[:, j]]
            for _ in range(steps - 1):
                space.append(m @ space[-1] / np.linalg.norm(m @ space[-1]))
            q, _ = np.linalg.qr(np.array(space).T)
            least = np.linalg.norm(m @ q @ np.linalg.lstsq(m @ q, -r[:, j], rcond=None)[0] + r[:, j])
            assert np.linalg.norm(m @ t[:, j] + r[:, j]) == pytest.approx(least, rel=1e-6)


def test_wide_spectra_converge_with_restarts():
    """More dimensions than the subspace holds: the search restarts and still ends at rounding."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((2000, 200))
    x[:700] += rng.standard_normal(200) * 6
    x -= x.mean(0)
    v = x.T @ x / len(x)
    values, axes = whitening.eigenpairs(lambda w: v @ w, 200, 16)
    assert np.abs(values - np.linalg.eigvalsh(v)[::-1][:16]).max() < 1e-12 * values[0]
    assert np.linalg.norm(v @ axes - axes * values, axis=0).max() < 1e-13 * values[0]
