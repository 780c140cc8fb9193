"""The operators against brute-force versions on small tables."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from attrition.llm import ctw, decontaminate, langid, neardup, quality, suffixes, urls, vectors
from attrition.llm.common import read

SF = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def low(text):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())


@pytest.fixture(scope="module")
def docs(spark):
    return read(spark, SF, "documents").cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


def made_documents(seed, n=60):
    """Texts with copies, shared passages, periodic parts and multi-byte characters."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé ß") for _ in range(rng.randint(1, 8))) for _ in range(60)]
    write = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    passages = [write(40) for _ in range(4)]
    out = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.2 and out:
            t = rng.choice(out)
        elif kind < 0.4:
            t = write(10) + rng.choice(passages) + write(12)
        elif kind < 0.5:
            t = "ab" * rng.randint(40, 200)
        elif kind < 0.55:
            t = "é" * rng.randint(10, 150)
        elif kind < 0.65 and out:
            t = rng.choice(out)
            cut = rng.randint(0, max(0, len(t) - 1))
            t = t[:cut] + "X" + t[cut:]
        else:
            t = write(rng.randint(0, 80))
        out.append(t)
    return out


def removed_by_hand(rows):
    """Repeated 100-byte strings by a set of all strings seen so far, in corpus order."""
    seen, out = set(), {}
    for doc, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for s in range(len(raw) - 99):
            w = raw[s:s + 100]
            if w in seen:
                gone[s:s + 100] = True
            seen.add(w)
        out[doc] = (len(raw), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()),
                    hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest())
    return out


@pytest.mark.parametrize("hot", [4096, 1])
def test_repeated_strings(spark, monkeypatch, hot):
    # Small shards, so that several transforms are merged; hot=1 deals every varied key by window.
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 1000)
    monkeypatch.setattr(suffixes, "GROUP_BYTES", 4000)
    monkeypatch.setattr(suffixes, "HOT", hot)
    rows = list(enumerate(made_documents(3)))
    expected = removed_by_hand(rows)
    shuffled = random.Random(1).sample(rows, len(rows))
    got = suffixes.remove_repeats(spark.createDataFrame(shuffled, "doc_id long, text string").repartition(4)).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == expected


def test_one_passage_in_many_documents_makes_no_large_group(spark, monkeypatch):
    """A passage with other words around it each time: its windows are as many as the documents."""
    monkeypatch.setattr(suffixes, "GROUP_BYTES", 4000)
    monkeypatch.setattr(suffixes, "HOT", 16)
    real = suffixes._merge_group

    def bounded(key, table):
        assert sum(map(len, table.column("text").to_pylist())) <= 20_000
        return real(key, table)

    monkeypatch.setattr(suffixes, "_merge_group", bounded)
    rng = random.Random(12)
    write = lambda k: "".join(rng.choice("abcdefgh ") for _ in range(k))
    passage = write(130)
    rows = [(i, write(rng.randint(0, 60)) + passage + write(rng.randint(0, 60))) for i in range(400)]
    rows += rows[:3] + [(500 + i, "-" * (100 + 7 * i)) for i in range(40)]
    expected = removed_by_hand(dict(rows).items())
    got = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == expected and len(got) == len(rows)


def test_merged_transforms_equal_one_sort(monkeypatch):
    texts = [t.encode() for t in made_documents(5, 40) if len(t.encode()) >= 100]
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 1 << 30)
    whole = suffixes.repeated_windows(texts)
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 700)
    assert (suffixes.repeated_windows(texts) == whole).all() and len(whole)


def test_near_duplicate_classes(spark, monkeypatch):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(500)]
    rows = []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, 150))]
        for _ in range(rng.randint(1, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(copy)))
    rows += [(len(rows) + i, t) for i, t in enumerate([rows[0][1], rows[0][1].upper(), "", None, "a b", "a  b"])]
    monkeypatch.setattr(neardup, "BLOCK", 4)
    sets = {}
    for i, t in rows:
        w = WORD.findall(low(t))
        count = Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()
        sets[i] = {(x, c) for x, n in count.items() for c in range(n)}
    label = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = sorted((label[a], label[b]))
                label = {k: x if v == y else v for k, v in label.items()}
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == label
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in got)


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(0)
    hits = []
    for shared in (20, 200, 1000):
        a = rng.integers(0, 1 << 62, shared + shared // 4).astype(np.uint64)
        b = np.r_[a[:shared], rng.integers(0, 1 << 62, shared // 4).astype(np.uint64)]
        both = neardup.signatures(np.r_[a, b], np.r_[np.zeros(len(a), int), np.ones(len(b), int)], 2)
        assert np.isfinite(both).all()
        hits.append((both[0] == both[1]).mean() - shared / (shared * 1.5))
    assert np.abs(hits).max() < 0.16


def test_embedding_links(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 8)
    monkeypatch.setattr(vectors, "CELL", 20)
    rng = np.random.default_rng(4)
    rows = []
    for c in range(12):
        center = rng.normal(size=16)
        for _ in range(int(rng.integers(1, 14))):
            rows.append((len(rows), (center + rng.normal(size=16) * 0.08).tolist(), c % 2))
    rows += [(len(rows) + k, rows[0][1], 0) for k in range(9)]
    x = np.array([np.float32(r[1]) for r in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    linked = (x @ x.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(linked, False)
    group = np.arange(len(rows))
    for _ in rows:
        group = np.array([min([group[i], *group[linked[i]]]) for i in range(len(rows))])
    odd = [(900, None, 0), (901, [0.0] * 16, 0), (902, [float("nan")] * 16, 0), (903, rows[0][1], None),
           (904, [None] * 16, 0), (905, [1.0, 2.0], 0), (906, [1.0, 2.0], 0)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: r for r in vectors.link(frame).collect()}
    assert [got[i]["n_links"] for i in range(len(rows))] == linked.sum(1).tolist()
    assert [got[i]["component_id"] for i in range(len(rows))] == group.tolist()
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in range(900, 905))
    assert got[906]["component_id"] == 905 and got[906]["n_links"] == 1


def test_embedding_links_inside_a_dense_cluster(spark, monkeypatch):
    """Distinct vectors that are all near each other, many cells' worth of them, beside spread ones."""
    monkeypatch.setattr(vectors, "BLOCK", 64)
    monkeypatch.setattr(vectors, "CELL", 20)
    rng = np.random.default_rng(8)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    dense = unit(unit(rng.normal(size=(1, 16))) + rng.normal(size=(500, 16)) * 0.03)
    loose = unit(rng.normal(size=(1, 16))) + rng.normal(size=(300, 16)) * 0.06
    x = np.float32(np.vstack([dense, loose, rng.normal(size=(400, 16))]))
    frame = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")
    x = unit(x.astype(np.float64))
    linked = x @ x.T >= 0.98
    np.fill_diagonal(linked, False)
    got = {r["vec_id"]: r["n_links"] for r in vectors.link(frame.repartition(3)).collect()}
    assert [got[i] for i in range(len(x))] == linked.sum(1).tolist() and linked.sum() > 100_000


def overlaps_by_hand(doc, item):
    """Whether some alignment has at most 3 differences in 13 tokens in a row, or in a whole shorter item."""
    n = min(13, len(item))
    return any(sum(doc[d + k] == item[i + k] for k in range(n)) >= n - 3
               for i in range(len(item) - n + 1) for d in range(len(doc) - n + 1))


def test_every_placement_of_substitutions(spark):
    rng = random.Random(9)
    items = {n: [f"i{n}x{k}" for k in range(n)] for n in (9, 10, 12, 13, 15)}
    docs = []
    for n, item in items.items():
        for size in (3, 4):
            places = list(itertools.combinations(range(n), size))
            for gone in places if size == 3 else rng.sample(places, 40):
                docs.append([f"a{rng.randrange(99)}"] * rng.randrange(3) + ["zz" if k in gone else w for k, w in enumerate(item)])
    # Overlaps of 13 tokens with the end of the longest item.
    docs += [["zz" if k in gone else w for k, w in enumerate(items[15][2:])] for gone in itertools.combinations(range(13), 3)]
    expected = {(d, n) for d, doc in enumerate(docs) for n, item in items.items() if overlaps_by_hand(doc, item)}
    got = decontaminate.overlaps(
        spark.createDataFrame([(d, " ".join(doc)) for d, doc in enumerate(docs)], "doc_id long, text string"),
        spark.createDataFrame([(n, " ".join(item)) for n, item in items.items()], "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == expected and len(expected) > 1300


def base_scores(texts, held):
    count = Counter()
    for i, t in texts.items():
        if not held[i]:
            count.update(WORD.findall(low(t)))
            count["end"] += 1
    n, v = sum(count.values()), len(count)
    out = {}
    for i, t in texts.items():
        tokens = [*WORD.findall(low(t)), "end"]
        out[i] = (len(tokens), sum(count[x] > 0 for x in tokens), n,
                  sum(math.log10((count[x] + 1) / (n + v + 1)) for x in tokens))
    return out


def context_tree(texts, held, depth):
    """log10 probability of a text by a context tree kept in dictionaries."""
    count, below, weighted = defaultdict(lambda: [0, 0]), defaultdict(float), {}
    symbols = lambda t: [255] * depth + list(low(t)) + [255]
    for i, t in texts.items():
        s = symbols(t) if not held[i] else []
        for at in range(depth, len(s)):
            for k in range(8):
                node, bit = (1 << k) | (s[at] >> (8 - k)), (s[at] >> (7 - k)) & 1
                for d in range(depth + 1):
                    count[node, tuple(s[at - d:at])][bit] += 1
    kt = lambda a, b: math.lgamma(a + .5) + math.lgamma(b + .5) - math.log(math.pi) - math.lgamma(a + b + 1)
    for key in sorted(count, key=lambda k: -len(k[1])):
        own = kt(*count[key])
        if len(key[1]) < depth:
            top = max(own, below[key])
            own = math.log(.5) + top + math.log(math.exp(own - top) + math.exp(below[key] - top))
        weighted[key] = own
        if key[1]:
            below[key[0], key[1][1:]] += own

    def bit_probability(node, context, bit, d=0):
        key = (node, context[len(context) - d:])
        if key not in count:
            return .5
        n = count[key]
        own = (n[bit] + .5) / (sum(n) + 1)
        if d == depth:
            return own
        stop = math.exp(math.log(.5) + kt(*n) - weighted[key])
        return stop * own + (1 - stop) * bit_probability(node, context, bit, d + 1)

    def score(t):
        s = symbols(t)
        return sum(math.log10(bit_probability((1 << k) | (s[at] >> (8 - k)), tuple(s[at - depth:at]), (s[at] >> (7 - k)) & 1))
                   for at in range(depth, len(s)) for k in range(8))
    return score


def test_language_model(spark, monkeypatch):
    # A small head table, so that both tiers of the lookup are used.
    monkeypatch.setattr(ctw, "HEAD", 200)
    monkeypatch.setattr(ctw, "DEPTH", 3)
    rng = random.Random(6)
    write = lambda k: " ".join(rng.choice(["the", "Of", "rhé", "ab", "abc", f"x{rng.randint(0, 99)}"]) for _ in range(k))
    texts = {i: write(rng.randint(0, 30)) for i in range(40)} | {50: None, 51: "", 52: "\t\n A"}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    got = {r["doc_id"]: r for r in ctw.score(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)).collect()}
    tree = context_tree(texts, held, 3)
    for i, (n, known, train, base) in base_scores(texts, held).items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (n, known, train, held[i])
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] == pytest.approx(tree(texts[i]), rel=1e-8)


def test_language_accuracy(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    got = langid.classify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97 and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)


def test_codewords_are_apart():
    for n in (2, 3, 4, 6, 9, 30):
        code = langid.codewords(n)
        distance = (code.shape[1] - code @ code.T) / 2
        assert distance[~np.eye(n, dtype=bool)].min() >= (1 if n == 2 else code.shape[1] // 4)


def test_quality_held_out(spark):
    docs, labels = read(spark, "/root/testdata/sf0.01", "documents"), read(spark, "/root/testdata/sf0.01", "labels")
    fit, ask = labels.where("doc_id % 3 <> 0"), labels.where("doc_id % 3 = 0")
    got = quality.classify(docs, fit).join(ask, "doc_id").collect()
    assert len(got) > 50 and np.mean([r["keep"] == (r["quality"] == 1) for r in got]) > 0.93


def split_by_hand(run, counts):
    """Best segmentation by trying every one."""
    total = sum(counts.values()) + 1
    def cost(words):
        return sum(math.log(total) - math.log(counts[w]) if w in counts else math.log(total) + math.log(10) for w in words)
    best = None
    for cuts in range(1 << (len(run) - 1)):
        words, start = [], 0
        for k in range(1, len(run) + 1):
            if k == len(run) or cuts >> (k - 1) & 1:
                words.append(run[start:k])
                start = k
        if all(w in counts or len(w) == 1 for w in words) and (best is None or cost(words) < best[0] - 1e-9):
            best = (cost(words), words)
    return best[0], cost


def test_segmentation():
    counts = {"the": 50, "here": 10, "there": 5, "re": 8, "in": 20, "a": 30, "an": 12, "thein": 1}
    split = urls.segmenter(counts)
    for run in ("thereina", "thein", "xthere", "anhere", "zzz", "a"):
        best, cost = split_by_hand(run, counts)
        words, at = [], 0
        for w in split(run):
            size = 1 if w == "?" else len(w)
            words.append(run[at:at + size])
            at += size
        assert "".join(words) == run and cost(words) == pytest.approx(best)


def verdict_by_hand(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule, verdict in urls.RULES:
        domain, tail = rule.split("/", 1)
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + tail):
            if best is None or len(rule) > len(best[0]):
                best = (rule, verdict)
    return host, path, best


def test_urls(spark):
    odd = ["http://A.example.ORG/es/x?q#f", "http://example.org", "http://example.org?x=/en/1", None, "no scheme", "",
           "x://y://z.com/de/1", "https://example.org/en/12#a", "http://notexample.org/es/1", "ftp://www.com/fr/É", "a://com/de/"]
    rows = [(1000 + i, u, "<p>the here</p>") for i, u in enumerate(odd)]
    pages = read(spark, SF, "pages").select("page_id", "url", "html").unionByName(
        spark.createDataFrame(rows, "page_id long, url string, html string"))
    asked = {r["page_id"]: r["url"] for r in pages.collect()}
    got = urls.judge(pages).collect()
    assert len(got) == len(asked)
    for r in got:
        host, path, best = verdict_by_hand(asked[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, best and best[0])
        assert r["verdict"] == (best[1] if best else ("block" if r["p_block"] > 0.5 else "allow"))


def test_naive_bayes_odds(spark):
    """p_block equals a naive Bayes written out over the same tokens."""
    pages = read(spark, SF, "pages")
    counts = urls.unigrams(pages)
    split, seen = urls.segmenter(counts), {"allow": Counter(), "block": Counter()}
    got, size = urls.judge(pages).collect(), Counter()
    for r in got:
        if r["rule"]:
            seen[r["verdict"]].update(urls.tokens(r["host"], r["path"], split))
            size[r["verdict"]] += 1
    vocabulary = len({*seen["allow"], *seen["block"]}) + 1
    for r in got[:50]:
        odds = math.log((size["block"] + 1) / (size["allow"] + 1))
        for t in urls.tokens(r["host"], r["path"], split):
            if t in seen["allow"] or t in seen["block"]:
                odds += math.log((seen["block"][t] + 1) / (sum(seen["block"].values()) + vocabulary)
                                 / (seen["allow"][t] + 1) * (sum(seen["allow"].values()) + vocabulary))
        assert r["p_block"] == pytest.approx(1 / (1 + math.exp(-odds)), rel=1e-6, abs=1e-12)


def test_rare_words_stay_in_a_large_vocabulary(spark):
    """A word seen once still splits a host when the pages hold more than 100,000 other words."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    name = lambda i: "q" + "".join(letters[i // 26 ** k % 26] for k in range(4))
    many = " ".join(f"{name(i)} {name(i)}" for i in range(110_000))
    rows = [(1, "http://bluebadger.com/fr/", "<p>blue badger</p>"), (2, "http://rest.com/de/", many),
            (3, "http://badger.net/x", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in urls.judge(pages).collect()}
    split, seen = urls.segmenter(urls.unigrams(pages)), {"allow": Counter(), "block": Counter()}
    assert split("bluebadger") == ("blue", "badger")
    for i in (1, 2):
        seen[got[i]["verdict"]].update(urls.tokens(got[i]["host"], got[i]["path"], split))
    size, vocabulary = {k: sum(c.values()) for k, c in seen.items()}, len({*seen["allow"], *seen["block"]}) + 1
    odds = sum(math.log((seen["block"][t] + 1) / (size["block"] + vocabulary) / (seen["allow"][t] + 1) * (size["allow"] + vocabulary))
               for t in urls.tokens("badger.net", "/x", split) if t in seen["allow"] or t in seen["block"])
    assert got[3]["p_block"] == pytest.approx(1 / (1 + math.exp(-odds)), rel=1e-6)
