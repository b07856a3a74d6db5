"""Ranked search, spelling forms and the n-gram join against plain Python versions."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from riskloom.llm import bloom, lexical, ngramjoin, spelling


def _lower(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t or "")


def _ranked(docs, queries, k):
    terms = [re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", _lower(t)) for _, t in docs]
    n, total = sum(map(bool, terms)), sum(map(len, terms))
    df = Counter(t for ts in terms for t in set(ts))
    asked = defaultdict(set)
    for q, t in queries:
        asked[q] |= set(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", _lower(t)))
    out = []
    for q, own in asked.items():
        rows = []
        for (i, _), ts in zip(docs, terms):
            tf = Counter(ts)
            m = 50 + (50 * len(ts) * n) // max(total, 1)
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 20 * m))
                    for t in own if tf[t])
            if s > 0:
                rows.append((-s, i is None, i or 0))
        out += [(q, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(rows)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("segment_docs, first", [(1 << 16, 16), (7, 1)])
def test_ranked_search(spark, monkeypatch, segment_docs, first):
    monkeypatch.setattr(lexical, "FIRST_SEGMENTS", first)
    monkeypatch.setattr(lexical, "ROUND_GROWTH", 3)
    rnd = random.Random(segment_docs)
    words = ["the", "Of", "é1", "été", "x9", "名字", *(f"w{i}" for i in range(60))]
    text = lambda n: " ".join(words[min(int(rnd.expovariate(0.12)), len(words) - 1)] + rnd.choice(["", ",", "!?"]) for _ in range(n))
    docs = [(i, text(rnd.randrange(1, 40))) for i in range(160)] + [(None, "the w1"), (500, None), (501, ""), (502, "?!")]
    docs += [(600 + i, "w50 w51 same") for i in range(9)] + [(3, docs[3][1]), (700, text(3000))]
    queries = [(q, text(rnd.randrange(1, 12))) for q in range(12)] + [(50, None), (51, "..."), (52, "absent"), (2, "w50 w51"), (None, "é1 the")]
    left = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in docs], "doc_id long, text string, term int, segment int, ids string").repartition(3)
    right = spark.createDataFrame([(q, t, 0) for q, t in queries], "item_id long, text string, block int")
    index = lexical.build_index(left, segment_docs=segment_docs)
    got = sorted((tuple(r) for r in lexical.search(index, right, 6).collect()), key=str)
    assert got == _ranked(docs, queries, 6)


def test_ranked_search_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.rank_documents(docs.limit(0), items).count() == 0
    assert lexical.rank_documents(docs, items.limit(0)).count() == 0


def test_pair_bounds_hold_and_skip():
    rnd = np.random.default_rng(5)
    for _ in range(60):
        held = []
        for _ in range(6):
            d = np.flatnonzero(rnd.random(300) < rnd.choice([0.05, 0.5])).astype(np.uint16)
            held.append((d, rnd.integers(1, 1000, len(d))) if len(d) else (np.array([1], np.uint16), np.array([3])))
        top = [int(x.max()) for _, x in held]
        dense = np.zeros((6, 300), dtype=np.int64)
        for t, (d, x) in enumerate(held):
            dense[t, d] = x
        pairs = {}
        for a in range(6):
            for b in range(a + 1, 6):
                both = np.flatnonzero((dense[a] > 0) & (dense[b] > 0))
                pairs[a, b] = (int((dense[a] + dense[b])[both].max(initial=0)), both.astype(np.uint16))
        units = lexical.units_of(list(range(6)), top, pairs)
        bound = sum(u[0] for u in units)
        whole = dense.sum(axis=0)
        assert whole.max() <= bound <= sum(top) and sorted(t for u in units for t in u[1:3] if t >= 0) == list(range(6))
        least = int(np.sort(whole)[-5])
        places, scores = lexical.best_of(300, held, top, pairs, list(range(6)), 5, least)
        assert {(int(p), int(s)) for p, s in zip(places, scores)} == {(int(p), int(whole[p])) for p in np.flatnonzero(whole >= least)}


def _forms(rows):
    n = Counter()
    for i, t in rows:
        for r in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            r = _lower(r)
            h = zlib.crc32(f"{'' if i is None else i}:{r}".encode())
            if h % 97 == 0:
                r = r[:h % len(r)] + r[h % len(r) + 1:]
            n[r] += len(r) >= 5
    n = {w: c for w, c in n.items() if c >= 3}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        a, b = sorted((a, b), key=len)
        p = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
        return a[p + (len(a) == len(b)):] == b[p + 1:]

    close = {w: [x for x in n if near(w, x)] for w in n}
    form = {}
    for w, xs in close.items():
        best = min(xs, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(close[w]), n.get(form[w])))
    return out


@pytest.mark.parametrize("max_group", [3, 500])
def test_spelling_forms(spark, max_group):
    rnd = random.Random(max_group)
    base = ["".join(rnd.choice("abé") for _ in range(rnd.randrange(4, 9))) for _ in range(60)] + ["aaaaaa", "aaaaaaa", "aaaaa", "z" * 300]
    words = list(base)
    for w in base:
        for _ in range(3):
            k = rnd.randrange(len(w))
            words.append(rnd.choice([w[:k] + w[k + 1:], w[:k] + "bc"[rnd.randrange(2)] + w[k:], w[:k] + "x" + w[k + 1:]]))
    rows = [(i, " ".join(rnd.choice(words).capitalize() + rnd.choice(["", ".", "9", "œ"]) for _ in range(rnd.randrange(30)))) for i in range(150)]
    rows += [(None, " ".join(words)), (7, None), (8, ""), (9, "ÀÿàÿÀ ×÷×÷× " * 4), (1, rows[1][1]), (10, "hotty " * 500 + "hottx " * 4)]
    df = spark.createDataFrame([(i, t, "w", 1) for i, t in rows], "doc_id long, text string, word string, n int").repartition(3)
    got = spelling.spelling_forms(df, max_group=max_group)
    assert {tuple(r) for r in got.select("word", "form", "root", "n", "n_near", "form_n").collect()} == _forms(rows)
    assert spelling.spelling_forms(df.limit(0)).count() == 0


def _joined(rows, words, percent):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", _lower(t))
        sets.append({tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, _) in enumerate(rows):
        for b, (j, _) in enumerate(rows[:a]):
            both = len(sets[a] & sets[b])
            if i is not None and j is not None and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return Counter((i, len(s), None if i is None else find(i)) for (i, _), s in zip(rows, sets))


@pytest.mark.parametrize("percent, block", [(90, 1 << 19), (60, 40)])
def test_similarity_join(spark, monkeypatch, percent, block):
    monkeypatch.setattr(ngramjoin, "BLOCK_SHINGLES", block)
    monkeypatch.setattr(ngramjoin, "BUCKET_SHINGLES", 4 * block)
    rnd = random.Random(percent)
    vocabulary = ["The", "of", "à", *(f"w{i}" for i in range(400))]
    rows = []
    for i in range(25):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randrange(3, 60))]
        for _ in range(rnd.randrange(1, 6)):                     # chains: each copy changes the one before
            rows.append((len(rows), " ".join(base)))
            for _ in range(rnd.randrange(1, 4)):
                base[rnd.randrange(len(base))] = rnd.choice(vocabulary)
            base += [rnd.choice(vocabulary)] * rnd.randrange(2)
    shared = " ".join(vocabulary[:40])
    rows += [(300 + i, f"{shared} own{i}") for i in range(12)] + [(400 + i, "a hot copy of some words") for i in range(40)]
    rows += [(500, None), (501, ""), (502, "two words"), (503, "TWO words"), (None, rows[0][1]), (None, None), (2, rows[-3][1]), (504, " \n ")]
    df = spark.createDataFrame([(i, t, 1, b"x") for i, t in rows], "doc_id long, text string, n int, cid binary").repartition(3)
    got = ngramjoin.similarity_join(df, min_percent=percent)
    assert Counter(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == _joined(rows, 3, percent)


def test_similarity_join_of_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, "a b c d")], "doc_id long, text string")
    assert ngramjoin.similarity_join(df.limit(0)).count() == 0
    assert sorted(tuple(r) for r in ngramjoin.similarity_join(df).collect()) == [(1, 0, 1), (2, 2, 2)]


def test_prefixes_of_links_meet():
    rnd = np.random.default_rng(2)
    rank = rnd.integers(0, 4, 4000).astype(np.uint8)
    for _ in range(300):
        a = np.unique(rnd.integers(0, 4000, 50))
        b = np.unique(np.concatenate([a[rnd.random(len(a)) < 0.97], rnd.integers(0, 4000, 2)]))
        if 100 * len(np.intersect1d(a, b)) >= 90 * len(np.union1d(a, b)):
            offs, sh = np.array([0, len(a), len(a) + len(b)]), np.concatenate([a, b])
            at, p = ngramjoin.prefix(offs, sh, rank[sh], 90)
            assert set(p[:at[1]]) & set(p[at[1]:])


def test_lengthened_prefixes_of_links_share_enough():
    rnd = np.random.default_rng(3)
    rank, links = rnd.integers(0, 4, 4000).astype(np.uint8), 0
    for percent in (90, 85, 60):
        for _ in range(300):
            a = np.unique(rnd.integers(0, 4000, rnd.integers(1, 80)))
            b = np.unique(np.concatenate([a[rnd.random(len(a)) < percent / 100 + 0.06], rnd.integers(0, 4000, 1)]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= percent * len(np.union1d(a, b)):
                offs, sh = np.array([0, len(a), len(a) + len(b)]), np.concatenate([a, b])
                at, p = ngramjoin.prefix(offs, sh, rank[sh], percent, extra=True)
                shared = len(set(p[:at[1]]) & set(p[at[1]:]))
                assert shared >= max(ngramjoin.least_shared(np.array([len(a), len(b)]), percent))
                links += 1
    assert links > 100


def test_a_shared_passage_alone_makes_no_candidates(spark):
    # 12 classes of 100 elements, of whose first 20 three are in all; two more are alike
    rows = [(bytes([i]), 100, [7, 8, 9, *range(1000 * i, 1000 * i + 17)]) for i in range(1, 13)]
    rows += [(bytes([i]), 100, [*range(50000, 50019), 60000 + i]) for i in (20, 21)]
    df = spark.createDataFrame(rows, "cid binary, n long, p1 array<bigint>")
    got = ngramjoin.shared_prefixes(df, "p1", 90).select("cid").distinct().collect()
    assert sorted(bytes(r[0]) for r in got) == [bytes([20]), bytes([21])]


def test_bloom_filter_keeps_every_key(spark):
    df = spark.range(5000).selectExpr("xxhash64(id) h")
    for log2 in (8, 27):
        words = bloom.build(df, max_log2=log2)
        keys = np.array([r[0] for r in df.collect()])
        assert bloom.test(words, keys).all()
    assert bloom.test(words, np.arange(1 << 40, (1 << 40) + 1000)).mean() < 0.9
    assert not bloom.test(bloom.build(df.limit(0)), keys).any()
