"""Search, sharding, archive, near-duplicate and passage operators against
plain Python versions."""

import base64
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from riskloom.llm import neardup, sharding, substring, topk, warc
from riskloom.llm.components import components
from riskloom.llm.store import new_path


def test_components(spark):
    rnd = random.Random(3)
    links = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)] + [(7, 7), (None, 3)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in links:
        if u is not None and u != v:
            a, b = find(u), find(v)
            parent[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in list(parent)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def _hamming_rows(rows, queries, bits, k):
    code = lambda e: tuple(x is not None and x > 0 for x in e[:bits])
    ok = [(i, code(e)) for i, e in rows if e is not None and len(e) >= bits]
    out = []
    for q, c in {(i, code(e)) for i, e in queries if e is not None and len(e) >= bits}:
        near = sorted((sum(a != b for a, b in zip(c, d)), i is None, i or 0) for i, d in ok)[:k]
        out += [(q, None if none else i, d, r) for r, (d, none, i) in enumerate(near, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [20, 70])
def test_topk_is_exact(spark, bits):
    rnd = np.random.default_rng(bits)
    base = rnd.normal(size=(40, bits))
    rows = [(i, [float(x) for x in base[i % 40] + rnd.normal(scale=0.4, size=bits)]) for i in range(300)]
    rows += [(1000 + i, rows[5][1]) for i in range(30)] + [(1, None), (None, rows[7][1]), (2, [1.0]), (3, [None] * bits)]
    df = spark.createDataFrame([(i, e, 1, "x") for i, e in rows], "vec_id long, embedding array<double>, n int, code string")
    queries = df.filter("vec_id % 100 = 0 or vec_id < 4")
    asked = [(i, e) for i, e in rows if i is not None and (i % 100 == 0 or i < 4)]
    got = topk.search(df, queries, bits, k=7).collect()
    assert sorted((tuple(r[c] for c in ("query_id", "neighbour_id", "distance", "rank")) for r in got),
                  key=str) == _hamming_rows(rows, asked, bits, 7)


def test_topk_empty_and_few(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert topk.search(df, df, 16).count() == 0
    two = spark.createDataFrame([(1, [1.0] * 16), (2, [-1.0] * 16)], df.schema)
    assert [tuple(r) for r in topk.search(two, two.filter("vec_id = 1"), 16).orderBy("rank").collect()] == [(1, 1, 0, 1), (1, 2, 16, 2)]


def _least_capacity(sizes, n):
    def fits(c):
        used, at = 1, 0
        for x in sizes:
            if at + x > c:
                used, at = used + 1, 0
            at += x
        return used <= n

    low, high = max(max(sizes), -(-sum(sizes) // n)), sum(sizes)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    return low


@pytest.mark.parametrize("per_range", [1, 3, 2048])
def test_sharding_is_minimax(spark, monkeypatch, per_range):
    monkeypatch.setattr(sharding, "GROUPS_PER_RANGE", per_range)
    monkeypatch.setattr(sharding, "ROWS_PER_SLOT_BLOCK", 7)
    rnd = random.Random(per_range)
    rows = [(i, "x" * rnd.randrange(40) + str(rnd.randrange(150)), 1, "k", 2) for i in range(400)]
    rows += [(500 + i, "hot copy", 1, "k", 2) for i in range(150)] + [(1, None, 1, "k", 2), (None, "", 1, "k", 2), (3, "a", 1, "k", 2), (3, "a", 1, "k", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, size int, key string, shard int")
    got = sharding.shard_documents(df).collect()
    group = Counter()
    for r in rows:
        group[hashlib.sha256((r[1] or "").encode()).hexdigest()] += len((r[1] or "").encode()) + 1
    total = Counter()
    slots = {}
    for r in got:
        total[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert len(got) == len(rows) and max(total.values()) == _least_capacity([group[k] for k in sorted(group)], 8)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(8))
    assert len({r["shard"] for r in got if r["doc_id"] is not None and 500 <= r["doc_id"] < 650}) == 1
    assert sharding.shard_documents(df.limit(0)).count() == 0
    assert {r["shard"] for r in sharding.shard_documents(df.filter("text = 'a'")).collect()} == {0}


def test_sharding_fetches_few_groups(spark, monkeypatch):
    """A text with a third of the bytes, early in the order, leaves all cuts behind it open."""
    monkeypatch.setattr(sharding, "GROUPS_PER_RANGE", 4)
    rnd = random.Random(9)
    sizes = {hashlib.sha256(str(i).encode()).hexdigest(): rnd.randrange(90, 110) for i in range(4000)}
    sizes["1" + "0" * 63] = 200_000
    groups = spark.createDataFrame(list(sizes.items()), "key string, size bigint")
    frame, fetched = type(groups), []
    collect = frame.collect

    def counted(self):
        rows = collect(self)
        fetched.extend(r["key"] for r in rows if "key" in r)
        return rows

    monkeypatch.setattr(frame, "collect", counted)
    cuts = sharding._cut_keys(groups, 8)
    assert 0 < len(fetched) < 1000
    total = Counter()
    for key, size in sizes.items():
        total[sum(key > c for c in cuts)] += size
    assert max(total.values()) == _least_capacity([sizes[k] for k in sorted(sizes)], 8)
    monkeypatch.setattr(sharding, "MAX_FETCHED", 1)
    with pytest.raises(ValueError):
        sharding._cut_keys(groups, 8)


def test_warc_round_trip(spark):
    rnd = random.Random(4)
    big = "".join(rnd.choice("abc \r\né<>") for _ in range(5000))
    rows = [(1, "http://a/1", big), (2, "http://a/2", big), (3, None, None), (4, "http://a b/\n4", ""), (5, "u", "x\r\n\r\ny"),
            (6, "u", "WARC/1.1\r\n\r\n"), (6, "u", "WARC/1.1\r\n\r\n"), (None, "n", "null id"), (7, "u", "é" * 3000)]
    rows += [(100 + i, "h", "hot") for i in range(50)]
    df = spark.createDataFrame([(*r, 1, "s") for r in rows], "page_id long, url string, html string, row int, sha string")
    path = new_path(spark, "warc-test")
    warc.write_archives(df, path, segment_bytes=1000)
    got = warc.read_archives(spark, path, with_payload=True).collect()
    top = {}
    for i, _, h in rows:
        top[h or ""] = max(top.get(h or "", -1), -1 if i is None else i)
    want = Counter()
    for i, _, h in rows:
        p = (h or "").encode()
        want[(i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode())] += 1
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"]) for r in got) == want
    by_payload = {base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(): h for h in top}
    for r in got:
        h = by_payload[r["payload_digest"]]
        if r["record_type"] == "response":
            assert bytes(r["payload"]) == h.encode() and r["refers_to"] is None
            assert (r["page_id"] if r["page_id"] is not None else -1) == top[h]
        else:
            assert r["refers_to"] == top[h]
    assert Counter(r["record_type"] for r in got)["response"] == len(top)
    assert warc.round_trip(df.limit(0)).count() == 0
    every = warc.round_trip(df, min_revisit_bytes=10).filter("payload_bytes < 10").collect()
    assert {r["record_type"] for r in every} == {"response"}
    # rows are named alike in whatever order they come
    plain = Counter(tuple(r) for r in warc.round_trip(df).collect())
    hot = df.unionByName(df.filter("page_id > 99"))
    assert Counter(tuple(r) for r in warc.round_trip(df.repartition(7)).collect()) == plain
    assert Counter(tuple(r) for r in warc.round_trip(df.repartition(5, "html")).collect()) == plain
    twice = warc.round_trip(hot.repartition(7)).filter("page_id > 99").groupBy("record_type").count().collect()
    assert {r[0]: r[1] for r in twice} == {"response": 1, "revisit": 99}


def test_warc_faults_are_found():
    block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + warc.frame_chunks(b"hello", 2)
    assert warc.payload_of(block) == (b"hello", 5)
    with pytest.raises(ValueError):
        warc.unframe_chunks(b"5\r\nabc\r\n0\r\n\r\n")
    with pytest.raises(ValueError):
        list(warc.parse_archive(b"junk"))
    raw = warc.record([(b"WARC-Type", b"response")], b"x") + b"\r\n\r\n"
    assert [b for _, b in warc.parse_archive(raw * 2)] == [b"x", b"x"]
    with pytest.raises(ValueError):
        list(warc.parse_archive(raw[:-2] + b"zz"))


def _sets(t, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    if not w:
        return set()
    return {tuple(w)} if len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def _near(rows, k, percent):
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, _sets(t, k)) for i, t in rows]
    for a, (i, s) in enumerate(sets):
        for j, t in sets[a + 1:]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in rows}


def _copies(rnd, n, words=60, edits=12):
    vocab = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    while len(rows) < n:
        base = [rnd.choice(vocab) for _ in range(rnd.randint(3, words))]
        for _ in range(rnd.choice([1, 1, 1, 2, 6, 25])):
            w = list(base)
            for _ in range(rnd.randrange(edits) // 4):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            rows.append((i, " ".join(w) if rnd.random() < 0.9 else " ".join(w).upper() + "\n"))
            i += 1
    return rows


def test_near_duplicates_are_exact(spark):
    rows = _copies(random.Random(8), 400) + [(9001, None), (9002, ""), (9003, " \n"), (9004, "one two"), (9005, "One two"),
                                            (9006, "one")]
    df = spark.createDataFrame([(i, t, 1, "k", 2.0) for i, t in rows], "doc_id long, text string, n int, key string, id double")
    got = neardup.near_duplicates(df, words=4).collect()
    want = _near(rows, 4, 80)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) and r["n_shingles"] == len(_sets(dict(rows)[r["doc_id"]], 4)) for r in got)
    left = neardup.first_of_each(df, words=4)
    assert left.columns == df.columns and {r["doc_id"] for r in left.collect()} == {i for i, c in want.items() if i == c}


def test_near_duplicates_of_odd_rows(spark):
    long = " ".join(f"a{i}" for i in range(30_000))
    rows = [(1, "a b c d e f g h"), (1, "a b c d e f g h"), (None, "a b c d e f g h"), (2, "x y z u v w"), (2, "p q r s t o n"),
            (3, "p q r s t o n"), (4, long), (5, long + " end"), (6, "p q r s t o n")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r["doc_id"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(df).collect())
    assert got == Counter({(1, 1, True): 2, (None, None, True): 1, (2, 2, True): 2, (3, 2, False): 1, (4, 4, True): 1,
                           (5, 4, False): 1, (6, 2, False): 1})
    assert Counter(r["doc_id"] for r in neardup.first_of_each(df).collect()) == Counter({1: 1, None: 1, 2: 2, 4: 1})
    assert neardup.near_duplicates(df.limit(0)).count() == 0 and neardup.first_of_each(df.limit(0)).count() == 0


def test_sketch_estimates_similarity():
    rnd = np.random.default_rng(1)
    for n, same in ((1, 1), (3, 2), (50, 40), (2000, 1600)):
        agree, true = [], 2 * same / (2 * n) if n == same else same / (2 * n - same)
        for _ in range(30):
            items = rnd.integers(0, 2 ** 63, 2 * n - same, dtype=np.uint64)
            a, b = neardup.sketch(items[:n], 96), neardup.sketch(items[n - same:], 96)
            assert (a != neardup._EMPTY).all()
            agree.append((a == b).mean())
        assert abs(np.mean(agree) - true) < 0.06


def test_anchors_are_shared_by_every_long_passage():
    rnd = np.random.default_rng(2)
    for _ in range(50):
        passage = rnd.integers(0, 2 ** 63, 46, dtype=np.uint64)
        found = []
        for n in (0, 7, 33):
            h = np.concatenate([rnd.integers(0, 2 ** 63, n, dtype=np.uint64), passage, rnd.integers(0, 2 ** 63, 25, dtype=np.uint64)])
            at = substring.anchors(h, np.zeros(len(h), np.int64), substring.WINNOW) - n
            found.append({int(x) for x in at if 0 <= x <= 20})
        assert set.intersection(*found)
    h = rnd.integers(0, 2 ** 63, 200, dtype=np.uint64)
    want = {i + int(np.argmin(h[i:i + 21])) for i in range(180)}
    assert set(substring.anchors(h, np.zeros(200, np.int64), 21).tolist()) == want


def test_passages_are_removed_once(spark):
    rnd = random.Random(9)
    vocab = [f"v{i}" for i in range(3000)]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    passage, line = text(60), text(45)
    near = line.split()
    near[2] = "changed"
    rows = [(1, f"{text(40)} {passage} {text(30)}"), (2, f"{text(33)}\n{text(9)} {passage}"), (3, f"{passage} {text(50)}"),
            (4, f"{text(80)}\n{line}\n{text(5)}"), (5, f"{text(20)}\n{' '.join(near)}\n{text(25)}"), (6, text(200)), (7, None), (8, ""),
            (9, "é " * 10), (10, passage), (11, text(7)), (11, text(8))]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, first int, key string")
    spans = substring.repeated_spans(df).collect()
    assert {r["doc_id"] for r in spans} == {2, 3, 5, 10}
    # document 10 is also similar, as a line, to the line of document 2 that ends in the passage
    assert {tuple(r["kept_ids"]) for r in spans} == {(1,), (4,), (1, 2)}
    out = {r["doc_id"]: r["text"] for r in substring.remove_repeats(df).filter("doc_id != 11").collect()}
    assert [i for i, t in out.items() if t and passage in t] == [1]
    for i in (1, 4, 6, 7, 8, 9):
        assert out[i] == dict(rows)[i]
    assert " ".join(near) not in out[5] and out[5].startswith(rows[4][1][:40]) and out[5].endswith(rows[4][1][-40:])
    assert substring.remove_repeats(df).columns == df.columns
    raw = dict(rows)
    for r in spans:
        cut = raw[r["doc_id"]].encode()[r["start"]:r["stop"]].decode()
        assert len(cut.split()) >= 20
    assert substring.repeated_spans(df.limit(0)).count() == 0 and substring.remove_repeats(df.limit(0)).count() == 0


def test_bands_follow_the_recall():
    b = substring.bands_for(0.8, 3, 0.999)
    assert 1 - (1 - 0.8 ** 3) ** b >= 0.999 > 1 - (1 - 0.8 ** 3) ** (b - 1)


def test_passages_outlive_the_lines_they_are_in(spark):
    rnd = random.Random(21)
    fresh = lambda n: ["".join(rnd.choice("abcdefghij") for _ in range(8)) for _ in range(n)]
    shared, inner = fresh(50), fresh(50)
    one, two = fresh(300), fresh(300)
    docs = {1: one, 2: one[:150] + shared + one[150:]}                       # 2's line goes: 1's is similar
    docs |= {i: fresh(60) + shared + fresh(60) for i in range(3, 7)}
    docs |= {11: two, 12: two[:150] + inner + two[150:], 13: two[:150] + inner + two[150:]}
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    left = {r["doc_id"]: r["text"] for r in substring.remove_repeats(df).collect()}
    holders = lambda words: [i for i in sorted(left) if " ".join(words) in left[i]]
    assert holders(one) == [1] and holders(two) == [11] and 2 not in left and 13 not in left
    assert holders(shared) == [3]                                            # outside a line that goes
    units = [holders(inner[i:i + 30]) for i in range(21)]                    # only in lines that go: the first
    assert [12] in units and all(h in ([], [12]) for h in units)


def test_staying_passages_are_not_cut():
    spans = [{"first": 0, "last": 30, "kept_id": 1}, {"first": 20, "last": 50, "kept_id": 2}, {"first": 90, "last": 99, "kept_id": 3}]
    assert substring._outside(spans, [(5, 10), (25, 40), (60, 95)]) == [
        (0, 5, 1), (10, 25, 1), (20, 25, 2), (40, 50, 2), (95, 99, 3)]


def test_columns_with_clashing_names_come_back_as_they_were(spark):
    words = [f"w{i}" for i in range(70)]
    a, b = " ".join(words), "own " + " ".join(words) + " tail"
    rows = [(1, a), (2, b), (3, a), (1, "other text of one id"), (1, a), (None, a)]
    names = ["__spans", "__key", "row", "spans", "cut", "id", "hash", "of", "__text"]
    df = spark.createDataFrame([(i, t, *[f"{c}{k}" for c in names]) for k, (i, t) in enumerate(rows)],
                               "doc_id long, text string, " + ", ".join(f"{c} string" for c in names))
    cut = substring.remove_repeats(df).collect()
    assert cut and all(r[c].startswith(c) and len({r[c][len(c):] for c in names}) == 1 for r in cut for c in names)
    assert sum((r["text"] or "").count(a) for r in cut) == 1
    kept = neardup.first_of_each(df).collect()
    assert all(r[c].startswith(c) for r in kept for c in names)
    assert Counter(r["doc_id"] for r in kept) == {1: 2, None: 1}
