"""Token, quality and language operators against plain Python versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from riskloom.llm import bpe, langid, packing, quality, unigram

public_tokenizers = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "a b"), (4, "a b"), (None, "null id"), (5, "x" * 70_000),
       (6, "word " * 9000), (7, "né 日本 🙂<|endoftext|> tail"), (8, "12\n\n!!  's 're  ")]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, long and repeated texts, and columns named like internal ones."""
    rows = [(i, t, "L", 1, 2, 3, 4) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, id string, key int, n int, ids int, piece int")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def _tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE)


def test_round_trip_is_the_tokenizers(spark, odd, none):
    tok = _tokenizer()
    got = bpe.encode_decode(odd, BPE, leaf_bytes=4096, with_ids=True).collect()
    assert len(got) == len(ODD)
    want = Counter()
    for i, t in ODD:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        dec = tok.decode(ids, skip_special_tokens=False)
        want[(i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
              hashlib.sha256(dec.encode()).hexdigest(), tuple(ids))] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], tuple(r["ids"])) for r in got) == want
    assert bpe.encode_decode(none, BPE).count() == 0


def test_joins_and_chunks_are_exact():
    tok, c = _tokenizer(), bpe.codec(BPE)
    rnd = random.Random(5)
    parts = ["a", "the", " ", "  ", "\n", "\t", "'s", "'re", "'", "!", "é", "日本", "🙂", "1", "23", "　", "<|endoftext|>",
             "<|", "x" * 30, "\u0085", "\x1c", " \n", "ll"]
    for _ in range(300):
        s = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 50)))
        want = tok.encode(s, add_special_tokens=False).ids
        assert c.encode_batch(pa.array([s]))[0].tolist() == want, repr(s)
        sections = {}
        for k, _, x in bpe.leaf_texts(s, c, rnd.choice([5, 17, 64])):
            sections.setdefault(k, []).append(x)
        ids = []
        for k, xs in sections.items():
            ids += ([c.special[xs[0]]] if k % 2 else c.join_all([(x, c.encode_section(x)) for x in xs]).tolist())
        assert ids == want, repr(s)


def test_unsplit_runs_join_by_windows():
    tok, c = _tokenizer(), bpe.codec(BPE)
    rnd = random.Random(6)
    for k in range(12):
        run = "".join(rnd.choice("abcdefgh" if k % 2 else "ab") for _ in range(9000)) + " " * (k * 50) + "z"
        assert c.encode(run).tolist() == tok.encode(run, add_special_tokens=False).ids


def test_packing(spark, odd, none):
    tok = _tokenizer()
    rows = packing.pack_documents(odd, BPE, capacity=256, open_bins=4, with_ids=True).collect()
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
    for b in bins.values():
        b.sort()
        assert [o for o, _ in b] == [sum(n for _, n in b[:k]) for k in range(len(b))] and sum(n for _, n in b) <= 256
    docs = {}
    for r in sorted(rows, key=lambda r: (str(r["doc_id"]), r["piece"])):
        docs.setdefault(r["doc_id"], []).append(r)
    for i, t in ODD:
        if i != 4:
            ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
            assert [x for r in docs[i] for x in r["ids"]] == ids
            assert all(r["length"] == 256 for r in docs[i][1:])
    assert len(docs[4]) == 2 and packing.pack_documents(none, BPE).count() == 0


@pytest.mark.parametrize("tasks, merge_pieces", [(1, 1 << 18), (97, 1 << 18), (97, 16)])
def test_sequences_do_not_grow_with_the_tasks(spark, tasks, merge_pieces):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = packing.pack_documents(docs.repartition(tasks, "doc_id"), BPE, merge_pieces=merge_pieces, with_ids=True).collect()
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
    for b in bins.values():
        b.sort()
        assert [o for o, _ in b] == [sum(n for _, n in b[:k]) for k in range(len(b))] and sum(n for _, n in b) <= 2048
    assert len({(r["doc_id"], r["piece"]) for r in rows}) == len(rows) and {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.collect()}
    least = -(-sum(r["length"] for r in rows) // 2048)
    assert len(bins) <= (1.02 if merge_pieces > 16 else 1.1) * least + 1


def test_best_fit_closes_the_fullest():
    b = packing.BestFit(10, 2)
    assert [b.put(n) for n in (6, 7, 3, 5, 5, 4)] == [(0, 0), (1, 0), (1, 7), (2, 0), (2, 5), (0, 6)]
    b = packing.BestFit(10, 2)
    for n in (6, 7, 5):
        b.put(n)                                        # the third bin closes the one with 7
    assert b.put(3) == (0, 6)
    assert b.put(4) == (2, 5)


def test_unigram_counts_are_the_tokenizers(spark, odd, none):
    from tokenizers import Tokenizer, models, normalizers

    def reference(pieces, fallback):
        t = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=fallback))
        t.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
        return t

    pieces = unigram.vocabulary(PIECES)
    t, c, rnd = reference(pieces, True), unigram.counter(PIECES), random.Random(2)
    parts = ["a", "the", " ", "  ", "\n", "▁", "é", "日", "🙂", "ing", "zzz", "<0x0A>", "<unk>", "\x00", "ẞ"]
    small = [("<unk>", 0.0), ("▁", -1.0), ("a", -1.0), ("b", -2.0), ("ab", -3.0), ("ba", -3.0), ("▁a", -2.0), ("aba", -4.0)]
    t2, c2 = reference(small, False), unigram.Counter(small)
    for _ in range(400):
        s = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25)))
        assert c.count_batch(pa.array([s]))[0] == len(t.encode(s, add_special_tokens=False).ids), repr(s)
        s = "".join(rnd.choice("ab cz") for _ in range(rnd.randint(0, 14)))
        assert c2.count_batch(pa.array([s]))[0] == len(t2.encode(s).ids), repr(s)
    got = Counter((r["doc_id"], r["n_tokens"], r["n_bytes"]) for r in unigram.token_counts(odd, PIECES).collect())
    assert got == Counter((i, len(t.encode(x or "", add_special_tokens=False).ids), len((x or "").encode())) for i, x in ODD)
    assert unigram.token_counts(none, PIECES).count() == 0


WORD = r"[^\x20\x09-\x0D]+"


def _base(t):
    t = t or ""
    w = re.findall(WORD, t)
    lines = [x for x in t.split("\n") if re.search(WORD, x)]
    tri = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
    hit = {k + j for k in range(len(w) - 2) if tri[tuple(w[k:k + 3])] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


def test_quality_character_grams():
    texts = ["naïve 日本語テキスト 🙂🙃 abcd", "", None, "é日", "abcdabcd", "日本語テキスト"]
    w = quality.Words.of(pa.array(texts))
    char, doc = quality.characters(w)
    assert [bytes(x.tobytes()).rstrip(b"\0").decode() for x in char] == list("".join(t or "" for t in texts))
    assert doc.tolist() == [i for i, t in enumerate(texts) for _ in t or ""]
    owner, bucket = quality.features(w)[2]
    grams = [(i, t[k:k + 4]) for i, t in enumerate(texts) if t for k in range(len(t) - 3)]
    assert owner.tolist() == [i for i, _ in grams]
    same = {}
    for (_, g), b in zip(grams, bucket.tolist()):
        assert same.setdefault(g, b) == b                      # a bucket hangs on the four characters alone
    assert len(set(same.values())) == len(same)


def test_quality_base_columns(spark, odd, none):
    model = quality.Model(np.zeros((3, 1 << quality.BUCKET_BITS), np.float32), 5.0)
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(["a", "b", "cé", " ", "\n", "#", "\t", "\n\n", "$"]) for _ in range(rnd.randint(0, 120)))
             for _ in range(200)] + [t for _, t in ODD]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality.apply_rules(df, model).collect():
        want = _base(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and r["kept"] == (not r["base_failed"])
    assert quality.apply_rules(odd, model).count() == len(ODD)
    assert quality.apply_rules(none, model).count() == 0
    assert quality.filter_documents(odd, model).columns == odd.columns


def test_quality_model_separates_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.train(docs.filter("doc_id % 3 != 0"), labels)
    rows = quality.apply_rules(docs.filter("doc_id % 3 = 0"), model).join(labels, "doc_id").collect()
    good = [r["quality_probability"] for r in rows if r["quality"] == 1]
    bad = [r["quality_probability"] for r in rows if r["quality"] == 0]
    auc = np.mean([[(g > b) + 0.5 * (g == b) for b in bad] for g in good])
    assert auc > 0.9 and np.mean([g >= quality.THRESHOLD for g in good]) > 0.97


def test_quality_without_labels_keeps(spark, none, odd):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.train(odd, labels)
    assert model.probability(quality.scores(model, quality.Words.of(pa.array(["some text"])), 1))[0] > 0.9
    nulls = spark.createDataFrame([(1, None), (None, 1), (7, 1), (7, 0)], "doc_id long, quality int")
    assert quality.train(odd, nulls).weights.shape[0] == 3


def test_language_id(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    net = langid.train(docs.filter(~langid.held_out()))
    rows = langid.predict(docs.filter(langid.held_out()), net).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
    extra = spark.createDataFrame([(9, "12 34 !!"), (10, None)], "doc_id long, text string")
    assert {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(extra, net).collect()} == {
        9: ("und", 0.0), 10: ("und", 0.0)}
    assert langid.predict(odd, net).count() == len(ODD) and langid.predict(none, net).count() == 0
    assert langid.train(none).langs == []
    assert langid.predict(extra, langid.train(none)).filter("lang_pred = 'und'").count() == 2
    assert langid.filter_documents(odd, net).columns == odd.columns


def test_language_windows_cover_the_text():
    offs = np.array([0, 0, 5, 600, 856])
    s, e, d = langid.window_starts(offs)
    for k in range(4):
        covered = sorted({p for a, b, x in zip(s, e, d) if x == k for p in range(a, b)})
        assert covered == list(range(offs[k], offs[k + 1]))
