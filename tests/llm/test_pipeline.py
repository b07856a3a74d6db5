"""The pipeline's stages and the registered queries."""

from collections import Counter

import pytest

pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"


def test_registered():
    import __spark_entry__ as entry
    import corpus_pipeline

    names = set(entry.queries())
    for n in range(1, 11):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "quality_rules", "near_dedup", "substring_dedup", "best_fit_packing"]


def test_stages_keep_columns_and_pack_what_is_left(spark):
    import corpus_pipeline as cp
    from riskloom.llm import bpe
    from riskloom.llm.queries import byte_bpe_path
    from riskloom.llm.store import written

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clash = docs.limit(0).selectExpr("*", "1 as n", "'k' as key", "2 as id").schema
    odd = spark.createDataFrame([(-1, None, "en", "s", 0, 1, "k", 2), (-2, "", None, None, None, 1, "k", 2),
                                 (-3, "12 34", "en", "s", 5, 1, "k", 2)], clash)
    docs = docs.selectExpr("*", "1 as n", "'k' as key", "2 as id").unionByName(odd)
    sizes = []
    for name, stage in cp.STAGES[:-1]:
        out = written(stage(spark, docs, SF), name)
        assert out.columns == docs.columns, name
        before = {r["doc_id"] for r in docs.select("doc_id").collect()}
        after = Counter(r["doc_id"] for r in out.select("doc_id").collect())
        assert set(after) <= before and max(after.values()) == 1
        sizes.append(len(after))
        docs = out
    assert 200 >= sizes[0] >= sizes[1] > sizes[2] >= sizes[3] > 100
    assert docs.filter("n_chars != char_length(text)").count() == 0
    pieces = cp.STAGES[-1][1](spark, docs, SF).collect()
    c = bpe.codec(byte_bpe_path())
    total = sum(len(c.encode(r["text"])) + 1 for r in docs.select("text").collect())
    assert sum(r["length"] for r in pieces) == total and {r["doc_id"] for r in pieces} == {r["doc_id"] for r in docs.collect()}


def test_stages_take_empty_tables(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        docs_out = stage(spark, docs, SF)
        assert docs_out.count() == 0
