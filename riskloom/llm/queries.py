"""Registered queries ``opN_<name>`` of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm.store import bounded_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@register("op4_best_fit_packing")
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm import packing

    return packing.pack_documents(table(spark, sf_dir, "documents"), byte_bpe_path())


@register("op7_bpe_round_trip")
def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm import bpe

    return bpe.encode_decode(table(spark, sf_dir, "documents"), byte_bpe_path())


@register("op3_quality_rules")
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm import quality

    docs = table(spark, sf_dir, "documents")
    return quality.apply_rules(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@register("op9_language_id")
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm import langid

    docs = table(spark, sf_dir, "documents")
    net = langid.train(docs.filter(~langid.held_out()))
    return langid.predict(docs, net).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


@register("op5_sharding")
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm import sharding

    return sharding.shard_documents(table(spark, sf_dir, "documents"))


@register("op8_warc_segments", sql="""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, h, sha1(h) AS hex, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((('0x' || substr(hex, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM d""")
def op8_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm import warc

    return warc.round_trip(table(spark, sf_dir, "pages"))


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@register("op2_token_counts")
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm import unigram

    return unigram.token_counts(table(spark, sf_dir, "documents"), piece_model_path())


EMBEDDING_BITS = 64


@register("op1_exact_topk", sql="""
WITH v AS (SELECT vec_id, embedding FROM embeddings WHERE embedding IS NOT NULL),
q AS (SELECT vec_id AS query_id, embedding AS e FROM v WHERE vec_id % 100 = 0),
d AS (SELECT query_id, vec_id AS neighbour_id,
             list_sum(list_transform(range(1, 65), lambda i: ((e[i] > 0) != (embedding[i] > 0))::INT))::INT AS distance
      FROM q, v),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id)::INT AS rank FROM d)
SELECT query_id, neighbour_id, distance, rank FROM r WHERE rank <= 10""")
def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm import topk

    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors.filter("vec_id % 100 = 0"), EMBEDDING_BITS)


@register("op10_minhash_near_dedup", sql="""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
          JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
          GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (any_value(na.n) + any_value(nb.n) - count(*))),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.b FROM r JOIN links l ON l.a = r.y),
c AS (SELECT x, min(y) AS component_id FROM r GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c ON c.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""")
def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm import neardup

    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=4)


@register("op6_substring_dedup")
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm import substring

    return substring.repeated_spans(table(spark, sf_dir, "documents"))


@register("op12_spelling_forms")
def op12_spelling_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm import spelling

    return spelling.spelling_forms(table(spark, sf_dir, "documents"))


@register("op11_ranked_search", sql=r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
g AS (SELECT count(*)::BIGINT AS n_docs, sum(len(ts))::BIGINT AS total FROM t WHERE len(ts) > 0),
p AS (SELECT r, any_value(doc_id) AS doc_id, term, count(*)::BIGINT AS tf, any_value(n)::BIGINT AS n
      FROM (SELECT r, doc_id, len(ts) AS n, unnest(ts) AS term FROM t) GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, g GROUP BY term, n_docs),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT item_id, r, any_value(doc_id) AS doc_id,
             sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // total))))::BIGINT AS score
      FROM q JOIN p USING (term) JOIN w USING (term), g GROUP BY item_id, r),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 50""")
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm import lexical

    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op13_ngram_join", sql="""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
          JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
          GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 90 * (any_value(na.n) + any_value(nb.n) - count(*))),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.b FROM r JOIN links l ON l.a = r.y),
c AS (SELECT x, min(y) AS component_id FROM r GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM documents d JOIN c ON c.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""")
def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riskloom.llm import ngramjoin

    return ngramjoin.similarity_join(table(spark, sf_dir, "documents"))
