"""Corpus pipeline: five stages that turn raw documents into packed sequences.

Each stage takes the documents that the one before kept, written as Parquet and
read again, and returns the columns of ``documents``; the last returns pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import langid, neardup, packing, quality, substring
from riskloom.llm.queries import byte_bpe_path, table
from riskloom.llm.store import bounded_batches, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the network knows; null texts, texts without a
    letter and texts of no clear language go."""
    bounded_batches(spark)
    return langid.filter_documents(docs, langid.train(docs))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that meet the base rules and the calibrated classifier."""
    return quality.filter_documents(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, 0.8)."""
    return neardup.first_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that another place keeps; ``n_chars``
    follows the text, and a document without a word left goes."""
    out = substring.remove_repeats(docs)
    if "n_chars" in out.columns:
        kind = out.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.char_length("text").cast(kind))
    return out


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 2048 tokens."""
    return packing.pack_documents(docs, byte_bpe_path())


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: Trained models, sketches and a tokenizer: SQL expresses none of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each to what the one before kept."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
