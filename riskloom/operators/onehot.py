"""One-hot encoding as a fitted vocabulary plus a pure projection.

The vocabulary (distinct values per text column, sorted) is the only thing
that reaches the driver; its size is checked in Spark before collecting.
The transform adds, per column, one 0/1 column per value plus ``COL_nan``,
after all passthrough columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Vocabulary = dict[str, list[str]]


def text_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def vocabulary_frame(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value) for every distinct non-NULL value: one job for all columns."""
    long = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns]).unpivot(
        [], columns, "column_name", "value")
    return long.filter(F.col("value").isNotNull()).distinct()


def fit_vocabulary(df: DataFrame, columns: list[str] | None = None,
                   exclude: tuple[str, ...] = (), max_values: int | None = None) -> Vocabulary:
    """Distinct sorted values per text column (the dynamic part of the schema).

    One job: the distinct (column, value) pairs (a spillable hash aggregate)
    are collected; every value becomes a column, so the driver needs them all.
    A caller that wants a bound gives ``max_values``: then at most
    ``max_values * columns + 1`` rows reach the driver, and a wider column raises.
    """
    columns = text_columns(df, exclude) if columns is None else list(columns)
    if not columns:
        return {}
    found = vocabulary_frame(df, columns)
    rows = (found if max_values is None else found.limit(max_values * len(columns) + 1)).collect()
    vocab: Vocabulary = {c: [] for c in columns}
    for row in rows:
        vocab[row["column_name"]].append(row["value"])
    if max_values is not None:
        wide = [(c, len(v)) for c, v in vocab.items() if len(v) > max_values]
        if wide or len(rows) > max_values * len(columns):
            raise ValueError(f"more than {max_values} values: {wide}")
    return {c: sorted(v) for c, v in vocab.items()}


def dummy_names(vocab: Vocabulary) -> list[str]:
    return [f"{c}_{v}" for c, values in vocab.items() for v in values + ["nan"]]


def dummy_columns(vocab: Vocabulary, dtype: str = "tinyint") -> list[Column]:
    cols = []
    for c, values in vocab.items():
        src = F.col(f"`{c}`")
        for v in values:
            cols.append(F.coalesce(src == F.lit(v), F.lit(False)).cast(dtype).alias(f"{c}_{v}"))
        cols.append(src.isNull().cast(dtype).alias(f"{c}_nan"))
    return cols


def transform(df: DataFrame, vocab: Vocabulary, dtype: str = "tinyint") -> DataFrame:
    """Replace each vocabulary column by its dummies (one ``select``)."""
    passthrough = [F.col(f"`{c}`") for c in df.columns if c not in vocab]
    return df.select(*passthrough, *dummy_columns(vocab, dtype))


def share_names(vocab: Vocabulary, prefix: str, agg: str = "mean") -> list[str]:
    """Names of ``share_columns``, in order."""
    return [f"{prefix}_{c}_{v}_{agg}".upper() for c, values in vocab.items() for v in [*values, "nan"]]


def share_columns(vocab: Vocabulary, prefix: str, agg: str = "mean") -> list[Column]:
    """Per-group share of each category (the mean of its dummy) without
    materialising dummies: ``avg(c = v)`` with NULL counting as 0."""
    out = []
    for c, values in vocab.items():
        src = F.col(f"`{c}`")
        for v in values:
            out.append(F.avg(F.when(src == F.lit(v), 1.0).otherwise(0.0))
                       .alias(f"{prefix}_{c}_{v}_{agg}".upper()))
        out.append(F.avg(F.when(src.isNull(), 1.0).otherwise(0.0)).alias(f"{prefix}_{c}_nan_{agg}".upper()))
    return out


def category_share_wide(df: DataFrame, key: str, column: str, values: list[str],
                        prefix: str) -> DataFrame:
    """Shares for a wide vocabulary via pivot counts divided by group size.

    ``pivot`` with an explicit value list avoids the extra distinct job, and the
    partial aggregation keeps the shuffle at one row per (key, value) and task.
    """
    counts = (df.withColumn("__v", F.coalesce(F.col(f"`{column}`"), F.lit("__nan__")))
              .groupBy(key).pivot("__v", values + ["__nan__"]).count())
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    j = counts.join(sizes, key)
    return j.select(key, *[
        (F.coalesce(F.col(f"`{v}`"), F.lit(0)) / F.col("__n"))
        .alias(f"{prefix}_{column}_{'nan' if v == '__nan__' else v}_mean".upper())
        for v in values + ["__nan__"]
    ])
