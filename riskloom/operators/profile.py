"""Data-quality profiling: summaries, missing rates, constants, keys, relations.

Every report is one (or two) aggregate jobs over the table, never a loop of
per-column jobs; per-column results are produced as one wide row and turned
into rows with ``unpivot``. Duplicates and key statistics are exact (group by
the full row or the key); the shuffles carry at most one row per distinct
value and task thanks to partial aggregation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.nulls import is_floating, is_numeric
from riskloom.operators.longform import PLACE, long_form, named


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _is_missing(f: T.StructField) -> Column:
    c = _c(f.name)
    if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def column_stats(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, rows, n_missing, lo, hi) for every column in one aggregate.

    The table is brought to (column, value) rows (doubles and strings
    separately) and grouped by column: a handful of aggregate expressions
    whatever the width, so the plan stays code-generated; partial aggregation
    keeps the shuffle at one row per column and task. ``lo``/``hi`` are the
    non-missing min and max as text for string columns.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    num = [f.name for f in fields if not isinstance(f.dataType, T.StringType)]
    txt = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    parts = []
    if num:
        miss = F.col("v").isNull() | F.isnan("v")
        parts.append(named(long_form(df, num, value="v").groupBy(PLACE).agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(miss).alias("n_missing"),
            F.min(F.when(~miss, F.col("v"))).cast("string").alias("lo"),
            F.max(F.when(~miss, F.col("v"))).cast("string").alias("hi")), num))
    if txt:
        parts.append(named(long_form(df, txt, value="v", kind="string").groupBy(PLACE).agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(F.col("v").isNull()).alias("n_missing"),
            F.min("v").alias("lo"), F.max("v").alias("hi")), txt))
    return _union(parts)


def _is_constant() -> Column:
    return (F.col("n_missing") == F.col("rows")) | ((F.col("n_missing") == 0) & (F.col("lo") == F.col("hi")))


def table_summary(df: DataFrame, name: str) -> DataFrame:
    """rows, columns, full-row duplicates, missing cells and rate (4 dp),
    numeric and text column counts.

    Rows and missing cells need no shuffle. For the duplicates, rows are first
    grouped by two 64-bit hashes; only rows whose hashes occur more than once are
    compared in full. Whether there are any is asked before the comparison is planned
    (a join shuffles both sides before it knows one to be empty), so a table without
    duplicates moves its hashes and counts only.
    """
    fields = df.schema.fields
    n_cols = len(fields)
    def hashed(seed):
        # -0.0 equals 0.0 as a grouping key, so it hashes as 0.0
        return F.xxhash64(F.lit(seed), *[(_c(f.name) + F.lit(0.0)) if is_floating(f.dataType) else _c(f.name) for f in fields])

    keyed = df.select(hashed(1).alias("__h1"), hashed(2).alias("__h2"), *[_c(f.name) for f in fields])
    again = (keyed.groupBy("__h1", "__h2").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").drop("__n"))
    if again.isEmpty():
        keyed = keyed.limit(0)                      # nothing to compare in full
    same = (keyed.join(again, ["__h1", "__h2"], "left_semi").groupBy("__h1", "__h2", *[_c(f.name) for f in fields])
            .agg(F.count(F.lit(1)).alias("__n")))
    dup = same.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("long").alias("duplicates"))
    missing_in_row = reduce(lambda a, b: a + b, [_is_missing(f).cast("long") for f in fields])
    n_numeric = sum(1 for f in fields if is_numeric(f.dataType))
    n_text = sum(1 for f in fields if isinstance(f.dataType, T.StringType))
    out = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(missing_in_row), F.lit(0)).cast("long").alias("total_missing_values"),
    )
    out = out.withColumn("__k", F.lit(0)).join(dup.withColumn("__k", F.lit(0)), "__k").drop("__k")
    return out.select(
        F.lit(name).alias("table"), "rows", F.lit(n_cols).alias("columns"), "duplicates",
        "total_missing_values",
        F.round(F.try_divide(F.col("total_missing_values").cast("double"), F.col("rows") * n_cols), 4)
        .alias("missing_rate"),
        F.lit(n_numeric).alias("numeric_columns"), F.lit(n_text).alias("categorical_columns"),
    )


def missing_report(df: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """(column, missing_count, missing_rate), rate descending, then column name."""
    cols = [c for c in df.columns if c not in exclude]
    st = column_stats(df, cols)
    return (st.select("column", F.col("n_missing").cast("long").alias("missing_count"),
                      F.try_divide(F.col("n_missing").cast("double"), F.col("rows")).alias("missing_rate"))
            .orderBy(F.desc("missing_rate"), F.asc("column")))


def missing_rate(df: DataFrame) -> DataFrame:
    return missing_report(df).select("column", "missing_rate")


def dataset_summary(tables: dict[str, DataFrame], target: str = "TARGET") -> DataFrame:
    """Per named table: rows, columns, missing cells, rate (4 dp), has_target."""
    parts = []
    for name, df in tables.items():
        fields = df.schema.fields
        miss = reduce(lambda a, b: a + b, [_is_missing(f).cast("long") for f in fields])
        parts.append(df.agg(F.count(F.lit(1)).alias("rows"),
                            F.coalesce(F.sum(miss), F.lit(0)).cast("long").alias("total_missing_values"))
                     .select(F.lit(name).alias("dataset"), "rows", F.lit(len(fields)).alias("columns"),
                             "total_missing_values",
                             F.round(F.try_divide(F.col("total_missing_values").cast("double"),
                                                  F.col("rows") * len(fields)), 4).alias("missing_rate"),
                             F.lit(target in df.columns).alias("has_target")))
    return _union(parts)


def _with_total(counts: DataFrame, col: str) -> DataFrame:
    """Attach the column total (a one-row aggregate) through a constant-key join."""
    total = counts.agg(F.sum(col).alias("__total")).withColumn("__k", F.lit(0))
    return counts.withColumn("__k", F.lit(0)).join(F.broadcast(total), "__k").drop("__k")


def target_distribution(df: DataFrame, target: str = "TARGET") -> DataFrame:
    """(target_value, count, rate); a missing target is its own group."""
    counts = df.groupBy(_c(target).alias("target_value")).agg(F.count(F.lit(1)).alias("count"))
    return _with_total(counts, "count").select("target_value", "count",
                                               (F.col("count") / F.col("__total")).alias("rate"))


def target_percent(df: DataFrame, target: str = "TARGET") -> DataFrame:
    """(target, percentage) over non-missing targets, rounded to 2 places."""
    counts = df.filter(_c(target).isNotNull()).groupBy(_c(target).alias("target")).agg(
        F.count(F.lit(1)).alias("n"))
    return _with_total(counts, "n").select(
        "target", F.round(F.col("n") * 100.0 / F.col("__total"), 2).alias("percentage"))


def constant_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Columns with at most one distinct value, missing counted as a value
    (all missing, or no missing and min = max): one aggregate pass."""
    return [r["column"] for r in constant_report(df, exclude).collect()]


def constant_report(df: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    cols = [c for c in df.columns if c not in exclude]
    return column_stats(df, cols).filter(_is_constant()).select("column").orderBy("column")


def high_missing_columns(df: DataFrame, threshold: float = 0.80,
                         protected: tuple[str, ...] = ("TARGET", "SK_ID_CURR")) -> DataFrame:
    """(column, missing_rate) with rate >= threshold, protected columns excluded."""
    rep = missing_report(df, exclude=protected)
    return rep.filter(F.col("missing_rate") >= threshold).select("column", "missing_rate")


def drop_decision(train: DataFrame, threshold: float = 0.80,
                  protected: tuple[str, ...] = ("TARGET", "SK_ID_CURR")) -> DataFrame:
    """(column, reason) for columns to drop, learned on train only.

    Both statistics come from one pass over the table. ``reason`` is
    ``high_missing``, ``constant`` or ``high_missing_and_constant``.
    """
    cols = [c for c in train.columns if c not in protected]
    st = column_stats(train, cols)
    high = F.try_divide(F.col("n_missing").cast("double"), F.col("rows")) >= threshold
    konst = _is_constant()
    reason = (F.when(high & konst, "high_missing_and_constant")
              .when(high, "high_missing").when(konst, "constant"))
    return st.select("column", reason.alias("reason")).filter(F.col("reason").isNotNull()).orderBy("column")


def key_profile(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Per (table, key): exists, rows, unique, missing, duplicated rows,
    max and mean rows per key (2 dp, the missing key counted as a group)."""
    parts = []
    for name, (df, keys) in tables.items():
        for key in keys:
            if key not in df.columns:
                parts.append(df.agg(F.count(F.lit(1)).alias("rows")).select(
                    F.lit(name).alias("table"), F.lit(key).alias("key"), F.lit(False).alias("key_exists"),
                    "rows", F.lit(None).cast("long").alias("unique_keys"),
                    F.lit(None).cast("long").alias("missing_keys"),
                    F.lit(None).cast("long").alias("duplicated_key_rows"),
                    F.lit(None).cast("long").alias("max_rows_per_key"),
                    F.lit(None).cast("double").alias("mean_rows_per_key")))
                continue
            per_key = df.groupBy(_c(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
            parts.append(per_key.agg(
                F.sum("n").alias("rows"),
                F.count("k").alias("unique_keys"),
                F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).alias("missing_keys"),
                (F.sum("n") - F.count(F.lit(1))).alias("duplicated_key_rows"),
                F.max("n").alias("max_rows_per_key"),
                F.round(F.avg("n"), 2).alias("mean_rows_per_key"),
            ).select(F.lit(name).alias("table"), F.lit(key).alias("key"), F.lit(True).alias("key_exists"),
                     F.col("rows").cast("long"), F.col("unique_keys").cast("long"),
                     F.col("missing_keys").cast("long"), F.col("duplicated_key_rows").cast("long"),
                     F.col("max_rows_per_key").cast("long"), "mean_rows_per_key"))
    return _union(parts)


def relation_profile(relations: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Per (parent, child, key): unique keys on both sides, common,
    parent-only, child-only, mean and max child rows per key.

    Key-set algebra is one full outer join of per-key counts; no key set ever
    reaches the driver.
    """
    parts = []
    for parent_name, parent, child_name, child, key in relations:
        pk = parent.filter(_c(key).isNotNull()).groupBy(_c(key).alias("k")).agg(F.lit(1).alias("in_parent"))
        ck = child.filter(_c(key).isNotNull()).groupBy(_c(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
        j = pk.join(ck, "k", "full_outer")
        parts.append(j.agg(
            F.count_if(F.col("in_parent").isNotNull()).alias("parent_unique_keys"),
            F.count_if(F.col("n").isNotNull()).alias("child_unique_keys"),
            F.count_if(F.col("in_parent").isNotNull() & F.col("n").isNotNull()).alias("common_keys"),
            F.count_if(F.col("in_parent").isNotNull() & F.col("n").isNull()).alias("parent_only_keys"),
            F.count_if(F.col("in_parent").isNull() & F.col("n").isNotNull()).alias("child_only_keys"),
            F.round(F.avg("n"), 2).alias("mean_child_rows_per_key"),
            F.max("n").alias("max_child_rows_per_key"),
        ).select(F.lit(parent_name).alias("parent_table"), F.lit(child_name).alias("child_table"),
                 F.lit(key).alias("key"), "*"))
    return _union(parts)


def hash_sample(df: DataFrame, n: int, id_col: str, seed: int = 42) -> DataFrame:
    """Deterministic sample of exactly ``min(n, rows)`` rows: the n smallest
    ``xxhash64(id, seed)``. Planned as a per-partition top-n plus a merge
    (TakeOrderedAndProject); only n rows ever move."""
    h = F.xxhash64(_c(id_col), F.lit(seed))
    return df.withColumn("__h", h).orderBy("__h", id_col).limit(n).drop("__h")


def missing_pattern(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Co-missing structure: one '0'/'1' mask per row (1 = missing), counted."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    mask = F.concat(*[F.when(_is_missing(f), F.lit("1")).otherwise(F.lit("0")) for f in fields])
    return df.groupBy(mask.alias("pattern")).agg(F.count(F.lit(1)).alias("rows"))
