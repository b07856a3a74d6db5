"""Global ranks and prefix sums without a single-task window.

A plain ``row_number() over (partition by class order by ...)`` puts a whole
class (92 % of the rows here) into one task. Instead:

1. give every row a bucket that is monotone in the sort key,
2. count per (group, bucket): a table of at most groups x buckets rows,
3. running totals over that small table give each bucket's offset,
4. join the offsets back and rank / sum only inside (group, bucket).

Buckets for hash ranks are the high bits of the hash (uniform by
construction); for value ranks they come from approximate quantiles of the
distinct values, so ties never straddle buckets and skewed values (one value
holding a third of the rows) collapse to a single row before ranking.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows per bucket the window step is sized for: a task sorts whole (wide) rows of a
# bucket. The offset table has a row per (group, bucket), so it stays a
# fifty-thousandth of the rows; Spark broadcasts it if its size allows.
TARGET_ROWS_PER_BUCKET = 50_000
MAX_BUCKET_BITS = 62


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join that matches NULL keys with each other; the key columns are ``left``'s."""
    names = {c: f"__right_{c}" for c in on}
    r = right.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in right.columns])
    cond = None
    for c in on:
        e = left[f"`{c}`"].eqNullSafe(r[names[c]])
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*names.values())


def bucket_bits(n_rows: int, target: int | None = None) -> int:
    target = TARGET_ROWS_PER_BUCKET if target is None else target
    if n_rows <= target:
        return 0
    return min(MAX_BUCKET_BITS, math.ceil(math.log2(n_rows / target)))


def _offsets(counts: DataFrame, group_cols: list[str], measures: list[str]) -> DataFrame:
    """Exclusive running sums of ``measures`` over buckets, per group (small table)."""
    w = Window.partitionBy(*group_cols).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*group_cols, "__b",
                         *[F.coalesce(F.sum(m).over(w), F.lit(0)).alias(f"__off_{m}") for m in measures])


def hash_rank(df: DataFrame, id_col: str, seed: int = 42, group_cols: list[str] | None = None,
              rank_col: str = "rank", n_rows: int | None = None) -> DataFrame:
    """1-based rank of each row inside its group, ordered by ``xxhash64(id, seed)``
    (id breaks hash ties). Deterministic under retries and partition changes."""
    group_cols = list(group_cols or [])
    if n_rows is None:
        n_rows = df.count()
    bits = bucket_bits(n_rows)
    h = F.xxhash64(F.col(id_col), F.lit(seed))
    x = df.withColumn("__h", h).withColumn("__b", F.shiftright(F.col("__h"), 64 - bits) if bits else F.lit(0))
    counts = x.groupBy(*group_cols, "__b").agg(F.count(F.lit(1)).alias("__n"))
    offsets = _offsets(counts, group_cols, ["__n"])
    w = Window.partitionBy(*group_cols, "__b").orderBy("__h", id_col)
    return (null_safe_join(x, offsets, group_cols + ["__b"])
            .withColumn(rank_col, F.col("__off___n") + F.row_number().over(w))
            .drop("__h", "__b", "__off___n"))


def buckets_per_group(df: DataFrame, groups: int) -> int:
    """Value buckets of each of ``groups`` about equal groups: about four for every task
    of the session's shuffle in all, not that many in each group."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(tasks, -(-4 * tasks // max(groups, 1))))


def cumulative_below(df: DataFrame, value_col: str, measures: dict[str, Column],
                     group_cols: list[str] | None = None,
                     n_buckets: int | None = None) -> DataFrame:
    """For each distinct (group, value): the sum of each measure at that value
    and the sum over all strictly smaller values (``below_<name>``).

    Ties are one row, so a value shared by a third of the table costs one
    row. Quantile boundaries come from one aggregate over the distinct values
    (at most groups x n_buckets doubles), broadcast back for bucketing.
    """
    user_groups = list(group_cols or [])
    if not user_groups:
        df = df.withColumn("__g", F.lit(0))
    group_cols = user_groups or ["__g"]
    names = list(measures)
    vc = (df.filter(F.col(value_col).isNotNull())
          .groupBy(*group_cols, F.col(value_col).alias("__v"))
          .agg(*[F.sum(e).alias(n) for n, e in measures.items()]))
    if n_buckets is None:
        # as many as the session's shuffle has tasks: no job runs while the plan is built
        n_buckets = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if n_buckets <= 1:
        x = vc.withColumn("__b", F.lit(0))
    else:
        probs = [i / n_buckets for i in range(1, n_buckets)]
        # the measures are carried along, so that this branch keeps all columns of
        # the distinct-value table and Spark reuses its exchange instead of a second scan
        bounds = vc.groupBy(*group_cols).agg(
            F.percentile_approx(F.col("__v").cast("double"), F.array(*[F.lit(p) for p in probs]), 10000)
            .alias("__bounds"), *[F.max(n).alias(f"__max_{n}") for n in names])
        v = F.col("__v").cast("double")
        x = null_safe_join(vc, bounds.drop(*[f"__max_{n}" for n in names]), group_cols)
        x = x.withColumn("__b", F.size(F.filter(F.array_distinct("__bounds"), lambda b: b < v))).drop("__bounds")
    counts = x.groupBy(*group_cols, "__b").agg(*[F.sum(n).alias(n) for n in names])
    offsets = _offsets(counts, group_cols, names)
    w = Window.partitionBy(*group_cols, "__b").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    out = null_safe_join(x, offsets, group_cols + ["__b"])
    return out.select(*user_groups, F.col("__v").alias(value_col), *names,
                      *[(F.col(f"__off_{n}") + F.coalesce(F.sum(n).over(w), F.lit(0))).alias(f"below_{n}")
                        for n in names])


def average_rank(df: DataFrame, value_col: str, group_cols: list[str] | None = None,
                 n_buckets: int | None = None) -> DataFrame:
    """Average (tie-aware) 1-based rank per distinct (group, value), with its count."""
    cb = cumulative_below(df, value_col, {"n": F.lit(1)}, group_cols, n_buckets)
    return cb.select(*(group_cols or []), value_col, "n",
                     (F.col("below_n") + (F.col("n") + 1) / 2.0).alias("avg_rank"))
