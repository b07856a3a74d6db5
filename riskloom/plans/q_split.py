"""Stratified split, sample and k-fold queries (checked on counts: the
hash-based row choice cannot be reproduced by another engine)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import split
from riskloom.plans.catalog import register
from riskloom.plans.oracle import with_ctes
from riskloom.sources import testbed as tb


def _quota_sql(total_expr: str) -> str:
    """Largest-remainder quotas per class of app_train, for ``total_expr`` rows."""
    return with_ctes("app", "app_train") + f""",
t AS (SELECT TARGET AS label, count(*) AS n FROM app_train GROUP BY 1),
tot AS (SELECT sum(n) AS total, CAST({total_expr} AS BIGINT) AS nv FROM t),
ex AS (SELECT label, n, nv * n / total::DOUBLE AS e FROM t, tot),
fl AS (SELECT label, n, floor(e) AS f, e - floor(e) AS r FROM ex),
lft AS (SELECT (SELECT nv FROM tot) - sum(f) AS l FROM fl),
rk AS (SELECT label, n, f, row_number() OVER (ORDER BY r DESC, CAST(label AS VARCHAR)) AS rr FROM fl),
qt AS (SELECT label, n, CAST(f + CASE WHEN rr <= (SELECT l FROM lft) THEN 1 ELSE 0 END AS BIGINT) AS qv FROM rk)
"""


@register("stratified_split", lambda: _quota_sql("ceil(0.2 * sum(n))") + """
SELECT 'valid' AS part, label, qv AS rows FROM qt UNION ALL SELECT 'train', label, n - qv FROM qt""")
def stratified_split(spark, sf):
    """20 % hold-out with class shares kept: rows per (part, label)."""
    df = tb.application_train(spark, sf)
    train, valid = split.stratified_split(df, "TARGET", "SK_ID_CURR", 0.2, seed=42)
    return (train.select(F.lit("train").alias("part"), F.col("TARGET").alias("label"))
            .unionByName(valid.select(F.lit("valid").alias("part"), F.col("TARGET").alias("label")))
            .groupBy("part", "label").agg(F.count(F.lit(1)).alias("rows")))


# Fixed value: the reference's sample size (quotas below it are tested in pytest).
SAMPLE_ROWS = 80_000


@register("stratified_sample", lambda: _quota_sql(str(SAMPLE_ROWS)) + """
SELECT label, CASE WHEN (SELECT total FROM tot) <= nv THEN n ELSE qv END AS rows FROM qt, tot""")
def stratified_sample(spark, sf):
    df = tb.application_train(spark, sf)
    s = split.stratified_sample(df, "TARGET", "SK_ID_CURR", SAMPLE_ROWS, seed=42)
    return s.groupBy(F.col("TARGET").alias("label")).agg(F.count(F.lit(1)).alias("rows"))


@register("kfold_sizes", with_ctes("app", "app_train") + """,
r AS (SELECT TARGET AS label, row_number() OVER (PARTITION BY TARGET ORDER BY SK_ID_CURR) AS rn FROM app_train),
o AS (SELECT label, COALESCE(sum(count(*)) OVER (ORDER BY CAST(label AS VARCHAR)
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM r GROUP BY label)
SELECT CAST((off + rn - 1) % 3 AS INTEGER) AS fold, label, count(*) AS rows
FROM r JOIN o USING (label) GROUP BY 1, 2""")
def kfold_sizes(spark, sf):
    """Stratified 3-fold assignment: rows per (fold, label)."""
    df = split.stratified_kfold(tb.application_train(spark, sf), "TARGET", "SK_ID_CURR", k=3, seed=42)
    return df.groupBy("fold", F.col("TARGET").alias("label")).agg(F.count(F.lit(1)).alias("rows"))
