"""Correlation queries on the final train table."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import corr
from riskloom.plans import features as fx
from riskloom.plans import modeling
from riskloom.plans.catalog import finish, register
from riskloom.plans.oracle import finish_sql
from riskloom.plans.q_prep import final_dataset_parts

ID, TARGET = "SK_ID_CURR", "TARGET"
# The ranking rule of ``corr.significant`` in SQL.
SIGNIFICANT = ("CASE WHEN {v} = 0 OR pow(10.0e0, floor(log10(abs({v})))) = 0 THEN {v} ELSE "
               "round({v} / pow(10.0e0, floor(log10(abs({v})))), 11) * pow(10.0e0, floor(log10(abs({v})))) END")
SPREAD = "stddev_samp({v}) > 1e-12 * abs(avg({v}))"


def prepared_train(spark, sf):
    train, _ = fx.split_train_test(modeling.processed(spark, sf))
    return corr.numeric_prepare(train)


def _ft_sql() -> str:
    """final train as doubles with inf/NaN -> NULL (ftd)."""
    sql, _ = final_dataset_parts()
    return (sql + ", ft AS (SELECT * EXCLUDE (dataset_type) FROM final WHERE dataset_type = 'train'),\n"
            "ftn AS (SELECT COLUMNS(* EXCLUDE (SK_ID_CURR, TARGET))::DOUBLE, SK_ID_CURR, TARGET FROM ft),\n"
            f"lng AS (SELECT SK_ID_CURR, TARGET, \"column\", CASE WHEN isinf(v) OR isnan(v) THEN NULL "
            "ELSE v END AS v "
            "FROM ftn UNPIVOT INCLUDE NULLS (v FOR \"column\" IN (COLUMNS(* EXCLUDE (SK_ID_CURR, TARGET)))))\n")


def _numeric_prepare_sql() -> str:
    sql, items = final_dataset_parts()
    return finish_sql(sql + "SELECT * EXCLUDE (dataset_type) FROM final WHERE dataset_type = 'train'",
                      [n for n, d in items if d])


@register("numeric_prepare", _numeric_prepare_sql)
def numeric_prepare(spark, sf):
    """Numeric/bool columns of the final train, bool -> int, inf -> NULL."""
    return finish(prepared_train(spark, sf))


PEARSON_SQL = """pr AS (SELECT "column", CASE WHEN """ + SPREAD.format(v="v") + """ THEN corr(v, TARGET) END AS pearson
  FROM lng WHERE v IS NOT NULL GROUP BY "column"),
prr AS (SELECT "column", pearson, abs(pearson) AS abs_pearson FROM pr WHERE pearson IS NOT NULL AND NOT isnan(pearson))
"""


@register("pearson_target", lambda: finish_sql(_ft_sql() + ", " + PEARSON_SQL + "SELECT * FROM prr",
                                               ["pearson", "abs_pearson"]))
def pearson_target(spark, sf):
    """Pearson r of every feature with TARGET, constants dropped, by |r|."""
    df = prepared_train(spark, sf)
    return finish(corr.pearson_with_target(df, TARGET, [c for c in df.columns if c not in (ID, TARGET)]))


@register("spearman_target", lambda: finish_sql(_ft_sql() + """,
tie AS (SELECT "column", TARGET, """ + SIGNIFICANT.format(v="v") + """ AS v FROM lng WHERE v IS NOT NULL),
rk AS (SELECT "column", TARGET, rank() OVER (PARTITION BY "column" ORDER BY v)
          + (count(*) OVER (PARTITION BY "column", v) - 1) / 2.0e0 AS r FROM tie),
sp AS (SELECT "column", corr(r, TARGET) AS spearman FROM rk GROUP BY "column")
SELECT "column", spearman, abs(spearman) AS abs_spearman FROM sp WHERE spearman IS NOT NULL AND NOT isnan(spearman)""",
    ["spearman", "abs_spearman"]))
def spearman_target(spark, sf):
    """Spearman r (average ranks, pairwise complete) of every feature with TARGET."""
    df = prepared_train(spark, sf)
    return finish(corr.spearman_with_binary_target(df, TARGET, [c for c in df.columns if c not in (ID, TARGET)]))


@register("topk_corr", lambda: finish_sql(_ft_sql() + ", " + PEARSON_SQL
                                          + "SELECT * FROM prr ORDER BY abs_pearson DESC, \"column\" LIMIT 20",
                                          ["pearson", "abs_pearson"]))
def topk_corr(spark, sf):
    """The 20 features most correlated with TARGET (top-k report)."""
    df = prepared_train(spark, sf)
    rep = corr.pearson_with_target(df, TARGET, [c for c in df.columns if c not in (ID, TARGET)])
    return finish(corr.top_k(rep, "abs_pearson", 20))


@register("correlated_pairs", lambda: finish_sql(_ft_sql() + """,
pairs AS (SELECT a."column" AS col_a, b."column" AS col_b,
                 CASE WHEN """ + SPREAD.format(v="a.v") + " AND " + SPREAD.format(v="b.v") + """ THEN corr(a.v, b.v) END AS r
          FROM lng a JOIN lng b ON a.SK_ID_CURR = b.SK_ID_CURR AND a."column" < b."column"
          WHERE a.v IS NOT NULL AND b.v IS NOT NULL GROUP BY 1, 2)
SELECT col_a, col_b, r, abs(r) AS abs_r FROM pairs WHERE NOT isnan(r) AND abs(r) > 0.9""", ["r", "abs_r"]))
def correlated_pairs(spark, sf):
    """Feature pairs with |r| > 0.90 (pairwise complete), from per-task Gram blocks."""
    df = prepared_train(spark, sf)
    return finish(corr.correlated_pairs(df, [c for c in df.columns if c not in (ID, TARGET)]))


MATRIX_COLUMNS = ["TARGET", "DAYS_EMPLOYED_PERC", "INCOME_CREDIT_PERC", "PAYMENT_RATE", "BURO_DAYS_CREDIT_MEAN",
                  "BURO_AMT_CREDIT_SUM_SUM", "PREV_APP_CREDIT_PERC_MEAN", "APPROVED_AMT_CREDIT_MEAN",
                  "POS_CNT_INSTALMENT_MEAN", "INSTAL_DPD_MEAN", "INSTAL_PAYMENT_PERC_MEAN", "CC_AMT_BALANCE_MEAN",
                  "CC_COUNT"]


@register("corr_matrix", lambda: finish_sql(_ft_sql() + """,
lt AS (SELECT SK_ID_CURR, "column", v FROM lng UNION ALL SELECT SK_ID_CURR, 'TARGET', TARGET FROM ft),
sel AS (SELECT * FROM lt WHERE "column" IN (""" + ", ".join(f"'{c}'" for c in MATRIX_COLUMNS) + """))
SELECT a."column" AS col_a, b."column" AS col_b,
       CASE WHEN """ + SPREAD.format(v="a.v") + " AND " + SPREAD.format(v="b.v") + """ AND NOT isnan(corr(a.v, b.v))
            THEN greatest(least(corr(a.v, b.v), 1.0e0), -1.0e0) END AS r
FROM (SELECT a.SK_ID_CURR, a."column", a.v FROM sel a) a JOIN sel b ON a.SK_ID_CURR = b.SK_ID_CURR
WHERE (a.v IS NOT NULL AND b.v IS NOT NULL) GROUP BY 1, 2""", ["r"]))
def corr_matrix(spark, sf):
    """Full Pearson matrix (long form) of selected features and TARGET."""
    return finish(corr.pearson_matrix(prepared_train(spark, sf), MATRIX_COLUMNS, upper_only=False))


@register("spearman_matrix", lambda: finish_sql(_ft_sql() + """,
lt AS (SELECT SK_ID_CURR, "column", v FROM lng UNION ALL SELECT SK_ID_CURR, 'TARGET', TARGET FROM ft),
sel AS (SELECT * FROM lt WHERE "column" IN (""" + ", ".join(f"'{c}'" for c in MATRIX_COLUMNS) + """) AND v IS NOT NULL),
tie AS (SELECT SK_ID_CURR, "column", """ + SIGNIFICANT.format(v="v") + """ AS v FROM sel),
pr AS (SELECT a."column" AS col_a, b."column" AS col_b, a.v AS x, b.v AS y
       FROM tie a JOIN tie b ON a.SK_ID_CURR = b.SK_ID_CURR),
rk AS (SELECT col_a, col_b,
         rank() OVER (PARTITION BY col_a, col_b ORDER BY x) + (count(*) OVER (PARTITION BY col_a, col_b, x) - 1) / 2.0e0 AS rx,
         rank() OVER (PARTITION BY col_a, col_b ORDER BY y) + (count(*) OVER (PARTITION BY col_a, col_b, y) - 1) / 2.0e0 AS ry
       FROM pr)
SELECT col_a, col_b, CASE WHEN isnan(corr(rx, ry)) THEN NULL
                          ELSE greatest(least(corr(rx, ry), 1.0e0), -1.0e0) END AS r
FROM rk GROUP BY 1, 2""", ["r"]))
def spearman_matrix(spark, sf):
    """Pairwise-complete Spearman matrix (long form) of selected features and TARGET."""
    return finish(corr.spearman_matrix(prepared_train(spark, sf), MATRIX_COLUMNS, ID))


# The matrices of the report: TARGET and the features that lead the ranked report
# of the same method, 25 and 30 of them.
SPEARMAN_SQL = """tie AS (SELECT "column", TARGET, """ + SIGNIFICANT.format(v="v") + """ AS v FROM lng WHERE v IS NOT NULL),
rk AS (SELECT "column", TARGET, rank() OVER (PARTITION BY "column" ORDER BY v)
          + (count(*) OVER (PARTITION BY "column", v) - 1) / 2.0e0 AS r FROM tie),
sp AS (SELECT "column", corr(r, TARGET) AS spearman FROM rk GROUP BY "column"),
spr AS (SELECT "column", abs(spearman) AS abs_spearman FROM sp WHERE spearman IS NOT NULL AND NOT isnan(spearman))
"""


def _order_sql(v: str) -> str:
    """``v`` in the places in which the report ranks it (``_leading``)."""
    return f"round({v}, {ORDER_DIGITS})"


ORDER_DIGITS = 9                   # engines sum in different orders: equal columns tie, the name decides


def _leading(report, by: str, k: int) -> list[str]:
    """TARGET and the ``k`` columns that lead ``report``."""
    ranked = report.withColumn(by, F.round(by, ORDER_DIGITS))
    return [TARGET, *[r["column"] for r in corr.top_k(ranked, by, k).collect()]]


def _features(df) -> list[str]:
    return [c for c in df.columns if c not in (ID, TARGET)]


def _top_pearson_sql(k: int) -> str:
    return finish_sql(_ft_sql() + ", " + PEARSON_SQL + f""",
top AS (SELECT "column" FROM prr ORDER BY {_order_sql('abs_pearson')} DESC, "column" LIMIT {k}),
sel AS (SELECT SK_ID_CURR, "column", v FROM lng WHERE "column" IN (SELECT "column" FROM top)
        UNION ALL SELECT SK_ID_CURR, 'TARGET', TARGET FROM ft)
SELECT a."column" AS col_a, b."column" AS col_b,
       CASE WHEN """ + SPREAD.format(v="a.v") + " AND " + SPREAD.format(v="b.v") + """ AND NOT isnan(corr(a.v, b.v))
            THEN greatest(least(corr(a.v, b.v), 1.0e0), -1.0e0) END AS r
FROM sel a JOIN sel b ON a.SK_ID_CURR = b.SK_ID_CURR
WHERE (a.v IS NOT NULL AND b.v IS NOT NULL) GROUP BY 1, 2""", ["r"])


def _top_spearman_sql(k: int) -> str:
    return finish_sql(_ft_sql() + ", " + SPEARMAN_SQL + f""",
top AS (SELECT "column" FROM spr ORDER BY {_order_sql('abs_spearman')} DESC, "column" LIMIT {k}),
sel AS (SELECT SK_ID_CURR, "column", v FROM lng WHERE "column" IN (SELECT "column" FROM top) AND v IS NOT NULL
        UNION ALL SELECT SK_ID_CURR, 'TARGET', TARGET FROM ft WHERE TARGET IS NOT NULL),
tied AS (SELECT SK_ID_CURR, "column", """ + SIGNIFICANT.format(v="v") + """ AS v FROM sel),
pr AS (SELECT a."column" AS col_a, b."column" AS col_b, a.v AS x, b.v AS y
       FROM tied a JOIN tied b ON a.SK_ID_CURR = b.SK_ID_CURR),
rks AS (SELECT col_a, col_b,
         rank() OVER (PARTITION BY col_a, col_b ORDER BY x) + (count(*) OVER (PARTITION BY col_a, col_b, x) - 1) / 2.0e0 AS rx,
         rank() OVER (PARTITION BY col_a, col_b ORDER BY y) + (count(*) OVER (PARTITION BY col_a, col_b, y) - 1) / 2.0e0 AS ry
       FROM pr)
SELECT col_a, col_b, CASE WHEN isnan(corr(rx, ry)) THEN NULL
                          ELSE greatest(least(corr(rx, ry), 1.0e0), -1.0e0) END AS r
FROM rks GROUP BY 1, 2""", ["r"])


def _top_pearson(k: int):
    def query(spark, sf):
        df = prepared_train(spark, sf)
        columns = _leading(corr.pearson_with_target(df, TARGET, _features(df)), "abs_pearson", k)
        return finish(corr.pearson_matrix(df, columns, upper_only=False))
    return query


def _top_spearman(k: int):
    def query(spark, sf):
        df = prepared_train(spark, sf)
        columns = _leading(corr.spearman_with_binary_target(df, TARGET, _features(df)), "abs_spearman", k)
        return finish(corr.spearman_matrix(df, columns, ID))
    return query


for _k in (25, 30):
    register(f"corr_matrix_top{_k}", lambda k=_k: _top_pearson_sql(k))(_top_pearson(_k))
    register(f"spearman_matrix_top{_k}", lambda k=_k: _top_spearman_sql(k))(_top_spearman(_k))
