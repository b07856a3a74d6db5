"""Data-quality report queries (table/key/relation profiles, missing values,
constant and high-missing columns, drop decision)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions.nulls import bools_to_int_all, replace_inf_all
from riskloom.operators import profile
from riskloom.plans import features as fx
from riskloom.plans import modeling
from riskloom.plans.catalog import finish, register
from riskloom.plans.oracle import DERIVED, DERIVED_CTES, missing_cells_sql, q, spark_round, with_ctes
from riskloom.plans.q_prep import final_dataset_parts
from riskloom.sources import testbed as tb


def derived_tables(spark, sf) -> dict:
    return {
        "application_train": tb.application_train(spark, sf),
        "application_test": tb.application_test(spark, sf),
        "bureau": tb.bureau(spark, sf),
        "bureau_balance": tb.bureau_balance(spark, sf),
        "previous_application": tb.previous_application(spark, sf),
        "pos_cash_balance": tb.pos_cash_balance(spark, sf),
        "installments_payments": tb.installments_payments(spark, sf),
        "credit_card_balance": tb.credit_card_balance(spark, sf),
    }


def _union_all(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------------- F1
def table_summary_sql() -> str:
    parts = []
    for name, (cte, cols) in DERIVED.items():
        n = len(cols)
        miss = missing_cells_sql(cols)
        parts.append(
            f"SELECT '{name}' AS \"table\", count(*) AS rows, {n} AS columns, "
            f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {cte})) AS duplicates, "
            f"{miss} AS total_missing_values, "
            f"{spark_round(f'{miss} / (count(*) * {n}.0e0)', 4)} AS missing_rate, "
            f"{sum(k for _, k in cols)} AS numeric_columns, {sum(1 - k for _, k in cols)} AS categorical_columns "
            f"FROM {cte}")
    return with_ctes(*DERIVED_CTES) + "\nUNION ALL\n".join(parts)


@register("table_summary", table_summary_sql)
def table_summary(spark, sf):
    """Per raw table: rows, columns, exact full-row duplicates, missing cells, types."""
    return finish(_union_all([profile.table_summary(df, name) for name, df in derived_tables(spark, sf).items()]))


# ---------------------------------------------------------------- F2, F3
def _missing_sql(cte: str, cols: list[str], with_count: bool) -> str:
    parts = []
    for c in cols:
        cnt = f"count(*) FILTER (WHERE {q(c)} IS NULL)"
        extra = f"{cnt} AS missing_count, " if with_count else ""
        parts.append(f"SELECT '{c}' AS \"column\", {extra}{cnt} / count(*)::DOUBLE AS missing_rate FROM {cte}")
    return "\nUNION ALL\n".join(parts)


def missing_rate_sql() -> str:
    parts = []
    for name, (cte, cols) in DERIVED.items():
        src = "prevc" if cte == "prev" else cte
        parts.append(f"SELECT '{name}' AS \"table\", * FROM ({_missing_sql(src, [c for c, _ in cols], False)}) t")
    inner = (with_ctes(*DERIVED_CTES) + ", prevc AS (SELECT * REPLACE (NULLIF(DAYS_FIRST_DUE, 365243) AS DAYS_FIRST_DUE, "
             "NULLIF(DAYS_LAST_DUE, 365243) AS DAYS_LAST_DUE, NULLIF(DAYS_TERMINATION, 365243) AS DAYS_TERMINATION) "
             "FROM prev)\n" + "\nUNION ALL\n".join(parts))
    return f"SELECT \"table\", \"column\", round(missing_rate + 3.3e-07, 4) + 0.0e0 AS missing_rate FROM ({inner})"


@register("missing_rate", missing_rate_sql)
def missing_rate(spark, sf):
    """Missing rate of every column of every raw table, previous applications cleaned."""
    tables = derived_tables(spark, sf)
    tables["previous_application"] = fx.replace_sentinels(tables["previous_application"], fx.PREVIOUS_SENTINEL_COLUMNS)
    return finish(_union_all([profile.missing_rate(df).select(F.lit(name).alias("table"), "column", "missing_rate")
                              for name, df in tables.items()]))


def _final_train_long(cast_inf: bool) -> str:
    """Long (column, v) view of the final train table, NULLs included."""
    sql, _ = final_dataset_parts()
    val = "CASE WHEN isinf(v) OR isnan(v) THEN NULL ELSE v END" if cast_inf else "v"
    return (sql + ", ft AS (SELECT * EXCLUDE (dataset_type) FROM final WHERE dataset_type = 'train'),\n"
            "ftd AS (SELECT COLUMNS(*)::DOUBLE FROM ft),\n"
            "lng AS (SELECT \"column\", " + val + " AS v FROM ftd "
            "UNPIVOT INCLUDE NULLS (v FOR \"column\" IN (COLUMNS(*))))\n")


@register("missing_report", lambda: _final_train_long(False) + """
SELECT "column", count(*) FILTER (WHERE v IS NULL OR isnan(v)) AS missing_count,
       round(count(*) FILTER (WHERE v IS NULL OR isnan(v)) / count(*)::DOUBLE + 3.3e-07, 4) + 0.0e0 AS missing_rate
FROM lng GROUP BY "column" """)
def missing_report(spark, sf):
    """Missing count and rate of every column of the final train table."""
    train, _ = fx.split_train_test(modeling.processed(spark, sf))
    return finish(profile.missing_report(train))


# ---------------------------------------------------------------------- F4
def dataset_summary_sql() -> str:
    sql, _ = final_dataset_parts()
    rate = spark_round("m / (n * c::DOUBLE)", 4)
    return (sql + ", ft AS (SELECT * EXCLUDE (dataset_type) FROM final WHERE dataset_type = 'train'),\n"
            "fs AS (SELECT * EXCLUDE (dataset_type, TARGET) FROM final WHERE dataset_type = 'test'),\n"
            "ftd AS (SELECT COLUMNS(*)::DOUBLE FROM ft), fsd AS (SELECT COLUMNS(*)::DOUBLE FROM fs),\n"
            "s AS (SELECT 'train' AS dataset, (SELECT count(*) FROM ft) AS n, "
            "(SELECT count(*) FROM (DESCRIBE ft)) AS c, "
            "(SELECT count(*) FROM ftd UNPIVOT INCLUDE NULLS (v FOR k IN (COLUMNS(*))) "
            "WHERE v IS NULL OR isnan(v)) AS m, true AS has_target\n"
            " UNION ALL SELECT 'test', (SELECT count(*) FROM fs), (SELECT count(*) FROM (DESCRIBE fs)), "
            "(SELECT count(*) FROM fsd UNPIVOT INCLUDE NULLS (v FOR k IN (COLUMNS(*))) "
            "WHERE v IS NULL OR isnan(v)), false)\n"
            f"SELECT dataset, n AS rows, CAST(c AS INTEGER) AS columns, m AS total_missing_values, "
            f"{rate} AS missing_rate, has_target FROM s")


@register("dataset_summary", dataset_summary_sql)
def dataset_summary(spark, sf):
    """Train/test summary of the final tables: rows, columns, missing, rate, has_target."""
    train, test = fx.split_train_test(modeling.processed(spark, sf))
    return finish(profile.dataset_summary({"train": train, "test": test}))


# ---------------------------------------------------------------- F5, F6
@register("target_percent", with_ctes("app") + """
SELECT TARGET AS target, """ + spark_round("count(*) * 100.0e0 / sum(count(*)) OVER ()", 2) + """ AS percentage
FROM app WHERE TARGET IS NOT NULL GROUP BY TARGET""")
def target_percent(spark, sf):
    return finish(profile.target_percent(tb.application_train(spark, sf)))


@register("target_distribution", with_ctes("app") + """
SELECT TARGET AS target_value, count(*) AS count,
       round(count(*) / sum(count(*)) OVER () + 3.3e-07, 4) + 0.0e0 AS rate
FROM app GROUP BY TARGET""")
def target_distribution(spark, sf):
    """Target counts and rates on train+test: the missing test target is its own group."""
    return finish(profile.target_distribution(tb.application(spark, sf)))


# ------------------------------------------------------------ F7, F8, F9
@register("constant_columns", lambda: _final_train_long(False) + """
SELECT "column" FROM lng WHERE "column" NOT IN ('TARGET', 'SK_ID_CURR') GROUP BY "column"
HAVING count(v) = 0 OR (count(v) = count(*) AND min(v) = max(v))""")
def constant_columns(spark, sf):
    """Columns of the final train table with one value (missing counted as a value)."""
    train, _ = fx.split_train_test(modeling.processed(spark, sf))
    return profile.constant_report(train, exclude=("TARGET", "SK_ID_CURR"))


@register("high_missing", lambda: _final_train_long(True) + """
SELECT "column", round(count(*) FILTER (WHERE v IS NULL) / count(*)::DOUBLE + 3.3e-07, 4) + 0.0e0 AS missing_rate
FROM lng WHERE "column" NOT IN ('TARGET', 'SK_ID_CURR') GROUP BY "column"
HAVING count(*) FILTER (WHERE v IS NULL) / count(*)::DOUBLE >= 0.8""")
def high_missing(spark, sf):
    """Columns with missing rate >= 0.80 after inf -> NULL; target and id protected."""
    train, _ = fx.split_train_test(modeling.processed(spark, sf))
    return finish(profile.high_missing_columns(replace_inf_all(train)))


@register("dropped_columns", lambda: _final_train_long(True) + """
, d AS (SELECT "column", count(*) FILTER (WHERE v IS NULL) / count(*)::DOUBLE >= 0.8 AS high,
          count(v) = 0 OR (count(v) = count(*) AND min(v) = max(v)) AS konst
        FROM lng WHERE "column" NOT IN ('TARGET', 'SK_ID_CURR') GROUP BY "column")
SELECT "column", CASE WHEN high AND konst THEN 'high_missing_and_constant' WHEN high THEN 'high_missing'
                      ELSE 'constant' END AS reason
FROM d WHERE high OR konst""")
def dropped_columns(spark, sf):
    """Drop decision learned on train (after inf -> NULL, bool -> int), with reason."""
    train, _ = fx.split_train_test(modeling.processed(spark, sf))
    return profile.drop_decision(bools_to_int_all(replace_inf_all(train)))


# -------------------------------------------------------------- F10, F11
KEYS = {
    "application_train": ["SK_ID_CURR"],
    "application_test": ["SK_ID_CURR"],
    "bureau": ["SK_ID_CURR", "SK_ID_BUREAU"],
    "bureau_balance": ["SK_ID_BUREAU", "SK_ID_CURR"],
    "previous_application": ["SK_ID_PREV", "SK_ID_CURR"],
    "pos_cash_balance": ["SK_ID_PREV", "SK_ID_CURR"],
    "installments_payments": ["SK_ID_PREV", "SK_ID_CURR"],
    "credit_card_balance": ["SK_ID_PREV", "SK_ID_CURR"],
}


def key_profile_sql() -> str:
    parts = []
    for name, keys in KEYS.items():
        cte, cols = DERIVED[name]
        names = [c for c, _ in cols]
        for k in keys:
            if k not in names:
                parts.append(f"SELECT '{name}' AS \"table\", '{k}' AS key, false AS key_exists, count(*) AS rows, "
                             "NULL::BIGINT AS unique_keys, NULL::BIGINT AS missing_keys, "
                             "NULL::BIGINT AS duplicated_key_rows, NULL::BIGINT AS max_rows_per_key, "
                             f"NULL::DOUBLE AS mean_rows_per_key FROM {cte}")
                continue
            parts.append(
                f"SELECT '{name}' AS \"table\", '{k}' AS key, true AS key_exists, CAST(sum(n) AS BIGINT) AS rows, "
                "count(kv) AS unique_keys, CAST(COALESCE(sum(n) FILTER (WHERE kv IS NULL), 0) AS BIGINT) AS missing_keys, "
                "CAST(sum(n) - count(*) AS BIGINT) AS duplicated_key_rows, "
                f"max(n) AS max_rows_per_key, {spark_round('avg(n)', 2)} AS mean_rows_per_key FROM (SELECT {q(k)} AS kv, count(*) AS n FROM {cte} GROUP BY 1)")
    return with_ctes(*DERIVED_CTES) + "\nUNION ALL\n".join(parts)


@register("key_profile", key_profile_sql)
def key_profile(spark, sf):
    t = derived_tables(spark, sf)
    return finish(profile.key_profile({n: (t[n], ks) for n, ks in KEYS.items()}))


RELATIONS = [("application_train", "bureau", "SK_ID_CURR"), ("bureau", "bureau_balance", "SK_ID_BUREAU"),
             ("application_train", "previous_application", "SK_ID_CURR"),
             ("application_train", "pos_cash_balance", "SK_ID_CURR"),
             ("application_train", "installments_payments", "SK_ID_CURR"),
             ("application_train", "credit_card_balance", "SK_ID_CURR")]


def relation_profile_sql() -> str:
    parts = []
    for p, c, k in RELATIONS:
        pc, cc = DERIVED[p][0], DERIVED[c][0]
        parts.append(
            f"SELECT '{p}' AS parent_table, '{c}' AS child_table, '{k}' AS key, "
            "count(*) FILTER (WHERE pk IS NOT NULL) AS parent_unique_keys, "
            "count(*) FILTER (WHERE n IS NOT NULL) AS child_unique_keys, "
            "count(*) FILTER (WHERE pk IS NOT NULL AND n IS NOT NULL) AS common_keys, "
            "count(*) FILTER (WHERE pk IS NOT NULL AND n IS NULL) AS parent_only_keys, "
            "count(*) FILTER (WHERE pk IS NULL AND n IS NOT NULL) AS child_only_keys, "
            f"{spark_round('avg(n)', 2)} AS mean_child_rows_per_key, max(n) AS max_child_rows_per_key "
            f"FROM (SELECT DISTINCT {q(k)} AS pk FROM {pc} WHERE {q(k)} IS NOT NULL) a "
            f"FULL OUTER JOIN (SELECT {q(k)} AS ck, count(*) AS n FROM {cc} WHERE {q(k)} IS NOT NULL GROUP BY 1) b "
            "ON a.pk = b.ck")
    return with_ctes(*DERIVED_CTES) + "\nUNION ALL\n".join(parts)


@register("relation_profile", relation_profile_sql)
def relation_profile(spark, sf):
    """Parent/child key-set algebra via one full outer join of per-key counts."""
    t = derived_tables(spark, sf)
    return finish(profile.relation_profile([(p, t[p], c, t[c], k) for p, c, k in RELATIONS]))


# -------------------------------------------------------------- F12, F13
# Fixed value: the reference's sample size.
SAMPLE_ROWS = 50_000


@register("hash_sample", lambda: final_dataset_parts()[0] + f"""
SELECT least(count(*), {SAMPLE_ROWS}) AS rows, least(count(DISTINCT SK_ID_CURR), {SAMPLE_ROWS}) AS ids,
       0::BIGINT AS strangers FROM final WHERE dataset_type = 'train'""")
def hash_sample(spark, sf):
    """Deterministic sample of the final train table (seed 42): its rows, its
    distinct clients, and those of them that are not in the table."""
    train, _ = fx.split_train_test(modeling.processed(spark, sf))
    s = profile.hash_sample(train.select("SK_ID_CURR"), SAMPLE_ROWS, "SK_ID_CURR", seed=42)
    known = train.select("SK_ID_CURR", F.lit(1).alias("known")).distinct()
    return s.join(known, "SK_ID_CURR", "left").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("SK_ID_CURR").alias("ids"),
        F.count_if(F.col("known").isNull()).alias("strangers"))


def pattern_columns() -> list[tuple[str, bool]]:
    """Every aggregated column of the final table and whether it is a double."""
    return final_dataset_parts()[1]


@register("missing_pattern", lambda: final_dataset_parts()[0] + """
, ft AS (SELECT * FROM final WHERE dataset_type = 'train')
SELECT """ + " || ".join(f"CASE WHEN {q(c)} IS NULL" + (f" OR isnan({q(c)})" if d else "") + " THEN '1' ELSE '0' END"
                         for c, d in pattern_columns())
          + """ AS pattern, count(*) AS rows FROM ft GROUP BY 1""")
def missing_pattern(spark, sf):
    """Co-missing structure of all numeric columns of the final train table."""
    train, _ = fx.split_train_test(modeling.processed(spark, sf))
    return profile.missing_pattern(train.select(*[F.col(f"`{c}`") for c, _ in pattern_columns()]))
