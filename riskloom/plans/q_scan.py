"""Source and sink queries: registry CSV scan, limited and pruned scans,
stage and report sinks, stage inventory.

Files are written under the session's ``spark.checkpoint.dir`` (the shared
folder the cluster names), in a fresh sub-folder per call.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskloom.operators import profile
from riskloom.plans import features as fx
from riskloom.plans.catalog import finish, register
from riskloom.plans.oracle import DERIVED, DERIVED_CTES, finish_sql, missing_cells_sql, with_ctes
from riskloom.plans.q_features import bureau_features_sql
from riskloom.session import ensure_checkpoint_dir
from riskloom.sources import registry
from riskloom.sources import testbed as tb


def _fresh_dir(spark, tag: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/stages/{tag}-{uuid.uuid4().hex[:12]}"


BUREAU_DOUBLES = ["DAYS_CREDIT_ENDDATE", "DAYS_ENDDATE_FACT", "AMT_CREDIT_MAX_OVERDUE", "AMT_CREDIT_SUM",
                  "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM_LIMIT", "AMT_CREDIT_SUM_OVERDUE", "AMT_ANNUITY"]


@register("scan_csv_roundtrip", lambda: finish_sql(with_ctes("bur") + "SELECT * FROM bur", BUREAU_DOUBLES))
def scan_csv_roundtrip(spark, sf):
    """Bureau written as CSV with its columns in another order, whole numbers as
    decimals and missing cells as markers, and read back through the registry."""
    raw_dir = _fresh_dir(spark, "raw")
    t = tb.bureau(spark, sf)
    whole = {"CREDIT_DAY_OVERDUE", "CNT_CREDIT_PROLONG"}
    cells = [F.coalesce((F.col(c).cast("decimal(20,1)") if c in whole else F.col(c)).cast("string"),
                        F.lit("NaN" if k % 2 else "NA")).alias(c) for k, c in enumerate(sorted(t.columns, reverse=True))]
    t.select(*cells).write.mode("overwrite").option("header", "true").csv(
        f"{raw_dir}/{registry.RAW_TABLES['bureau'].file_name}")
    return finish(registry.load_raw_table(spark, raw_dir, "bureau"))


MARKERS_SQL = ", ".join(f"'{m}'" for m in registry.MISSING_MARKERS)


@register("scan_csv_text", f"""
SELECT CAST(doc_id AS INTEGER) AS line, lang AS "Table", source AS "Row",
       CASE WHEN text IN ({MARKERS_SQL}) THEN NULL ELSE text END AS "Description",
       '"' || source || '", ""' || lang || '"' AS "Special"
FROM documents""")
def scan_csv_text(spark, sf):
    """Documents written as the description table, in Latin-1, and read back through the
    registry: whole texts with line breaks, accents, commas and quotes in their cells."""
    raw_dir = _fresh_dir(spark, "raw")
    docs = tb.read(spark, sf, "documents")
    docs.select(F.col("doc_id").alias("Unnamed: 0"), F.col("lang").alias("Table"), F.col("source").alias("Row"),
                F.col("text").alias("Description"),
                F.concat(F.lit('"'), "source", F.lit('", ""'), "lang", F.lit('"')).alias("Special")).write.options(
        header="true", escape='"', encoding="ISO-8859-1", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(
        f"{raw_dir}/{registry.RAW_TABLES['columns_description'].file_name}")
    return registry.load_raw_table(spark, raw_dir, "columns_description").withColumnRenamed("Unnamed: 0", "line")


@register("limit_scan", with_ctes("bur") + "SELECT count(*) AS rows FROM (SELECT * FROM bur LIMIT 100) t")
def limit_scan(spark, sf):
    """``nrows``-style scan: any 100 rows (no order promise), so only the count is checked."""
    return tb.bureau(spark, sf).limit(100).agg(F.count(F.lit(1)).alias("rows"))


@register("pruned_count", "SELECT count(c_custkey) AS rows FROM customer")
def pruned_count(spark, sf):
    """Row count through a one-column projection (ReadSchema holds only the key)."""
    return tb.read(spark, sf, "customer").select("c_custkey").agg(F.count("c_custkey").alias("rows"))


@register("sink_roundtrip", bureau_features_sql)
def sink_roundtrip(spark, sf):
    """Bureau rollup written as a Parquet stage (range-partitioned and sorted by
    client), then scanned back."""
    path = _fresh_dir(spark, "bureau_features")
    df = fx.bureau_features(tb.bureau(spark, sf), tb.bureau_balance(spark, sf))
    registry.write_stage(df, path, bucket_key="SK_ID_CURR")
    return finish(registry.load_stage(spark, path))


@register("report_roundtrip")
def report_roundtrip(spark, sf):
    """A small report (relation profile) written as one CSV file and read back."""
    path = _fresh_dir(spark, "report")
    t = {"bureau": tb.bureau(spark, sf), "bureau_balance": tb.bureau_balance(spark, sf)}
    rep = profile.relation_profile([("bureau", t["bureau"], "bureau_balance", t["bureau_balance"], "SK_ID_BUREAU")])
    registry.write_report(rep, path)
    return spark.read.option("header", "true").option("inferSchema", "false").csv(path)


def stage_inventory_sql() -> str:
    parts = []
    for name, (cte, cols) in DERIVED.items():
        names = [c for c, _ in cols]
        parts.append(
            f"SELECT '{name}' AS table_name, {len(cols)} AS n_columns, count(*) AS n_rows, "
            f"{'true' if 'SK_ID_CURR' in names else 'false'} AS has_key, "
            f"{'true' if 'TARGET' in names else 'false'} AS has_target, "
            f"round({missing_cells_sql(cols)} / (count(*) * {len(cols)}.0e0) + 3.3e-07, 4) + 0.0e0 AS missing_rate "
            f"FROM {cte}")
    return with_ctes(*DERIVED_CTES) + "\nUNION ALL\n".join(parts)


@register("stage_inventory", stage_inventory_sql)
def stage_inventory(spark, sf):
    """Per stage table: columns, rows, has key, has target, missing rate."""
    from riskloom.plans.q_profile import derived_tables

    return finish(registry.stage_inventory(derived_tables(spark, sf)))
