"""Experiment run log as a plain table (instead of a tracking server).

Schema: run_id, experiment, run_name, parent_run_id, status, start_time,
params map<string,string>, metrics map<string,double>, tags map<string,string>.
Runs are appended as Parquet; searches, champion choice and per-name latest
runs are ordinary filters, sorts and aggregates on that table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("experiment", T.StringType()),
    T.StructField("run_name", T.StringType()), T.StructField("parent_run_id", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("start_time", T.TimestampType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
])


def conform(df: DataFrame) -> DataFrame:
    """Cast a frame of run rows to the run-log schema (column order included)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RUNS_SCHEMA.fields])


def append_runs(runs: DataFrame, path: str) -> None:
    conform(runs).write.mode("append").parquet(path)


def load_runs(spark, path: str) -> DataFrame:
    return spark.read.schema(RUNS_SCHEMA).parquet(path)


def metric(name: str):
    return F.element_at(F.col("metrics"), F.lit(name))


def search_runs(runs: DataFrame, experiment: str, order_metric: str,
                metrics: list[str], status: str = "FINISHED", top_level_only: bool = True) -> DataFrame:
    """Finished runs of one experiment, chosen metrics as columns, sorted by
    one metric ascending with missing values last (ties: run_id)."""
    df = runs.filter((F.col("experiment") == experiment) & (F.col("status") == status))
    if top_level_only:
        df = df.filter(F.col("parent_run_id").isNull())
    return (df.select("run_id", "run_name", "start_time", *[metric(m).alias(m) for m in metrics])
            .orderBy(F.asc_nulls_last(order_metric), "run_id"))


def champion(runs: DataFrame, primary: str = "best_business_cost", fallback: str = "business_cost") -> DataFrame:
    """Lowest cost wins; runs reporting ``primary`` are preferred over runs that
    only report ``fallback``. One row (empty when no run has either)."""
    has_primary = metric(primary).isNotNull()
    cost = F.coalesce(metric(primary), metric(fallback))
    cand = runs.filter((F.col("status") == "FINISHED") & cost.isNotNull())
    return (cand.select("run_id", "run_name", cost.alias("cost"),
                        F.when(has_primary, F.lit(primary)).otherwise(F.lit(fallback)).alias("cost_metric"),
                        has_primary.alias("is_preferred"))
            .orderBy(F.desc("is_preferred"), "cost", "run_id").limit(1))


def champion_row(runs: DataFrame, **kw):
    rows = champion(runs, **kw).collect()
    if not rows:
        raise LookupError("no finished run reports a cost")
    return rows[0]


def latest_runs(runs: DataFrame, by: str = "model") -> DataFrame:
    """Per value of ``params[by]``: the run with the latest start_time."""
    key = F.element_at(F.col("params"), F.lit(by))
    return (runs.groupBy(key.alias(by))
            .agg(F.max_by(F.struct("run_id", "start_time"), F.col("start_time")).alias("latest"))
            .select(by, F.col("latest.run_id").alias("run_id"), F.col("latest.start_time").alias("start_time")))


def params_long(runs: DataFrame, prefix: str) -> DataFrame:
    """One row per parameter whose key starts with ``prefix``; prefix stripped."""
    ex = runs.select("run_id", F.explode("params").alias("key", "value"))
    return (ex.filter(F.col("key").startswith(prefix))
            .select("run_id", F.expr(f"substring(key, {len(prefix) + 1})").alias("param"), "value"))


def metrics_long(runs: DataFrame) -> DataFrame:
    """One row per (run, metric)."""
    return runs.select("run_id", F.explode("metrics").alias("metric", "value"))
