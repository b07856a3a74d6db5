"""Run-log queries. The run table is derived from the scored-model fixture:
one child run per (model, fold), one parent run per model with fold means,
and one threshold-tuning run (best mean cost over the 17-threshold curve)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from riskloom.operators import evaluate as ev
from riskloom.operators import runs as rl
from riskloom.plans.catalog import finish, register
from riskloom.plans.oracle import finish_sql, with_ctes
from riskloom.plans.q_eval import auc_ctes, curve_sql, metrics_sql
from riskloom.session import ensure_checkpoint_dir
from riskloom.sources import testbed as tb

EXPERIMENT = "model_comparison"
BASE_TIME = "2024-01-01 00:00:00"


def _ts(minutes) -> F.Column:
    return (F.lit(BASE_TIME).cast("timestamp") + F.make_interval(mins=minutes.cast("int")))


def build_runs(spark, sf):
    bundle = ev.metric_bundle(tb.scored_models(spark, sf), 0.5, group_cols=["model", "fold"])
    idx = F.element_at(F.create_map(F.lit("alpha"), F.lit(0), F.lit("beta"), F.lit(1), F.lit("gamma"), F.lit(2)),
                       F.col("model"))
    child = bundle.select(
        F.concat(F.lit("cv-"), "model", F.lit("-fold"), F.col("fold").cast("string")).alias("run_id"),
        F.lit(EXPERIMENT).alias("experiment"),
        F.concat("model", F.lit("_fold"), F.col("fold").cast("string")).alias("run_name"),
        F.concat(F.lit("cv-"), "model").alias("parent_run_id"), F.lit("FINISHED").alias("status"),
        _ts(idx * 10 + F.col("fold") + 1).alias("start_time"),
        F.create_map(F.lit("model"), "model", F.lit("fold"), F.col("fold").cast("string"),
                     F.lit("threshold"), F.lit("0.5")).alias("params"),
        F.create_map(F.lit("business_cost"), "business_cost", F.lit("roc_auc"), "roc_auc",
                     F.lit("recall"), "recall").alias("metrics"),
        F.create_map(F.lit("stage"), F.lit("cv_fold")).alias("tags"))
    means = bundle.groupBy("model").agg(F.avg("business_cost").alias("c"), F.avg("roc_auc").alias("a"),
                                        F.avg("recall").alias("r"))
    idx_m = F.element_at(F.create_map(F.lit("alpha"), F.lit(0), F.lit("beta"), F.lit(1), F.lit("gamma"), F.lit(2)),
                         F.col("model"))
    parent = means.select(
        F.concat(F.lit("cv-"), "model").alias("run_id"), F.lit(EXPERIMENT).alias("experiment"),
        F.col("model").alias("run_name"), F.lit(None).cast("string").alias("parent_run_id"),
        F.lit("FINISHED").alias("status"), _ts(idx_m * 10).alias("start_time"),
        F.create_map(F.lit("model"), "model", F.lit("n_folds"), F.lit("3")).alias("params"),
        F.create_map(F.lit("business_cost"), "c", F.lit("roc_auc"), "a", F.lit("recall"), "r").alias("metrics"),
        F.create_map(F.lit("stage"), F.lit("cv_summary")).alias("tags"))
    best = ev.best_threshold(ev.threshold_curve(ev.threshold_sweep(tb.scored_clients(spark, sf),
                                                                   group_cols=["fold"])))
    tuning = best.select(
        F.lit("tune-alpha").alias("run_id"), F.lit("threshold_tuning").alias("experiment"),
        F.lit("alpha_threshold").alias("run_name"), F.lit(None).cast("string").alias("parent_run_id"),
        F.lit("FINISHED").alias("status"), _ts(F.lit(60)).alias("start_time"),
        F.create_map(F.lit("model"), F.lit("alpha"), F.lit("sweep_start"), F.lit("0.1"),
                     F.lit("sweep_stop"), F.lit("0.91"), F.lit("sweep_step"), F.lit("0.05")).alias("params"),
        F.create_map(F.lit("best_business_cost"), "mean_business_cost",
                     F.lit("best_threshold"), "threshold").alias("metrics"),
        F.create_map(F.lit("stage"), F.lit("tuning")).alias("tags"))
    return rl.conform(child.unionByName(parent).unionByName(tuning))


@register("run_log", lambda: finish_sql(_runs_sql() + """
, tb AS (SELECT threshold, mean_business_cost FROM curve ORDER BY mean_business_cost, threshold LIMIT 1),
lm AS (SELECT 'cv-' || model || '-fold' || CAST(fold AS VARCHAR) AS run_id, business_cost, roc_auc, recall FROM mf
       UNION ALL SELECT run_id, business_cost, roc_auc, recall FROM pm)
SELECT run_id, 'business_cost' AS metric, business_cost AS value FROM lm UNION ALL SELECT run_id, 'roc_auc', roc_auc FROM lm
UNION ALL SELECT run_id, 'recall', recall FROM lm
UNION ALL SELECT 'tune-alpha', 'best_business_cost', mean_business_cost FROM tb
UNION ALL SELECT 'tune-alpha', 'best_threshold', threshold FROM tb""", ["value"]))
def run_log(spark, sf):
    """Runs appended to a Parquet run table and scanned back (metrics as rows)."""
    path = os.path.join(ensure_checkpoint_dir(spark), "runs", uuid.uuid4().hex[:12])
    rl.append_runs(build_runs(spark, sf), path)
    return finish(rl.metrics_long(rl.load_runs(spark, path)))


def _runs_sql() -> str:
    """parent metrics per model (pm) and the tuning run's best cost (tb)."""
    return (curve_sql().rstrip() + ",\n" + "models AS (" + with_ctes("models").split("models AS (", 1)[1].rstrip()
            + ",\n" + auc_ctes("models", ["model", "fold"]).replace("auc_s", "mauc_s").replace("auc_c", "mauc_c")
            .replace("auc AS", "mauc AS").replace("FROM auc_c", "FROM mauc_c") + ",\n"
            + (f"mm AS ({metrics_sql('models', 0.5, ['model', 'fold'])}),\n")
            + "mf AS (SELECT * FROM mm LEFT JOIN mauc USING (model, fold)),\n"
            "pm AS (SELECT model, 'cv-' || model AS run_id, model AS run_name, avg(business_cost) AS business_cost, "
            "avg(roc_auc) AS roc_auc, avg(recall) AS recall FROM mf GROUP BY model),\n"
            "tbest AS (SELECT mean_business_cost AS best_business_cost FROM curve "
            "ORDER BY mean_business_cost, threshold LIMIT 1)\n")


@register("search_runs", lambda: finish_sql(_runs_sql() + """
SELECT run_id, run_name, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(
  CASE model WHEN 'alpha' THEN 0 WHEN 'beta' THEN 10 ELSE 20 END AS BIGINT)) AS start_time,
  business_cost, roc_auc FROM pm""", ["business_cost", "roc_auc"]))
def search_runs(spark, sf):
    """Finished top-level runs of the comparison, by cost (missing last)."""
    res = rl.search_runs(build_runs(spark, sf), EXPERIMENT, "business_cost", ["business_cost", "roc_auc"])
    return finish(res.withColumn("start_time", F.col("start_time").cast("timestamp_ntz")))


@register("champion", lambda: finish_sql(_runs_sql() + """
, cand AS (SELECT 'tune-alpha' AS run_id, 'alpha_threshold' AS run_name, best_business_cost AS cost,
                  'best_business_cost' AS cost_metric, true AS is_preferred FROM tbest
           UNION ALL SELECT run_id, run_name, business_cost, 'business_cost', false FROM pm
           UNION ALL SELECT 'cv-' || model || '-fold' || CAST(fold AS VARCHAR), model || '_fold' || CAST(fold AS VARCHAR),
                  business_cost, 'business_cost', false FROM mf)
SELECT * FROM cand ORDER BY is_preferred DESC, cost, run_id LIMIT 1""", ["cost"]))
def champion(spark, sf):
    """Champion: runs with best_business_cost first, then lowest cost, then run_id."""
    return finish(rl.champion(build_runs(spark, sf)))


@register("latest_run", with_ctes("models") + """,
r AS (SELECT DISTINCT model, fold, CASE model WHEN 'alpha' THEN 0 WHEN 'beta' THEN 10 ELSE 20 END AS base FROM models),
runs AS (SELECT model, 'cv-' || model || '-fold' || CAST(fold AS VARCHAR) AS run_id,
                TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(base + fold + 1 AS BIGINT)) AS st FROM r
         UNION ALL SELECT DISTINCT model, 'cv-' || model, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(base AS BIGINT)) FROM r
         UNION ALL SELECT 'alpha', 'tune-alpha', TIMESTAMP '2024-01-01 01:00:00')
SELECT model, arg_max(run_id, st) AS run_id, max(st) AS start_time FROM runs GROUP BY model""")
def latest_run(spark, sf):
    """Latest run per model by start_time (max_by over the run table)."""
    res = rl.latest_runs(build_runs(spark, sf), "model")
    return res.withColumn("start_time", F.col("start_time").cast("timestamp_ntz"))


@register("params_long", with_ctes("models") + """,
r AS (SELECT DISTINCT model, fold FROM models),
c AS (SELECT 'cv-' || model || '-fold' || CAST(fold AS VARCHAR) AS run_id, model, fold FROM r),
p AS (SELECT DISTINCT 'cv-' || model AS run_id, model FROM r)
SELECT run_id, 'model' AS param, model AS value FROM c UNION ALL SELECT run_id, 'fold', CAST(fold AS VARCHAR) FROM c
UNION ALL SELECT run_id, 'threshold', '0.5' FROM c UNION ALL SELECT run_id, 'model', model FROM p
UNION ALL SELECT run_id, 'n_folds', '3' FROM p
UNION ALL SELECT 'tune-alpha', t.param, t.value FROM p, (VALUES ('model', 'alpha'), ('sweep_start', '0.1'),
  ('sweep_stop', '0.91'), ('sweep_step', '0.05')) AS t(param, value) WHERE p.model = 'alpha'""")
def params_long(spark, sf):
    """Parameters of every run of the log as rows."""
    return rl.params_long(build_runs(spark, sf), "")
