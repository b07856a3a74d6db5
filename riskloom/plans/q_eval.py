"""Evaluation queries over the scored-row fixtures (no model involved)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import evaluate as ev
from riskloom.plans.catalog import finish, register
from riskloom.plans.oracle import finish_sql, with_ctes
from riskloom.sources import testbed as tb

T = 0.5
COUNTS = """count(*) FILTER (WHERE score < {t} AND label = 0) AS tn,
  count(*) FILTER (WHERE score >= {t} AND label = 0) AS fp,
  count(*) FILTER (WHERE score < {t} AND label = 1) AS fn,
  count(*) FILTER (WHERE score >= {t} AND label = 1) AS tp"""
def sdiv(a: str, b: str) -> str:
    """Division returning NULL for a zero denominator (SQL text)."""
    return f"(CASE WHEN ({b}) = 0 THEN NULL ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END)"


_PREC = f"COALESCE({sdiv('tp', 'tp + fp')}, 0.0e0)"
_REC = f"COALESCE({sdiv('tp', 'tp + fn')}, 0.0e0)"
METRICS = f"""COALESCE({sdiv('tp + tn', 'tn + fp + fn + tp')}, 0.0e0) AS accuracy,
  {_PREC} AS precision,
  {_REC} AS recall,
  COALESCE({sdiv(f'2.0e0 * {_PREC} * {_REC}', f'{_PREC} + {_REC}')}, 0.0e0) AS f1_score,
  CAST(fn * 10.0e0 + fp * 1.0e0 AS DOUBLE) AS business_cost,
  COALESCE({sdiv('fn * 10.0e0 + fp * 1.0e0', 'tn + fp + fn + tp')}, 0.0e0) AS business_cost_per_client"""
AUC = """auc_s AS (SELECT {g} score, sum(label) AS pos, sum(1 - label) AS neg FROM {src} GROUP BY {g} score),
auc_c AS (SELECT *, COALESCE(sum(neg) OVER ({pg} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
          AS nb FROM auc_s),
auc AS (SELECT {g} CAST(sum(pos * (nb + neg / 2.0e0)) AS DOUBLE) / CAST(sum(pos) * sum(neg) AS DOUBLE) AS roc_auc
        FROM auc_c GROUP BY ALL)"""


def metrics_sql(src: str, t: float, group: list[str]) -> str:
    """tn/fp/fn/tp + metrics per group at threshold t (a SELECT over src)."""
    g = ", ".join(group)
    gsel = g + ", " if g else ""
    inner = f"SELECT {gsel}{COUNTS.format(t=t)} FROM {src}" + (f" GROUP BY {g}" if g else "")
    return f"SELECT {gsel}tn, fp, fn, tp, {METRICS} FROM ({inner}) cm"


def auc_ctes(src: str, group: list[str]) -> str:
    g = ", ".join(group)
    return AUC.format(src=src, g=(g + ", ") if g else "", pg=f"PARTITION BY {g}" if g else "")


def _sql(body: str, doubles: list[str]) -> str:
    return finish_sql(body, doubles)


MDOUBLES = ["accuracy", "precision", "recall", "f1_score", "business_cost", "business_cost_per_client"]


@register("confusion_matrix", with_ctes("scored") + f"SELECT fold, {COUNTS.format(t=T)} FROM scored GROUP BY fold")
def confusion_matrix(spark, sf):
    return ev.confusion_counts(tb.scored_clients(spark, sf), T, group_cols=["fold"])


@register("business_cost", lambda: _sql(with_ctes("scored") + (
    f"SELECT fold, business_cost, business_cost_per_client FROM ({metrics_sql('scored', T, ['fold'])}) m"),
    ["business_cost", "business_cost_per_client"]))
def business_cost(spark, sf):
    cm = ev.confusion_counts(tb.scored_clients(spark, sf), T, group_cols=["fold"])
    m = cm.select("fold", *ev.metrics_from_counts(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")))
    return finish(m.select("fold", "business_cost", "business_cost_per_client"))


@register("classification_metrics", lambda: _sql(with_ctes("scored") + (
    f"SELECT fold, accuracy, precision, recall, f1_score FROM ({metrics_sql('scored', T, ['fold'])}) m"),
    ["accuracy", "precision", "recall", "f1_score"]))
def classification_metrics(spark, sf):
    cm = ev.confusion_counts(tb.scored_clients(spark, sf), T, group_cols=["fold"])
    m = cm.select("fold", *ev.metrics_from_counts(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")))
    return finish(m.select("fold", "accuracy", "precision", "recall", "f1_score"))


@register("roc_auc", lambda: _sql(with_ctes("scored") + ", " + auc_ctes("scored", ["fold"]) + " SELECT * FROM auc",
                                  ["roc_auc"]))
def roc_auc(spark, sf):
    """Exact tie-aware AUC per fold."""
    return finish(ev.roc_auc(tb.scored_clients(spark, sf), group_cols=["fold"]))


@register("metrics_by_fold", lambda: _sql(with_ctes("scored") + ", " + auc_ctes("scored", ["fold"]) + (
    f", m AS ({metrics_sql('scored', T, ['fold'])}) SELECT * FROM m LEFT JOIN auc USING (fold)"),
    MDOUBLES + ["roc_auc"]))
def metrics_by_fold(spark, sf):
    return finish(ev.metric_bundle(tb.scored_clients(spark, sf), T, group_cols=["fold"]))


def sweep_sql(src: str, group: list[str]) -> str:
    """51-row sweep: for each threshold i, counts with score >= 0.10 + 0.05 * i."""
    g = ", ".join(group)
    gsel = g + ", " if g else ""
    return (f"sw AS (SELECT {gsel}round(th, 2) AS threshold, tn, fp, fn, tp, {METRICS} FROM ("
            f"SELECT {gsel}th, count(*) FILTER (WHERE score < th AND label = 0) AS tn, "
            "count(*) FILTER (WHERE score >= th AND label = 0) AS fp, "
            "count(*) FILTER (WHERE score < th AND label = 1) AS fn, "
            "count(*) FILTER (WHERE score >= th AND label = 1) AS tp "
            f"FROM {src}, (SELECT 0.10e0 + 0.05e0 * i AS th FROM range(17) t(i)) ths GROUP BY {gsel}th) c)")


@register("threshold_sweep", lambda: _sql(with_ctes("scored") + ", " + auc_ctes("scored", ["fold"]) + ", "
                                          + (sweep_sql("scored", ["fold"]))
                                          + " SELECT * FROM sw LEFT JOIN auc USING (fold)",
                                          MDOUBLES + ["roc_auc", "threshold"]))
def threshold_sweep(spark, sf):
    """Metric bundle at 17 thresholds x 3 folds from one pass over the scored rows."""
    return finish(ev.threshold_sweep(tb.scored_clients(spark, sf), group_cols=["fold"]))


def curve_sql() -> str:
    aggs = ", ".join(f"avg({m}) AS mean_{m}, stddev_samp({m}) AS std_{m}" for m in ev.CURVE_METRICS)
    return (with_ctes("scored") + ", " + auc_ctes("scored", ["fold"]) + ", " + (sweep_sql("scored", ["fold"]))
            + f", swa AS (SELECT * FROM sw LEFT JOIN auc USING (fold)), "
            f"curve AS (SELECT threshold, {aggs} FROM swa GROUP BY threshold)\n")


CURVE_DOUBLES = ["threshold"] + [f"{p}_{m}" for m in ev.CURVE_METRICS for p in ("mean", "std")]


@register("threshold_curve", lambda: _sql(curve_sql() + "SELECT * FROM curve", CURVE_DOUBLES))
def threshold_curve(spark, sf):
    """Mean/std over folds per threshold (the cost curve), sorted by mean cost."""
    sweep = ev.threshold_sweep(tb.scored_clients(spark, sf), group_cols=["fold"])
    return finish(ev.threshold_curve(sweep))


@register("best_threshold", lambda: _sql(curve_sql() + "SELECT * FROM curve ORDER BY mean_business_cost, threshold "
                                         "LIMIT 1", CURVE_DOUBLES))
def best_threshold(spark, sf):
    sweep = ev.threshold_sweep(tb.scored_clients(spark, sf), group_cols=["fold"])
    return finish(ev.best_threshold(ev.threshold_curve(sweep)))


@register("cost_gain", lambda: _sql(with_ctes("scored") + (
    f", b AS ({metrics_sql('scored', T, [])}), " + sweep_sql("scored", [])
    + ", a AS (SELECT business_cost FROM sw ORDER BY business_cost, threshold LIMIT 1) "
    "SELECT b.business_cost AS cost_before, a.business_cost AS cost_after, "
    "b.business_cost - a.business_cost AS gain, "
    "CASE WHEN b.business_cost = 0 THEN NULL ELSE (b.business_cost - a.business_cost) / b.business_cost END AS gain_rate "
    "FROM b, a"), ["cost_before", "cost_after", "gain", "gain_rate"]))
def cost_gain(spark, sf):
    """Cost at the default 0.5 threshold vs at the best swept threshold."""
    scored = tb.scored_clients(spark, sf)
    before = ev.metric_bundle(scored, T)
    after = ev.threshold_sweep(scored, with_auc=False).orderBy("business_cost", "threshold").limit(1)
    return finish(ev.cost_gain(before, after))


@register("class_balance", lambda: _sql(with_ctes("app", "app_train") + """
SELECT count(*) FILTER (WHERE TARGET = 1) AS positives, count(*) FILTER (WHERE TARGET <> 1) AS negatives,
  count(*) FILTER (WHERE TARGET <> 1) / count(*) FILTER (WHERE TARGET = 1)::DOUBLE AS scale_pos_weight,
  count(*) / (2.0e0 * count(*) FILTER (WHERE TARGET <> 1)) AS weight_negative,
  count(*) / (2.0e0 * count(*) FILTER (WHERE TARGET = 1)) AS weight_positive
FROM app_train""", ["scale_pos_weight", "weight_negative", "weight_positive"]))
def class_balance(spark, sf):
    """Class counts, neg/pos ratio and balanced weights n / (2 n_c)."""
    return finish(ev.class_balance(tb.application_train(spark, sf), "TARGET"))


@register("majority_baseline", lambda: _sql(with_ctes("scored") + (
    ", maj AS (SELECT label AS majority_label FROM scored GROUP BY label ORDER BY count(*) DESC, label LIMIT 1), "
    "pred AS (SELECT fold, label, CAST(majority_label AS DOUBLE) AS score FROM scored, maj), "
    + auc_ctes("pred", ["fold"]) + f", m AS ({metrics_sql('pred', T, ['fold'])}) "
    "SELECT m.*, auc.roc_auc, (SELECT majority_label FROM maj) AS majority_label FROM m LEFT JOIN auc USING (fold)"),
    MDOUBLES + ["roc_auc"]))
def majority_baseline(spark, sf):
    """Constant most-frequent-label prediction, evaluated per fold (AUC 0.5)."""
    scored = tb.scored_clients(spark, sf)
    maj = ev.majority_baseline(scored).withColumn("__k", F.lit(0))
    pred = scored.withColumn("__k", F.lit(0)).join(F.broadcast(maj), "__k").select(
        "fold", "label", F.col("majority_label").cast("double").alias("score"))
    bundle = ev.metric_bundle(pred, T, group_cols=["fold"]).withColumn("__k", F.lit(0))
    return finish(bundle.join(F.broadcast(maj), "__k").drop("__k"))


@register("model_comparison", lambda: _sql(with_ctes("models") + ", " + auc_ctes("models", ["model", "fold"])
    + (f", m AS ({metrics_sql('models', T, ['model', 'fold'])}), mf AS (SELECT * FROM m LEFT JOIN auc "
                  "USING (model, fold)) SELECT model, " + ", ".join(
                      f"avg({x}) AS mean_{x}, stddev_samp({x}) AS std_{x}" for x in ["business_cost", "roc_auc", "recall"])
                  + " FROM mf GROUP BY model"),
    [f"{p}_{x}" for x in ["business_cost", "roc_auc", "recall"] for p in ("mean", "std")]))
def model_comparison(spark, sf):
    """Per model: mean and std over folds of cost, AUC and recall, sorted by mean cost."""
    bundle = ev.metric_bundle(tb.scored_models(spark, sf), T, group_cols=["model", "fold"])
    aggs = []
    for x in ["business_cost", "roc_auc", "recall"]:
        aggs += [F.avg(x).alias(f"mean_{x}"), F.stddev_samp(x).alias(f"std_{x}")]
    return finish(bundle.groupBy("model").agg(*aggs).orderBy("mean_business_cost", "model"))
