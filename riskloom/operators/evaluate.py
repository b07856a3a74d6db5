"""Evaluation of scored rows: confusion counts, business cost, metrics,
exact tie-aware ROC AUC, and a one-pass sweep over decision thresholds.

Scored rows are ``(group..., label, score)``. Every metric is an aggregate
over them; the sweep buckets each row once by the number of thresholds at
or below its score, so 17 thresholds cost one pass, not 17.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.rank import cumulative_below, null_safe_join

# Cost of a missed default and of a refused good client.
COST_FN = 10.0
COST_FP = 1.0


def thresholds(start: float = 0.10, stop: float = 0.91, step: float = 0.05) -> list[float]:
    """``start + step * i`` while below ``stop`` (17 values by default)."""
    out, i = [], 0
    while start + step * i < stop:
        out.append(start + step * i)
        i += 1
    return out


def _safe_div(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def metrics_from_counts(tn: Column, fp: Column, fn: Column, tp: Column,
                        cost_fn: float = COST_FN, cost_fp: float = COST_FP) -> list[Column]:
    n = tn + fp + fn + tp
    precision = _safe_div(tp, tp + fp)
    recall = _safe_div(tp, tp + fn)
    cost = (fn * F.lit(cost_fn) + fp * F.lit(cost_fp)).cast("double")
    return [
        _safe_div(tp + tn, n).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _safe_div(2 * precision * recall, precision + recall).alias("f1_score"),
        cost.alias("business_cost"),
        _safe_div(cost, n).alias("business_cost_per_client"),
    ]


def _has_score(score: str) -> Column:
    """False for a missing score, NULL or NaN: it reaches no threshold, so its
    prediction is 0 wherever one is made, and it takes no part in the AUC."""
    return F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double"))


def confusion_counts(df: DataFrame, threshold: float = 0.5, label: str = "label", score: str = "score",
                     group_cols: list[str] | None = None) -> DataFrame:
    pred = _has_score(score) & (F.col(score) >= F.lit(threshold))
    y = F.col(label) == 1
    g = list(group_cols or [])
    return df.groupBy(*g).agg(
        F.count_if(~pred & ~y).alias("tn"), F.count_if(pred & ~y).alias("fp"),
        F.count_if(~pred & y).alias("fn"), F.count_if(pred & y).alias("tp"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score",
            group_cols: list[str] | None = None) -> DataFrame:
    """Exact Mann-Whitney AUC per group: sum over distinct scores of
    ``pos * (neg_below + neg_tied / 2) / (P * N)``; NULL with one class only."""
    g = list(group_cols or [])
    y = F.col(label).cast("long")
    cb = cumulative_below(df.filter(_has_score(score)), score, {"pos": y, "neg": 1 - y}, g)
    agg = cb.groupBy(*g) if g else cb.groupBy()
    return agg.agg(
        F.try_divide(F.sum(F.col("pos") * (F.col("below_neg") + F.col("neg") / 2.0)),
                     (F.sum("pos") * F.sum("neg")).cast("double")).alias("roc_auc"))


def metric_bundle(df: DataFrame, threshold: float = 0.5, label: str = "label", score: str = "score",
                  group_cols: list[str] | None = None, cost_fn: float = COST_FN,
                  cost_fp: float = COST_FP) -> DataFrame:
    """J1-J4 as one row per group: counts, metrics, cost and AUC."""
    g = list(group_cols or [])
    cm = confusion_counts(df, threshold, label, score, g)
    out = cm.select(*g, "tn", "fp", "fn", "tp",
                    *metrics_from_counts(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp"), cost_fn, cost_fp))
    auc = roc_auc(df, label, score, g)
    return null_safe_join(out, auc, g, "left") if g else _attach_single(out, auc)


def _attach_single(left: DataFrame, right: DataFrame) -> DataFrame:
    """Join two one-row frames on a constant key."""
    return left.withColumn("__k", F.lit(0)).join(right.withColumn("__k", F.lit(0)), "__k").drop("__k")


def threshold_sweep(df: DataFrame, ts: list[float] | None = None, label: str = "label",
                    score: str = "score", group_cols: list[str] | None = None,
                    cost_fn: float = COST_FN, cost_fp: float = COST_FP, with_auc: bool = True) -> DataFrame:
    """Metric bundle at every threshold (x group) from one pass over the rows.

    ``bucket`` = number of thresholds <= score; counts per (group, bucket) give
    every threshold's confusion matrix by a suffix sum over at most
    ``len(ts) + 1`` rows per group.
    """
    ts = thresholds() if ts is None else ts
    g = list(group_cols or [])
    tarr = F.array(*[F.lit(float(t)) for t in ts])
    s = F.col(score)
    bucket = F.when(_has_score(score), F.size(F.filter(tarr, lambda t: t <= s))).otherwise(F.lit(0))
    y = F.col(label) == 1
    counts = df.groupBy(*g, bucket.alias("bucket")).agg(F.count_if(y).alias("p"), F.count_if(~y).alias("n"))
    per_t = counts.select(*g, "bucket", "p", "n", F.posexplode(tarr).alias("i", "threshold"))
    above = F.col("bucket") >= F.col("i") + 1
    cm = per_t.groupBy(*g, "i", "threshold").agg(
        F.sum(F.when(~above, F.col("n")).otherwise(0)).alias("tn"),
        F.sum(F.when(above, F.col("n")).otherwise(0)).alias("fp"),
        F.sum(F.when(~above, F.col("p")).otherwise(0)).alias("fn"),
        F.sum(F.when(above, F.col("p")).otherwise(0)).alias("tp"))
    out = cm.select(*g, F.round("threshold", 2).alias("threshold"),
                    *[F.col(c).cast("long").alias(c) for c in ("tn", "fp", "fn", "tp")],
                    *metrics_from_counts(*[F.col(c) for c in ("tn", "fp", "fn", "tp")], cost_fn, cost_fp))
    if not with_auc:
        return out
    auc = roc_auc(df, label, score, g)
    return null_safe_join(out, auc, g, "left") if g else _attach_single(out, auc)


CURVE_METRICS = ["business_cost", "business_cost_per_client", "accuracy", "precision", "recall", "f1_score",
                 "roc_auc", "tn", "fp", "fn", "tp"]


def threshold_curve(sweep: DataFrame, by: str = "threshold") -> DataFrame:
    """Mean and sample std over folds per threshold, sorted by mean cost."""
    aggs = []
    for m in CURVE_METRICS:
        aggs += [F.avg(m).alias(f"mean_{m}"), F.stddev_samp(m).alias(f"std_{m}")]
    return sweep.groupBy(by).agg(*aggs).orderBy("mean_business_cost", by)


def best_threshold(curve: DataFrame, by: str = "threshold") -> DataFrame:
    """Row with the lowest mean cost; ties go to the lowest threshold."""
    return curve.orderBy("mean_business_cost", by).limit(1)


def cost_gain(before: DataFrame, after: DataFrame, cost: str = "business_cost") -> DataFrame:
    """Absolute and relative gain between two one-row results."""
    b = before.select(F.col(cost).alias("cost_before"))
    a = after.select(F.col(cost).alias("cost_after"))
    j = _attach_single(b, a)
    return j.select("cost_before", "cost_after", (F.col("cost_before") - F.col("cost_after")).alias("gain"),
                    F.try_divide(F.col("cost_before") - F.col("cost_after"), F.col("cost_before")).alias("gain_rate"))


def majority_baseline(df: DataFrame, label: str = "label") -> DataFrame:
    """Most frequent label as a constant prediction (ties: smaller label)."""
    mode = df.groupBy(label).count().orderBy(F.desc("count"), label).limit(1).select(
        F.col(label).alias("majority_label"))
    return mode


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """Positives, negatives, ratio neg/pos, and balanced class weights."""
    y = F.col(label) == 1
    c = df.agg(F.count_if(y).alias("positives"), F.count_if(~y).alias("negatives"))
    n = F.col("positives") + F.col("negatives")
    return c.select("positives", "negatives",
                    F.try_divide(F.col("negatives").cast("double"), F.col("positives")).alias("scale_pos_weight"),
                    F.try_divide(n.cast("double"), 2 * F.col("negatives")).alias("weight_negative"),
                    F.try_divide(n.cast("double"), 2 * F.col("positives")).alias("weight_positive"))
