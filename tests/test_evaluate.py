import itertools
import random

from pyspark.sql import functions as F

from riskloom.operators import evaluate as ev


def _scored(spark, n=300, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        y = 1 if rnd.random() < 0.3 else 0
        rows.append((i, i % 3, y, round(rnd.random() * 0.6 + 0.3 * y, 2)))   # rounded: ties
    return spark.createDataFrame(rows, "id long, fold int, label int, score double"), rows


def _brute_auc(rows):
    pos = [s for _, _, y, s in rows if y == 1]
    neg = [s for _, _, y, s in rows if y == 0]
    tot = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p, q in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def test_auc_exact_with_ties(spark):
    df, rows = _scored(spark)
    got = ev.roc_auc(df).collect()[0]["roc_auc"]
    assert abs(got - _brute_auc(rows)) < 1e-12


def test_auc_monotone_invariance(spark):
    df, _ = _scored(spark)
    a = ev.roc_auc(df).collect()[0][0]
    b = ev.roc_auc(df.withColumn("score", F.exp(F.col("score") * 3) - 7)).collect()[0][0]
    assert abs(a - b) < 1e-12


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "label int, score double")
    assert ev.roc_auc(df).collect()[0][0] is None


def test_sweep_matches_direct_counts(spark):
    df, _ = _scored(spark)
    sweep = {(r["fold"], r["threshold"]): r for r in ev.threshold_sweep(df, group_cols=["fold"]).collect()}
    assert len(sweep) == 51
    for t in ev.thresholds():
        direct = {r["fold"]: r for r in ev.confusion_counts(df, t, group_cols=["fold"]).collect()}
        for f, d in direct.items():
            s = sweep[(f, round(t, 2))]
            assert (s["tn"], s["fp"], s["fn"], s["tp"]) == (d["tn"], d["fp"], d["fn"], d["tp"])
            assert s["business_cost"] == 10 * d["fn"] + d["fp"]


def test_metrics_zero_division(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "label int, score double")
    r = ev.metric_bundle(df, 0.5).collect()[0]
    assert (r["precision"], r["recall"], r["f1_score"], r["accuracy"]) == (0.0, 0.0, 0.0, 1.0)


def test_thresholds():
    ts = ev.thresholds()
    assert len(ts) == 17 and abs(ts[0] - 0.1) < 1e-12 and abs(ts[-1] - 0.9) < 1e-9


def test_curve_and_best(spark):
    df, _ = _scored(spark)
    curve = ev.threshold_curve(ev.threshold_sweep(df, group_cols=["fold"]))
    best = ev.best_threshold(curve).collect()[0]
    assert best["mean_business_cost"] == min(r["mean_business_cost"] for r in curve.collect())
