"""Model-preparation and Spark ML queries on the modelling table.

The modelling train table (final dataset -> drop decision -> rename) is
materialised once per query under the checkpoint folder, then split 80/20
(stratified, exact) or into 3 stratified folds. Model queries are checked on
rows only: seeded Spark ML fits are not reproducible in SQL.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators import evaluate as ev
from riskloom.operators import ml, split
from riskloom.plans import modeling
from riskloom.plans.catalog import finish, register
from riskloom.plans.oracle import finish_sql
from riskloom.plans.q_corr import prepared_train
from riskloom.plans.q_prep import final_dataset_parts
from riskloom.session import code_fingerprint, drop_shuffles, filesystem, input_fingerprint, stage_path, stage_table

ID, TARGET = "SK_ID_CURR", "TARGET"


def modeling_train(spark, sf):
    """(SK_ID_CURR, label, features...) of the prepared train table.

    Written once per set of input files as a Parquet stage under the
    checkpoint folder (the reference's processed-file hand-off) and scanned
    back, which also cuts the lineage before iterative fits.
    """
    def build():
        train, _, _ = modeling.modeling_tables(spark, sf)
        return train.withColumnRenamed(TARGET, "label")

    inputs = [f"{sf.rstrip('/')}/{t}.parquet" for t in modeling.TESTBED_INPUTS]
    return stage_table(spark, "modeling_train", input_fingerprint(spark, inputs), build)


def feature_names(df) -> list[str]:
    return [c for c in df.columns if c not in (ID, "label", "fold")]


def holdout(spark, sf):
    df = modeling_train(spark, sf)
    fit, valid = split.stratified_split(df, "label", ID, 0.2, seed=42)
    return df, fit, valid


def _long_sql(snap: bool = False) -> str:
    sql, _ = final_dataset_parts()
    return (sql + ", ft AS (SELECT * EXCLUDE (dataset_type) FROM final WHERE dataset_type = 'train'),\n"
            "ftn AS (SELECT COLUMNS(* EXCLUDE (SK_ID_CURR))::DOUBLE, SK_ID_CURR FROM ft),\n"
            "lng AS (SELECT \"column\", CASE WHEN isinf(v) OR isnan(v) THEN NULL ELSE v END AS v "
            "FROM ftn UNPIVOT INCLUDE NULLS (v FOR \"column\" IN (COLUMNS(* EXCLUDE (SK_ID_CURR)))))\n")


@register("median_impute", lambda: finish_sql(_long_sql() + """
SELECT "column", median(v) AS median FROM lng WHERE "column" <> 'TARGET' GROUP BY "column" """, ["median"]))
def median_impute(spark, sf):
    """Exact medians (mean of the two middle values) of every train feature."""
    df = prepared_train(spark, sf)
    cols = [c for c in df.columns if c not in (ID, TARGET)]
    return finish(ml.exact_median(df, cols))


@register("standard_scale", lambda: finish_sql(_long_sql() + """
SELECT "column", avg(v) AS mean, stddev_pop(v) AS std FROM lng WHERE "column" <> 'TARGET' GROUP BY "column" """,
    ["mean", "std"]))
def standard_scale(spark, sf):
    """Mean and population std per feature (the scaler fitted on train)."""
    df = prepared_train(spark, sf)
    return finish(ml.fit_scaler(df, [c for c in df.columns if c not in (ID, TARGET)]))


@register("class_weights", lambda: finish_sql(final_dataset_parts()[0] + """
, ft AS (SELECT TARGET AS label FROM final WHERE dataset_type = 'train'),
c AS (SELECT label, count(*) AS n FROM ft GROUP BY label)
SELECT label, n AS rows, (SELECT sum(n) FROM c) / (2.0e0 * n) AS balanced_weight,
  CASE WHEN label = 1 THEN (SELECT n FROM c WHERE label = 0) / (SELECT n FROM c WHERE label = 1)::DOUBLE
       ELSE 1.0e0 END AS positive_weight
FROM c""", ["balanced_weight", "positive_weight"]))
def class_weights(spark, sf):
    """Per class: rows, balanced weight n/(2 n_c), and the neg/pos positive weight."""
    train, _ = modeling.fx.split_train_test(modeling.processed(spark, sf))
    df = ml.positive_weight(train.select(F.col(TARGET).alias("label")), "label")
    per_class = df.groupBy("label").agg(F.count(F.lit(1)).alias("rows"),
                                        F.first("weight").alias("positive_weight"))
    bw = ml.balanced_weights(per_class, "label", count_col="rows")
    return finish(bw.select("label", "rows", F.col("weight").alias("balanced_weight"), "positive_weight"))


def _fit_and_evaluate(spark, sf, spec: ml.ModelSpec):
    _, fit, valid = holdout(spark, sf)
    model = ml.fit_model(fit, feature_names(fit), spec, "label", seed=42)
    # the metrics read the scores several times: the model is applied once
    scored = _written(spark, model.score(valid, ID, "label"), "scores")
    bundle = ev.metric_bundle(scored, 0.5)
    return finish(bundle.select(F.lit(spec.name).alias("model"), "*"))


@register("ml_logreg")
def ml_logreg(spark, sf):
    """Balanced L2 logistic regression (C = 1) on the 80 % split, scored on the 20 %."""
    return _fit_and_evaluate(spark, sf, ml.logistic_spec())


@register("ml_random_forest")
def ml_random_forest(spark, sf):
    return _fit_and_evaluate(spark, sf, ml.random_forest_spec())


@register("ml_gbt")
def ml_gbt(spark, sf):
    """Boosted trees (300 rounds, lr 0.05, depth 4, shares 0.8, neg/pos weight)."""
    return _fit_and_evaluate(spark, sf, ml.gbt_spec())


@register("ml_mlp")
def ml_mlp(spark, sf):
    return _fit_and_evaluate(spark, sf, ml.mlp_spec())


@register("ml_score")
def ml_score(spark, sf):
    """Positive-class probability of every validation row (logistic model)."""
    _, fit, valid = holdout(spark, sf)
    model = ml.fit_model(fit, feature_names(fit), ml.logistic_spec(), "label", seed=42)
    return model.score(valid, ID, "label")


@register("ml_pipeline")
def ml_pipeline(spark, sf):
    """Leak-free pipeline with the logistic settings (balanced weights, C = 1,
    population scaling): fitted on the fit rows, saved, loaded again and applied
    to the validation rows."""
    _, fit, valid = holdout(spark, sf)
    path = f"{stage_path(spark, 'models')}/{uuid.uuid4().hex[:12]}"
    ml.fit_model(fit, feature_names(fit), ml.logistic_spec(), "label", seed=42).save(spark, path)
    return ml.FittedModel.load(spark, path).score(valid, ID, "label")


@register("tune_threshold")
def tune_threshold(spark, sf):
    """Threshold curve of the fitted logistic model over its validation rows,
    lowest cost first."""
    _, fit, valid = holdout(spark, sf)
    model = ml.fit_model(fit, feature_names(fit), ml.logistic_spec(), "label", seed=42)
    sweep = ev.threshold_sweep(model.score(valid, ID, "label"))
    return finish(sweep.orderBy("business_cost", "threshold"))


def search_folds(spark, sf):
    """3 stratified folds of all rows, written as a table: cross-validations read it many
    times, also after a lost executor, and the rows are ranked once."""
    out = _written(spark, split.stratified_kfold(modeling_train(spark, sf), "label", ID, k=3, seed=42), "folds")
    drop_shuffles(spark)
    return out


@register("cv_evaluate")
def cv_evaluate(spark, sf):
    """3-fold CV of the logistic model: refit per fold, one aggregate for all folds."""
    df = search_folds(spark, sf)
    # the metrics read the scores several times: the models are applied once
    scored = _written(spark, ml.cross_validate(df, feature_names(df), ml.logistic_spec(max_iter=500), ID), "cv-scores")
    _drop(spark, df)
    return finish(ev.metric_bundle(scored, 0.5, group_cols=["fold"]))


# As many trials as the reference searches, each a full 3-fold CV and
# 17-threshold sweep.
N_TRIALS = 15
CV_METRICS = ["accuracy", "precision", "recall", "f1_score", "roc_auc", "business_cost", "business_cost_per_client",
              "fn", "fp", "tp", "tn"]


def _written(spark, df, name):
    path = f"{stage_path(spark, name)}/{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stage_path = path
    return out


def _drop(spark, df):
    fs, path = filesystem(spark, df._stage_path)
    fs.delete(path, True)


def _trials(spark, df) -> list[dict]:
    """Parameters, lowest mean cost over thresholds and its threshold of every trial on ``df`` (with folds).

    Each trial's metrics by fold and threshold are a table of the journal, kept for the
    same rows, parameters and code: a search that was broken off goes on where it
    stood, and ``refit_best`` reads what ``hp_trials`` found.
    """
    feats = feature_names(df)
    rows = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)]).cast("decimal(38,0)"))).first()
    key = hashlib.sha1(f"{code_fingerprint()}|{sorted(df.columns)}|{tuple(rows)}".encode()).hexdigest()[:16]

    def build(p):
        t0 = time.time()
        scored = _written(spark, ml.cross_validate(df, feats, _trial_spec(p), ID), "trial-scores")
        sweep = ev.threshold_sweep(scored, group_cols=["fold"])
        by_fold = spark.createDataFrame(sweep.collect(), sweep.schema)        # folds x thresholds
        _drop(spark, scored)
        return by_fold.withColumn("duration_sec", F.lit(time.time() - t0))

    def trial(p):
        name = hashlib.sha1(repr(sorted(p.items())).encode()).hexdigest()[:8]
        sweep = stage_table(spark, f"trials/{key}", f"trial-{p['trial']}-{name}", lambda: build(p))
        best = ev.best_threshold(ev.threshold_curve(sweep)).collect()[0]
        return p | {"value": float(best["mean_business_cost"]), "best_threshold": float(best["threshold"]),
                    "mean_roc_auc": float(best["mean_roc_auc"] or 0.0), "duration_sec": sweep.first()["duration_sec"]}

    with ThreadPoolExecutor(max_workers=ml.fits_at_once(df, 4)) as pool:      # trials are independent Spark jobs
        return list(pool.map(trial, ml.sample_trial_params(N_TRIALS, seed=42)))


def _trial_spec(p: dict) -> ml.ModelSpec:
    return ml.depth_wise_spec(**{k: v for k, v in p.items() if k in ml.depth_wise_spec.__annotations__})


@register("hp_trials")
def hp_trials(spark, sf):
    """Seeded boosting search over ten parameters: each trial = 3-fold CV + 17-threshold
    sweep; value = lowest mean cost over thresholds."""
    df = search_folds(spark, sf)
    rows = [(t["trial"], t["value"], t["best_threshold"], t["mean_roc_auc"], t["duration_sec"], t["weight_multiplier"],
             t["rounds"], t["step"], t["depth"], t["min_weight"], t["subsample"], t["colsample"], t["gamma"], t["alpha"],
             t["reg_lambda"]) for t in _trials(spark, df)]
    _drop(spark, df)
    schema = T.StructType([T.StructField(n, t) for n, t in [
        ("number", T.IntegerType()), ("value", T.DoubleType()), ("best_threshold", T.DoubleType()),
        ("mean_roc_auc", T.DoubleType()), ("duration_sec", T.DoubleType()),
        ("params_weight_multiplier", T.DoubleType()), ("params_n_estimators", T.IntegerType()),
        ("params_learning_rate", T.DoubleType()), ("params_max_depth", T.IntegerType()),
        ("params_min_child_weight", T.IntegerType()), ("params_subsample", T.DoubleType()),
        ("params_colsample", T.DoubleType()), ("params_gamma", T.DoubleType()),
        ("params_reg_alpha", T.DoubleType()), ("params_reg_lambda", T.DoubleType())]])
    return spark.createDataFrame(rows, schema)


@register("refit_best")
def refit_best(spark, sf):
    """The best trial of the search (lowest value, then lowest number): validated
    again on the folds, fitted on all rows of the search, saved, loaded and applied to
    all rows. Every row carries the trial and the lowest-cost threshold of its CV."""
    df = search_folds(spark, sf)
    feats = feature_names(df)
    best = min(_trials(spark, df), key=lambda t: (t["value"], t["trial"]))
    spec = _trial_spec(best)
    path = f"{stage_path(spark, 'models')}/{uuid.uuid4().hex[:12]}"

    def check():
        checked = _written(spark, ml.cross_validate(df, feats, spec, ID), "trial-scores")
        row = ev.best_threshold(ev.threshold_curve(ev.threshold_sweep(checked, group_cols=["fold"]))).collect()[0]
        _drop(spark, checked)
        return row

    with ThreadPoolExecutor(max_workers=ml.fits_at_once(df, 2)) as pool:      # the fit of all rows needs nothing of the folds'
        fitted = pool.submit(lambda: ml.fit_model(df, feats, spec, "label", seed=42).save(spark, path))
        row = pool.submit(check).result()
        fitted.result()
    _drop(spark, df)
    scored = ml.FittedModel.load(spark, path).score(modeling_train(spark, sf), ID, "label")
    threshold = float(row["threshold"])
    return scored.select("*", (F.col("score") >= F.lit(threshold)).cast("int").alias("prediction"),
                         F.lit(best["trial"]).alias("trial"), F.lit(threshold).alias("threshold"),
                         F.lit(float(row["mean_business_cost"])).alias("mean_business_cost"))


@register("cv_comparison")
def cv_comparison(spark, sf):
    """Per fitted model family (five): mean and std over the 3 folds of every metric at
    0.5, refit per fold, sorted by mean cost."""
    df = search_folds(spark, sf)
    feats = feature_names(df)
    medians = ml.fold_medians(df, feats)               # once for all families that impute
    aggs = [a.alias(f"{p}_{x}") for x in CV_METRICS for p, a in (("mean", F.avg(x)), ("std", F.stddev_samp(x)))]

    def family(spec):
        scored = _written(spark, ml.cross_validate(df, feats, spec, ID, medians_by_fold=medians), "cv-scores")
        row = ev.metric_bundle(scored, 0.5, group_cols=["fold"]).agg(*aggs).collect()[0]
        _drop(spark, scored)
        return spec.name, *row

    # families are independent: one-task fits of boosting fill the cores that short jobs leave
    with ThreadPoolExecutor(max_workers=ml.fits_at_once(df, 5)) as pool:
        rows = list(pool.map(family, (ml.leaf_wise_spec(), ml.depth_wise_spec(), ml.logistic_spec(max_iter=500),
                                      ml.random_forest_spec(), ml.mlp_spec(max_iter=50))))
    _drop(spark, df)
    names = [f"{p}_{x}" for x in CV_METRICS for p in ("mean", "std")]
    table = spark.createDataFrame(rows, "model string, " + ", ".join(f"{n} double" for n in names))
    return finish(table.orderBy("mean_business_cost", "model"))


@register("feature_importance")
def feature_importance(spark, sf):
    """Mean split gain per feature of the boosted model, normalised, ranked."""
    _, fit, _ = holdout(spark, sf)
    model = ml.fit_model(fit, feature_names(fit), ml.gbt_spec(), "label", seed=42)
    return ml.gain_importance_table(model, spark)
