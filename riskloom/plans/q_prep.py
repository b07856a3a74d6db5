"""Column operators, one-hot, application base, star join and split queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.names import clean_names, clean_text
from riskloom.functions.nulls import (bools_to_int_all, ieee_ratio, not_equal_keep_null,
                                      replace_inf_all)
from riskloom.operators import onehot
from riskloom.plans import features as fx
from riskloom.plans import modeling
from riskloom.plans.catalog import finish, register
from riskloom.plans.oracle import VOCAB, finish_sql, q, rollup_sql, with_ctes
from riskloom.plans.q_features import (BB_COLS, BUREAU_VOCAB, CC_NUMERIC_COLUMNS, INST_CLEAN,
                                       POS_VOCAB, PREV_CLEAN, PREV_VOCAB, _bb_sql, _status_conditional)
from riskloom.sources import testbed as tb


def ieee_sql(a: str, b: str) -> str:
    return (f"CASE WHEN {b} = 0 THEN (CASE WHEN {a} > 0 THEN 'inf'::DOUBLE WHEN {a} < 0 THEN '-inf'::DOUBLE END) "
            f"ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END")


def kind(c: str) -> F.Column:
    """Class of a ratio value, so the check sees +inf/-inf/NULL apart."""
    x = F.col(c)
    return (F.when(x.isNull(), "null").when(x == float("inf"), "pinf")
            .when(x == float("-inf"), "ninf").otherwise("finite"))


def kind_sql(c: str) -> str:
    return (f"CASE WHEN {c} IS NULL THEN 'null' WHEN {c} = 'inf'::DOUBLE THEN 'pinf' "
            f"WHEN {c} = '-inf'::DOUBLE THEN 'ninf' ELSE 'finite' END")


# ------------------------------------------------------------------ B1, B2
@register("sentinel_to_null", with_ctes("prev") + """
SELECT SK_ID_PREV, NULLIF(DAYS_FIRST_DUE, 365243) AS DAYS_FIRST_DUE,
       NULLIF(DAYS_LAST_DUE, 365243) AS DAYS_LAST_DUE, NULLIF(DAYS_TERMINATION, 365243) AS DAYS_TERMINATION
FROM prev""")
def sentinel_to_null(spark, sf):
    df = fx.replace_sentinels(tb.previous_application(spark, sf), fx.PREVIOUS_SENTINEL_COLUMNS)
    return finish(df.select("SK_ID_PREV", "DAYS_FIRST_DUE", "DAYS_LAST_DUE", "DAYS_TERMINATION"))


@register("filter_not_value", with_ctes("app") + """
SELECT SK_ID_CURR, CODE_GENDER FROM app WHERE CODE_GENDER IS DISTINCT FROM 'XNA'""")
def filter_not_value(spark, sf):
    """CODE_GENDER != 'XNA' keeping the rows where CODE_GENDER is missing."""
    app = tb.application(spark, sf)
    return app.filter(not_equal_keep_null("CODE_GENDER", "XNA")).select("SK_ID_CURR", "CODE_GENDER")


# --------------------------------------------------------------- B3, B4, B5, B6
def _application_ratios_sql() -> str:
    sel = []
    for name, (a, b) in fx.APPLICATION_RATIOS.items():
        sel.append(f"{ieee_sql(a, b)} AS {name}")
    inner = (with_ctes("app") + ", appc AS (SELECT * REPLACE (NULLIF(DAYS_EMPLOYED, 365243) AS DAYS_EMPLOYED) "
             "FROM app WHERE CODE_GENDER IS DISTINCT FROM 'XNA'),\n r AS (SELECT SK_ID_CURR, "
             + ", ".join(sel) + " FROM appc)\n SELECT *, "
             + ", ".join(f"{kind_sql(n)} AS {n}_KIND" for n in fx.APPLICATION_RATIOS) + " FROM r")
    return finish_sql(inner, list(fx.APPLICATION_RATIOS))


@register("application_ratios", _application_ratios_sql)
def application_ratios(spark, sf):
    """Five business ratios with IEEE x/0 = ±inf and 0/0 = missing."""
    app = fx.clean_application(tb.application(spark, sf))
    df = fx.add_ratios(app, fx.APPLICATION_RATIOS).select("SK_ID_CURR", *fx.APPLICATION_RATIOS)
    return finish(df.select("*", *[kind(n).alias(f"{n}_KIND") for n in fx.APPLICATION_RATIOS]))


@register("prev_ratio", lambda: finish_sql(
    with_ctes("prev") + f", r AS (SELECT SK_ID_PREV, {ieee_sql('AMT_APPLICATION', 'AMT_CREDIT')} AS APP_CREDIT_PERC "
    "FROM prev) SELECT *, " + kind_sql("APP_CREDIT_PERC") + " AS APP_CREDIT_PERC_KIND FROM r",
    ["APP_CREDIT_PERC"]))
def prev_ratio(spark, sf):
    df = fx.clean_previous(tb.previous_application(spark, sf)).select("SK_ID_PREV", "APP_CREDIT_PERC")
    return finish(df.select("*", kind("APP_CREDIT_PERC").alias("APP_CREDIT_PERC_KIND")))


@register("payment_ratio_diff", lambda: finish_sql(
    with_ctes("inst") + "," + INST_CLEAN + "\nSELECT SK_ID_PREV, NUM_INSTALMENT_NUMBER, PAYMENT_PERC, PAYMENT_DIFF, "
    + kind_sql("PAYMENT_PERC") + " AS PAYMENT_PERC_KIND FROM instc", ["PAYMENT_PERC", "PAYMENT_DIFF"]))
def payment_ratio_diff(spark, sf):
    df = fx.clean_installments(tb.installments_payments(spark, sf))
    return finish(df.select("SK_ID_PREV", "NUM_INSTALMENT_NUMBER", "PAYMENT_PERC", "PAYMENT_DIFF",
                            kind("PAYMENT_PERC").alias("PAYMENT_PERC_KIND")))


@register("dpd_dbd", lambda: finish_sql(
    with_ctes("inst") + "," + INST_CLEAN + "\nSELECT SK_ID_PREV, NUM_INSTALMENT_NUMBER, DPD, DBD FROM instc",
    ["DPD", "DBD"]))
def dpd_dbd(spark, sf):
    """Days past / before due, clamped at 0; a missing payment day gives 0."""
    df = fx.clean_installments(tb.installments_payments(spark, sf))
    return finish(df.select("SK_ID_PREV", "NUM_INSTALMENT_NUMBER", "DPD", "DBD"))


# ------------------------------------------------------------------- B8, E3
@register("tag_union", with_ctes("app") + """
SELECT SK_ID_CURR, TARGET, dataset_type, CODE_GENDER FROM app""")
def tag_union(spark, sf):
    """Train and test tagged and unioned by name; test TARGET is missing."""
    u = fx.tag_union(tb.application_train(spark, sf), tb.application_test(spark, sf))
    return u.select("SK_ID_CURR", "TARGET", "dataset_type", "CODE_GENDER")


# -------------------------------------------------------------- B9, B10, B12
@register("inf_to_null", lambda: with_ctes("inst") + "," + INST_CLEAN + """
SELECT SK_ID_PREV, NUM_INSTALMENT_NUMBER,
  CASE WHEN isinf(PAYMENT_PERC) OR isnan(PAYMENT_PERC) THEN NULL ELSE PAYMENT_PERC END IS NULL AS PAYMENT_PERC_MISSING,
  CASE WHEN isinf(PAYMENT_PERC) OR isnan(PAYMENT_PERC) THEN NULL ELSE round(PAYMENT_PERC + 3.3e-07, 4) + 0.0e0 END AS PAYMENT_PERC
FROM instc""")
def inf_to_null(spark, sf):
    """±inf and NaN -> NULL on every floating column (one projection)."""
    df = replace_inf_all(fx.clean_installments(tb.installments_payments(spark, sf)))
    return finish(df.select("SK_ID_PREV", "NUM_INSTALMENT_NUMBER",
                            F.col("PAYMENT_PERC").isNull().alias("PAYMENT_PERC_MISSING"), "PAYMENT_PERC"))


@register("bool_to_int", with_ctes("app") + """
SELECT SK_ID_CURR, CAST(TARGET = 1 AS TINYINT) AS IS_DEFAULT, CAST(FLAG_OWN_CAR = 'Y' AS TINYINT) AS OWNS_CAR,
       CAST(CODE_GENDER = 'F' AS TINYINT) AS IS_F
FROM app""")
def bool_to_int(spark, sf):
    app = tb.application(spark, sf).select(
        "SK_ID_CURR", (F.col("TARGET") == 1).alias("IS_DEFAULT"), (F.col("FLAG_OWN_CAR") == "Y").alias("OWNS_CAR"),
        (F.col("CODE_GENDER") == "F").alias("IS_F"))
    return bools_to_int_all(app)


@register("drop_columns", with_ctes("app") + """
SELECT * EXCLUDE (DAYS_BIRTH, CNT_CHILDREN, FLAG_OWN_CAR) FROM app""")
def drop_columns(spark, sf):
    """Drop a column list; names that do not exist are ignored."""
    return tb.application(spark, sf).drop("DAYS_BIRTH", "NOT_PRESENT", "CNT_CHILDREN", "FLAG_OWN_CAR", "ALSO_NOT")


# ---------------------------------------------------------------- C1, C2
APP_VOCAB = {"CODE_GENDER": VOCAB["CODE_GENDER"], "NAME_CONTRACT_TYPE": VOCAB["NAME_CONTRACT_TYPE_APP"],
             "FLAG_OWN_CAR": VOCAB["FLAG_OWN_CAR"]}


@register("onehot_vocab", with_ctes("app") + """
SELECT DISTINCT column_name, value FROM (
  SELECT 'CODE_GENDER' AS column_name, CODE_GENDER AS value FROM app
  UNION ALL SELECT 'NAME_CONTRACT_TYPE', NAME_CONTRACT_TYPE FROM app
  UNION ALL SELECT 'FLAG_OWN_CAR', FLAG_OWN_CAR FROM app) v
WHERE value IS NOT NULL""")
def onehot_vocab(spark, sf):
    """Distinct values of every text column in one job (the fitted vocabulary)."""
    app = tb.application(spark, sf)
    return onehot.vocabulary_frame(app, onehot.text_columns(app, exclude=("dataset_type",)))


def _dummies_sql(vocab: dict[str, list[str]]) -> str:
    out = []
    for c, values in vocab.items():
        for v in values:
            out.append(f"CAST(COALESCE({c} = '{v}', false) AS TINYINT) AS {q(c + '_' + v)}")
        out.append(f"CAST({c} IS NULL AS TINYINT) AS {q(c + '_nan')}")
    return ", ".join(out)


RAW_APP_VOCAB = dict(APP_VOCAB, CODE_GENDER=["F", "M", "XNA"])


@register("onehot_encode", lambda: with_ctes("app") + f"""
SELECT SK_ID_CURR, {_dummies_sql(RAW_APP_VOCAB)} FROM app""")
def onehot_encode(spark, sf):
    app = tb.application(spark, sf)
    vocab = onehot.fit_vocabulary(app, exclude=("dataset_type",))
    enc = onehot.transform(app, vocab)
    return enc.select("SK_ID_CURR", *onehot.dummy_names(vocab))


# ------------------------------------------------------------ E2 final, E5
def application_base_sql() -> str:
    ratios = ", ".join(f"{ieee_sql(a, b)} AS {n}" for n, (a, b) in fx.APPLICATION_RATIOS.items())
    passthrough = ("SK_ID_CURR, TARGET, dataset_type, CNT_CHILDREN, DAYS_BIRTH, DAYS_EMPLOYED, "
                   "AMT_INCOME_TOTAL, AMT_CREDIT, AMT_ANNUITY, CNT_FAM_MEMBERS")
    return ("appc AS (SELECT * REPLACE (NULLIF(DAYS_EMPLOYED, 365243) AS DAYS_EMPLOYED) FROM app "
            "WHERE CODE_GENDER IS DISTINCT FROM 'XNA'),\n"
            f"base AS (SELECT {passthrough}, {ratios}, {_dummies_sql(APP_VOCAB)} FROM appc)")


def final_dataset_parts() -> tuple[str, list[tuple[str, bool]]]:
    bb_body, _ = _bb_sql()
    bur_body, bur_items = rollup_sql("j", "SK_ID_CURR", "BURO", fx.BUREAU_NUMERIC, vocab=BUREAU_VOCAB,
                                     extra_mean=BB_COLS, count_name="BURO_CREDIT_COUNT")
    prev_body, prev_items = rollup_sql("prevc", "SK_ID_CURR", "PREV", fx.PREVIOUS_NUMERIC, vocab=PREV_VOCAB,
                                       count_name="PREV_APPLICATION_COUNT", conditional=_status_conditional())
    pos_body, pos_items = rollup_sql("pos", "SK_ID_CURR", "POS", fx.POS_NUMERIC, vocab=POS_VOCAB,
                                     count_name="POS_CASH_COUNT")
    inst_body, inst_items = rollup_sql("instc", "SK_ID_CURR", "INSTAL", fx.INSTALLMENTS_NUMERIC,
                                       count_name="INSTAL_COUNT")
    cc_body, cc_items = rollup_sql("cc", "SK_ID_CURR", "CC", {c: list(fx.CARD_AGGS) for c in CC_NUMERIC_COLUMNS},
                                   vocab={"NAME_CONTRACT_STATUS": VOCAB["NAME_CONTRACT_STATUS_CC"]},
                                   count_name="CC_COUNT")
    sql = (with_ctes("app", "bur", "bb", "prev", "pos", "inst", "cc") + ",\n" + application_base_sql() + ",\n"
           f"bba AS ({bb_body}),\n"
           "j AS (SELECT bur.* EXCLUDE (SK_ID_BUREAU), bba.* EXCLUDE (SK_ID_BUREAU) "
           "FROM bur LEFT JOIN bba ON bur.SK_ID_BUREAU = bba.SK_ID_BUREAU),\n"
           f"f_bur AS ({bur_body}),\n{PREV_CLEAN},\nf_prev AS ({prev_body}),\nf_pos AS ({pos_body}),\n"
           f"{INST_CLEAN},\nf_inst AS ({inst_body}),\nf_cc AS ({cc_body}),\n"
           "final AS (SELECT * FROM base LEFT JOIN f_bur USING (SK_ID_CURR) LEFT JOIN f_prev USING (SK_ID_CURR) "
           "LEFT JOIN f_pos USING (SK_ID_CURR) LEFT JOIN f_inst USING (SK_ID_CURR) "
           "LEFT JOIN f_cc USING (SK_ID_CURR))\n")
    base_doubles = [("AMT_INCOME_TOTAL", True), ("AMT_CREDIT", True), ("AMT_ANNUITY", True),
                    ("CNT_FAM_MEMBERS", True)] + [(n, True) for n in fx.APPLICATION_RATIOS]
    return sql, base_doubles + bur_items + prev_items + pos_items + inst_items + cc_items


def _doubles(items) -> list[str]:
    return [n for n, d in items if d]


def final_dataset_sql() -> str:
    sql, items = final_dataset_parts()
    return finish_sql(sql + "SELECT * FROM final", _doubles(items))


@register("final_dataset", final_dataset_sql)
def final_dataset(spark, sf):
    """Application base star-joined with the five rollups (one row per client)."""
    return finish(modeling.final_dataset(spark, sf))


@register("split_train_test", lambda: final_dataset_parts()[0] + """
SELECT 'train' AS part, SK_ID_CURR, TARGET FROM final WHERE dataset_type = 'train'
UNION ALL SELECT 'test', SK_ID_CURR, NULL FROM final WHERE dataset_type = 'test'""")
def split_train_test(spark, sf):
    train, test = fx.split_train_test(modeling.processed(spark, sf))
    if "TARGET" in test.columns or "dataset_type" in train.columns:
        raise AssertionError("split left the target in test or the marker in train")
    return (train.select(F.lit("train").alias("part"), "SK_ID_CURR", "TARGET")
            .unionByName(test.select(F.lit("test").alias("part"), "SK_ID_CURR",
                                     F.lit(None).cast("int").alias("TARGET"))))


# ---------------------------------------------------------------- B13, B14
@register("features_target", lambda: final_dataset_parts()[0] + """
SELECT SK_ID_CURR, CAST(TARGET AS INTEGER) AS TARGET, DAYS_EMPLOYED_PERC IS NULL AS RATIO_MISSING,
       CAST(BURO_CREDIT_COUNT AS BIGINT) AS BURO_CREDIT_COUNT
FROM final WHERE dataset_type = 'train'""")
def features_target(spark, sf):
    """Feature list = all columns but target and id; label cast to int."""
    train, _ = fx.split_train_test(modeling.processed(spark, sf))
    feats, xy = modeling.features_and_label(train)
    if "TARGET" in feats or "SK_ID_CURR" in feats:
        raise AssertionError("target or id leaked into features")
    return xy.select("SK_ID_CURR", "TARGET", F.col("DAYS_EMPLOYED_PERC").isNull().alias("RATIO_MISSING"),
                     "BURO_CREDIT_COUNT")


@register("clean_category_names", r"""
WITH n AS (SELECT 'PREV_' || p_type || ' <' || p_brand || '>, [' || p_name || ']/MEAN' AS original, count(*) AS n FROM part GROUP BY 1)
SELECT original, n, regexp_replace(original, '[][<> /,]', '_', 'g') AS light,
       trim(regexp_replace(regexp_replace(original, '[^A-Za-z0-9_]+', '_', 'g'), '_+', '_', 'g'), '_') AS strict
FROM n""")
def clean_category_names(spark, sf):
    """Feature names made of category texts, cleaned in the light and the strict mode."""
    parts = tb.read(spark, sf, "part")
    name = F.concat(F.lit("PREV_"), "p_type", F.lit(" <"), "p_brand", F.lit(">, ["), "p_name", F.lit("]/MEAN"))
    names = parts.groupBy(name.alias("original")).agg(F.count(F.lit(1)).alias("n"))
    return names.select("original", "n", clean_text(F.col("original"), "light").alias("light"),
                        clean_text(F.col("original"), "strict").alias("strict"))


@register("clean_names")
def clean_names_query(spark, sf):
    """Names of the final table (data-dependent: category text) in the three modes."""
    cols = modeling.processed(spark, sf).columns + ["a b", "a/b", "a_b", "[x]<y>", ""]
    rows = list(zip(cols, clean_names(cols, "light"), clean_names(cols, "strict"), clean_names(cols, "dedupe")))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("original", "light", "strict", "dedupe")])
    return spark.createDataFrame(rows, schema)
