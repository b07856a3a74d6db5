"""Feature-table queries: rollups, conditional rollups, group counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import onehot
from riskloom.operators.aggspec import AggSpec, multi_agg
from riskloom.plans import features as fx
from riskloom.plans.catalog import finish, register
from riskloom.plans.oracle import VOCAB, finish_sql, q, rollup_sql, with_ctes
from riskloom.sources import testbed as tb


def _bb_sql() -> tuple[str, list[tuple[str, bool]]]:
    return rollup_sql("bb", "SK_ID_BUREAU", "BB", fx.BUREAU_BALANCE_NUMERIC,
                      vocab={"STATUS": VOCAB["STATUS"]})


def _doubles(items) -> list[str]:
    return [n for n, d in items if d]


def bureau_balance_agg_sql() -> str:
    sql, items = _bb_sql()
    return finish_sql(with_ctes("bb") + sql, _doubles(items))


@register("bureau_balance_agg", bureau_balance_agg_sql)
def bureau_balance_agg(spark, sf):
    return finish(fx.bureau_balance_features(tb.bureau_balance(spark, sf)))


BUREAU_VOCAB = {k: VOCAB[k] for k in ("CREDIT_ACTIVE", "CREDIT_CURRENCY", "CREDIT_TYPE")}
BB_COLS = ["BB_MONTHS_BALANCE_MIN", "BB_MONTHS_BALANCE_MAX", "BB_MONTHS_BALANCE_SIZE",
           "BB_STATUS_A_MEAN", "BB_STATUS_N_MEAN", "BB_STATUS_R_MEAN", "BB_STATUS_NAN_MEAN"]


def _bureau_features_sql() -> tuple[str, list[tuple[str, bool]]]:
    bb_sql, _ = _bb_sql()
    body, items = rollup_sql("j", "SK_ID_CURR", "BURO", fx.BUREAU_NUMERIC, vocab=BUREAU_VOCAB,
                             extra_mean=BB_COLS, count_name="BURO_CREDIT_COUNT")
    sql = (with_ctes("bur", "bb") + f", bba AS ({bb_sql}),\n"
           "j AS (SELECT bur.* EXCLUDE (SK_ID_BUREAU), bba.* EXCLUDE (SK_ID_BUREAU) "
           "FROM bur LEFT JOIN bba ON bur.SK_ID_BUREAU = bba.SK_ID_BUREAU)\n" + body)
    return sql, items


def bureau_features_sql() -> str:
    sql, items = _bureau_features_sql()
    return finish_sql(sql, _doubles(items))


@register("bureau_features", bureau_features_sql)
def bureau_features(spark, sf):
    return finish(fx.bureau_features(tb.bureau(spark, sf), tb.bureau_balance(spark, sf)))


def left_join_rollup_sql() -> str:
    bb_sql, items = _bb_sql()
    sql = (with_ctes("bur", "bb") + f", bba AS ({bb_sql})\n"
           "SELECT bur.SK_ID_BUREAU, bur.SK_ID_CURR, bba.* EXCLUDE (SK_ID_BUREAU) "
           "FROM bur LEFT JOIN bba ON bur.SK_ID_BUREAU = bba.SK_ID_BUREAU")
    return finish_sql(sql, _doubles(items))


@register("left_join_rollup", left_join_rollup_sql)
def left_join_rollup(spark, sf):
    """Child rollup left-joined onto its parent: credits without balance rows keep NULLs."""
    bb = fx.bureau_balance_features(tb.bureau_balance(spark, sf))
    bur = tb.bureau(spark, sf).select("SK_ID_BUREAU", "SK_ID_CURR")
    return finish(bur.join(bb, "SK_ID_BUREAU", "left"))


MULTI_AGG_SPEC = {
    "AMT_CREDIT_SUM": ["min", "max", "mean", "sum", "var", "std"],
    "DAYS_CREDIT": ["min", "max", "mean", "sum", "var", "size", "nunique"],
    "AMT_ANNUITY": ["mean", "sum", "var", "size", "nunique"],
    "DAYS_ENDDATE_FACT": ["min", "sum", "var"],
}


def multi_agg_sql() -> str:
    sql, items = rollup_sql("bur", "SK_ID_CURR", "M", MULTI_AGG_SPEC, count_name="M_COUNT")
    return finish_sql(with_ctes("bur") + sql, _doubles(items))


@register("multi_agg", multi_agg_sql)
def multi_agg_query(spark, sf):
    """Every aggregate kind on one spec, incl. NULL-only groups (sum -> 0, var -> NULL)."""
    spec = AggSpec(key="SK_ID_CURR", prefix="M", numeric=MULTI_AGG_SPEC, count_name="M_COUNT")
    return finish(multi_agg(tb.bureau(spark, sf), spec))


PREV_VOCAB = {"NAME_CONTRACT_TYPE": VOCAB["NAME_CONTRACT_TYPE_PREV"],
              "NAME_CONTRACT_STATUS": VOCAB["NAME_CONTRACT_STATUS_PREV"],
              "NAME_YIELD_GROUP": VOCAB["NAME_YIELD_GROUP"]}
PREV_CLEAN = """prevc AS (
  SELECT * REPLACE (NULLIF(DAYS_FIRST_DUE, 365243) AS DAYS_FIRST_DUE,
                    NULLIF(DAYS_LAST_DUE, 365243) AS DAYS_LAST_DUE,
                    NULLIF(DAYS_TERMINATION, 365243) AS DAYS_TERMINATION),
    CASE WHEN AMT_CREDIT = 0 THEN (CASE WHEN AMT_APPLICATION > 0 THEN 'inf'::DOUBLE
                                        WHEN AMT_APPLICATION < 0 THEN '-inf'::DOUBLE END)
         ELSE AMT_APPLICATION / AMT_CREDIT END AS APP_CREDIT_PERC
  FROM prev)"""


def _status_conditional() -> dict:
    return {p: (f"NAME_CONTRACT_STATUS = '{v}'", fx.STATUS_NUMERIC) for p, v in fx.STATUS_PREFIXES.items()}


def previous_features_sql() -> str:
    sql, items = rollup_sql("prevc", "SK_ID_CURR", "PREV", fx.PREVIOUS_NUMERIC, vocab=PREV_VOCAB,
                            count_name="PREV_APPLICATION_COUNT", conditional=_status_conditional())
    return finish_sql(with_ctes("prev") + "," + PREV_CLEAN + "\n" + sql, _doubles(items))


@register("previous_features", previous_features_sql)
def previous_features(spark, sf):
    return finish(fx.previous_features(tb.previous_application(spark, sf)))


def status_features_sql() -> str:
    sql, items = rollup_sql("prevc", "SK_ID_CURR", "PREV", {}, conditional=_status_conditional())
    return finish_sql(with_ctes("prev") + "," + PREV_CLEAN + "\n" + sql, _doubles(items))


@register("status_features", status_features_sql)
def status_features(spark, sf):
    """APPROVED_/REFUSED_ rollups alone: clients without such rows get NULL, count too."""
    df = fx.clean_previous(tb.previous_application(spark, sf))
    cond = {p: (F.col("NAME_CONTRACT_STATUS") == v, fx.STATUS_NUMERIC) for p, v in fx.STATUS_PREFIXES.items()}
    return finish(multi_agg(df, AggSpec(key="SK_ID_CURR", prefix="PREV", conditional=cond)))


POS_VOCAB = {"NAME_CONTRACT_STATUS": VOCAB["NAME_CONTRACT_STATUS_POS"]}


def pos_features_sql() -> str:
    sql, items = rollup_sql("pos", "SK_ID_CURR", "POS", fx.POS_NUMERIC, vocab=POS_VOCAB,
                            count_name="POS_CASH_COUNT")
    return finish_sql(with_ctes("pos") + sql, _doubles(items))


@register("pos_features", pos_features_sql)
def pos_features(spark, sf):
    return finish(fx.pos_features(tb.pos_cash_balance(spark, sf)))


INST_CLEAN = """instc AS (
  SELECT *,
    CASE WHEN AMT_INSTALMENT = 0 THEN (CASE WHEN AMT_PAYMENT > 0 THEN 'inf'::DOUBLE
                                            WHEN AMT_PAYMENT < 0 THEN '-inf'::DOUBLE END)
         ELSE AMT_PAYMENT / AMT_INSTALMENT END AS PAYMENT_PERC,
    AMT_INSTALMENT - AMT_PAYMENT AS PAYMENT_DIFF,
    CASE WHEN DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT > 0 THEN DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT ELSE 0 END AS DPD,
    CASE WHEN DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT > 0 THEN DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT ELSE 0 END AS DBD
  FROM inst)"""


def installments_features_sql() -> str:
    sql, items = rollup_sql("instc", "SK_ID_CURR", "INSTAL", fx.INSTALLMENTS_NUMERIC,
                            count_name="INSTAL_COUNT")
    return finish_sql(with_ctes("inst") + "," + INST_CLEAN + "\n" + sql, _doubles(items))


@register("installments_features", installments_features_sql)
def installments_features(spark, sf):
    return finish(fx.installments_features(tb.installments_payments(spark, sf)))


CC_NUMERIC_COLUMNS = ["MONTHS_BALANCE", "AMT_BALANCE", "AMT_DRAWINGS_CURRENT", "CNT_DRAWINGS_CURRENT",
                      "AMT_PAYMENT_CURRENT", "AMT_INST_MIN_REGULARITY", "AMT_RECIVABLE", "SK_DPD"]


def credit_card_features_sql() -> str:
    spec = {c: list(fx.CARD_AGGS) for c in CC_NUMERIC_COLUMNS}
    sql, items = rollup_sql("cc", "SK_ID_CURR", "CC", spec,
                            vocab={"NAME_CONTRACT_STATUS": VOCAB["NAME_CONTRACT_STATUS_CC"]},
                            count_name="CC_COUNT")
    return finish_sql(with_ctes("cc") + sql, _doubles(items))


@register("credit_card_features", credit_card_features_sql)
def credit_card_features(spark, sf):
    return finish(fx.credit_card_features(tb.credit_card_balance(spark, sf)))


def group_count_sql() -> str:
    return with_ctes("bur", "prev", "pos", "inst", "cc") + """
SELECT k.SK_ID_CURR, b.n AS BURO_CREDIT_COUNT, p.n AS PREV_APPLICATION_COUNT,
       s.n AS POS_CASH_COUNT, i.n AS INSTAL_COUNT, c.n AS CC_COUNT
FROM (SELECT c_custkey AS SK_ID_CURR FROM customer) k
LEFT JOIN (SELECT SK_ID_CURR, count(*) AS n FROM bur GROUP BY 1) b USING (SK_ID_CURR)
LEFT JOIN (SELECT SK_ID_CURR, count(*) AS n FROM prev GROUP BY 1) p USING (SK_ID_CURR)
LEFT JOIN (SELECT SK_ID_CURR, count(*) AS n FROM pos GROUP BY 1) s USING (SK_ID_CURR)
LEFT JOIN (SELECT SK_ID_CURR, count(*) AS n FROM inst GROUP BY 1) i USING (SK_ID_CURR)
LEFT JOIN (SELECT SK_ID_CURR, count(*) AS n FROM cc GROUP BY 1) c USING (SK_ID_CURR)"""


@register("group_count", group_count_sql)
def group_count(spark, sf):
    """Per-client row counts of the five history tables, joined onto all clients."""
    base = tb.read(spark, sf, "customer").select(F.col("c_custkey").alias("SK_ID_CURR"))
    sides = [
        (tb.bureau(spark, sf), "BURO_CREDIT_COUNT"),
        (tb.previous_application(spark, sf), "PREV_APPLICATION_COUNT"),
        (tb.pos_cash_balance(spark, sf), "POS_CASH_COUNT"),
        (tb.installments_payments(spark, sf), "INSTAL_COUNT"),
        (tb.credit_card_balance(spark, sf), "CC_COUNT"),
    ]
    counts = [multi_agg(df.select("SK_ID_CURR"), AggSpec(key="SK_ID_CURR", prefix="X", count_name=n))
              for df, n in sides]
    return fx.star_join(base, counts)


def category_share_sql() -> str:
    sql, items = rollup_sql("bur", "SK_ID_CURR", "BURO", {}, vocab=BUREAU_VOCAB)
    return finish_sql(with_ctes("bur") + sql, _doubles(items))


@register("category_share", category_share_sql)
def category_share(spark, sf):
    """Share of each category value per client, without materialising dummies."""
    bur = tb.bureau(spark, sf)
    vocab = onehot.fit_vocabulary(bur)
    return finish(multi_agg(bur, AggSpec(key="SK_ID_CURR", prefix="BURO", vocab=vocab)))


def guarded_agg_sql() -> str:
    spec = {"DAYS_CREDIT": ["min", "max"], "AMT_ANNUITY": ["mean"]}
    sql, items = rollup_sql("bur", "SK_ID_CURR", "BURO", spec)
    return finish_sql(with_ctes("bur") + sql, _doubles(items))


@register("guarded_agg", guarded_agg_sql)
def guarded_agg(spark, sf):
    """Spec names columns the input lacks; they are skipped at plan time."""
    spec = AggSpec(key="SK_ID_CURR", prefix="BURO",
                   numeric={"DAYS_CREDIT": ["min", "max"], "NOT_A_COLUMN": ["mean"],
                            "AMT_ANNUITY": ["mean"], "ALSO_ABSENT": ["sum"]})
    return finish(multi_agg(tb.bureau(spark, sf), spec))
