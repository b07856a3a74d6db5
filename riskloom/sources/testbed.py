"""Reference-shaped tables derived from the driver's test tables.

The reference works on a client table plus five history tables. The driver's
tables are a TPC-H-like star, so each reference table is a projection (and
for installments/card a join) of one of them:

  application      <- customer    (client = c_custkey, TARGET = c_acctbal < 0,
                                    test rows: c_custkey % 7 = 0)
  bureau, previous <- orders      (credit = o_orderkey, client = o_custkey)
  bureau_balance   <- lineitem    (credit = l_orderkey)
  pos_cash         <- events      (client = user_id)
  installments,
  credit_card      <- lineitem JOIN orders

The projections deliberately produce the edge cases the rules are about:
the 365243 sentinel, 'XNA' and NULL categories, x/0 and 0/0 ratios, NULL
payments and negative day gaps. All derived values use integer arithmetic or a
single IEEE operation, so every engine computes them bit for bit the same.
Every table keeps all of its source rows.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: reference day for the relative day columns.
REFERENCE_DAY = "2002-01-01"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _days(ts: str) -> Column:
    """Whole days from the reference day to the timestamp's date (negative)."""
    return F.datediff(F.to_date(F.col(ts)), F.lit(REFERENCE_DAY).cast("date"))


def _m(c: str, k: int) -> Column:
    return F.col(c) % k


def _dbl(c: Column) -> Column:
    return c.cast("double")


def application(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Application rows (train and test together) with the split marker."""
    c = read(spark, sf_dir, "customer")
    is_test = _m("c_custkey", 7) == 0
    return c.select(
        F.col("c_custkey").alias("SK_ID_CURR"),
        F.when(~is_test, (F.col("c_acctbal") < 0).cast("int")).alias("TARGET"),
        F.when(is_test, "test").otherwise("train").alias("dataset_type"),
        F.when(F.col("c_nationkey") == 24, "XNA")
         .when(F.col("c_nationkey") == 23, None)
         .when(_m("c_nationkey", 2) == 0, "F").otherwise("M").alias("CODE_GENDER"),
        F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("NAME_CONTRACT_TYPE"),
        F.when(_m("c_custkey", 3) == 0, "Y").otherwise("N").alias("FLAG_OWN_CAR"),
        (F.col("c_nationkey") % 4).cast("int").alias("CNT_CHILDREN"),
        (-(F.lit(7000) + (F.col("c_custkey") * 37) % 18000)).cast("int").alias("DAYS_BIRTH"),
        F.when(_m("c_custkey", 11) == 0, F.lit(365243))
         .otherwise(-((F.col("c_custkey") * 13) % 9000)).cast("int").alias("DAYS_EMPLOYED"),
        (_dbl((F.col("c_custkey") * 7) % 40) * F.lit(2500.0)).alias("AMT_INCOME_TOTAL"),
        (_dbl(_m("c_custkey", 13)) * F.lit(15000.0)).alias("AMT_CREDIT"),
        (_dbl(F.nullif(_m("c_custkey", 17), F.lit(0))) * F.lit(900.0)).alias("AMT_ANNUITY"),
        _dbl(_m("c_custkey", 5)).alias("CNT_FAM_MEMBERS"),
    )


def application_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (application(spark, sf_dir).filter(F.col("dataset_type") == "train")
            .drop("dataset_type"))


def application_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (application(spark, sf_dir).filter(F.col("dataset_type") == "test")
            .drop("dataset_type", "TARGET"))


def bureau(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    days = _days("o_orderdate")
    return o.select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.col("o_orderkey").alias("SK_ID_BUREAU"),
        F.col("o_orderstatus").alias("CREDIT_ACTIVE"),
        F.when(_m("o_orderkey", 10) == 0, "currency 2").otherwise("currency 1").alias("CREDIT_CURRENCY"),
        days.cast("int").alias("DAYS_CREDIT"),
        _m("o_orderkey", 90).cast("int").alias("CREDIT_DAY_OVERDUE"),
        _dbl(days + _m("o_orderkey", 1800)).alias("DAYS_CREDIT_ENDDATE"),
        F.when(F.col("o_orderstatus") != "O", _dbl(days + _m("o_orderkey", 700))).alias("DAYS_ENDDATE_FACT"),
        F.when(_m("o_orderkey", 4) != 0, _dbl(_m("o_orderkey", 500))).alias("AMT_CREDIT_MAX_OVERDUE"),
        _m("o_orderkey", 3).cast("int").alias("CNT_CREDIT_PROLONG"),
        F.col("o_totalprice").alias("AMT_CREDIT_SUM"),
        (F.col("o_totalprice") * F.lit(0.5)).alias("AMT_CREDIT_SUM_DEBT"),
        _dbl(_m("o_orderkey", 1000)).alias("AMT_CREDIT_SUM_LIMIT"),
        _dbl(_m("o_orderkey", 3)).alias("AMT_CREDIT_SUM_OVERDUE"),
        F.col("o_orderpriority").alias("CREDIT_TYPE"),
        (days + _m("o_orderkey", 60)).cast("int").alias("DAYS_CREDIT_UPDATE"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") / F.lit(12.0)).alias("AMT_ANNUITY"),
    )


def bureau_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("SK_ID_BUREAU"),
        (-F.col("l_linenumber")).cast("int").alias("MONTHS_BALANCE"),
        F.col("l_returnflag").alias("STATUS"),
    )


def previous_application(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    days = _days("o_orderdate")
    key = F.col("o_orderkey")

    def due(mod: int, offset: int) -> Column:
        return _dbl(F.when(key % mod == 0, F.lit(365243)).otherwise(days + offset))

    return o.select(
        key.alias("SK_ID_PREV"),
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.col("o_orderpriority").alias("NAME_CONTRACT_TYPE"),
        (F.col("o_totalprice") / F.lit(24.0)).alias("AMT_ANNUITY"),
        F.when(key % 45 == 0, F.lit(0.0)).otherwise(F.col("o_totalprice")).alias("AMT_APPLICATION"),
        F.when(key % 9 == 0, F.lit(0.0)).otherwise(F.col("o_totalprice") * F.lit(0.9)).alias("AMT_CREDIT"),
        F.when(key % 4 != 0, _dbl(key % 2000)).alias("AMT_DOWN_PAYMENT"),
        F.col("o_totalprice").alias("AMT_GOODS_PRICE"),
        (key % 24).cast("int").alias("HOUR_APPR_PROCESS_START"),
        (_dbl(key % 100) / F.lit(100.0)).alias("RATE_DOWN_PAYMENT"),
        F.when(F.col("o_orderstatus") == "F", "Approved")
         .when(F.col("o_orderstatus") == "P", "Refused")
         .otherwise("Canceled").alias("NAME_CONTRACT_STATUS"),
        days.cast("int").alias("DAYS_DECISION"),
        F.when(F.col("o_orderstatus") != "P", _dbl(key % 48)).alias("CNT_PAYMENT"),
        F.when(key % 5 == 1, "low_normal").when(key % 5 == 2, "middle")
         .when(key % 5 == 3, "high").when(key % 5 == 4, "XNA").alias("NAME_YIELD_GROUP"),
        due(6, 30).alias("DAYS_FIRST_DUE"),
        due(8, 400).alias("DAYS_LAST_DUE"),
        due(10, 420).alias("DAYS_TERMINATION"),
    )


def pos_cash_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("SK_ID_PREV"),
        F.col("user_id").alias("SK_ID_CURR"),
        (-(F.col("event_id") % 24)).cast("int").alias("MONTHS_BALANCE"),
        F.col("value").alias("CNT_INSTALMENT"),
        F.when(F.col("event_type") != "error", _dbl(F.floor(F.col("value")))).alias("CNT_INSTALMENT_FUTURE"),
        F.col("event_type").alias("NAME_CONTRACT_STATUS"),
        (F.col("event_id") % 30).cast("int").alias("SK_DPD"),
        (F.col("event_id") % 7).cast("int").alias("SK_DPD_DEF"),
    )


def _lines_with_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner")


def installments_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _lines_with_client(spark, sf_dir)
    return j.select(
        F.col("l_orderkey").alias("SK_ID_PREV"),
        F.col("o_custkey").alias("SK_ID_CURR"),
        _dbl(F.col("l_linenumber") % 3).alias("NUM_INSTALMENT_VERSION"),
        F.col("l_linenumber").alias("NUM_INSTALMENT_NUMBER"),
        _dbl(_days("o_orderdate")).alias("DAYS_INSTALMENT"),
        F.when(F.col("l_discount") != 0, _dbl(_days("l_shipdate"))).alias("DAYS_ENTRY_PAYMENT"),
        (F.col("l_extendedprice") * F.col("l_tax") + F.lit(0.0)).alias("AMT_INSTALMENT"),
        (F.col("l_extendedprice") * F.col("l_discount") + F.lit(0.0)).alias("AMT_PAYMENT"),
    )


def credit_card_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _lines_with_client(spark, sf_dir)
    return j.select(
        F.col("l_orderkey").alias("SK_ID_PREV"),
        F.col("o_custkey").alias("SK_ID_CURR"),
        (-F.col("l_linenumber")).cast("int").alias("MONTHS_BALANCE"),
        F.col("l_extendedprice").alias("AMT_BALANCE"),
        F.col("l_quantity").alias("AMT_DRAWINGS_CURRENT"),
        F.col("l_quantity").cast("int").alias("CNT_DRAWINGS_CURRENT"),
        (F.nullif(F.col("l_discount"), F.lit(0.0)) + F.lit(0.0)).alias("AMT_PAYMENT_CURRENT"),
        (F.nullif(F.col("l_tax"), F.lit(0.0)) + F.lit(0.0)).alias("AMT_INST_MIN_REGULARITY"),
        (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("AMT_RECIVABLE"),
        (F.col("l_linenumber") % 3).cast("int").alias("SK_DPD"),
        F.col("l_linestatus").alias("NAME_CONTRACT_STATUS"),
    )


def scored_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored-row fixture for the evaluation operators.

    ``score`` is a deterministic function of the key and the label, with ties;
    ``fold`` is a fixed assignment so the SQL oracle can reproduce it.
    """
    c = read(spark, sf_dir, "customer")
    label = (F.col("c_acctbal") < 0).cast("int")
    return c.select(
        F.col("c_custkey").alias("id"),
        (F.col("c_custkey") % 3).cast("int").alias("fold"),
        label.alias("label"),
        (_dbl((F.col("c_custkey") * 7919) % 700 + label * 300) / F.lit(1000.0)).alias("score"),
    )


def scored_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows for three deterministic 'models' (for comparison and run-log queries)."""
    c = read(spark, sf_dir, "customer")
    label = (F.col("c_acctbal") < 0).cast("int")
    base = c.select(F.col("c_custkey").alias("id"), (F.col("c_custkey") % 3).cast("int").alias("fold"),
                    label.alias("label"))
    spec = [("alpha", 7919, 700, 300), ("beta", 104729, 900, 150), ("gamma", 15485863, 1000, 0)]
    parts = [
        base.select(F.lit(name).alias("model"), "id", "fold", "label",
                    (_dbl((F.col("id") * mult) % mod + F.col("label") * lift) / F.lit(1000.0)).alias("score"))
        for name, mult, mod, lift in spec
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
