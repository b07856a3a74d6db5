"""Rules N1-N20 on hand-made frames (the driver tables hold no NULLs)."""

import math

from pyspark.sql import functions as F

from riskloom.functions.nulls import (clamp_positive, ieee_ratio, inf_to_null, not_equal_keep_null,
                                      sentinel_to_null)
from riskloom.operators.aggspec import AggSpec, multi_agg


def test_ieee_ratio(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-2.0, 0.0), (0.0, 0.0), (3.0, 2.0), (None, 1.0), (1.0, None)],
                               "a double, b double")
    got = [r[0] for r in df.select(ieee_ratio("a", "b")).collect()]
    assert got[0] == math.inf and got[1] == -math.inf
    assert got[2] is None and got[3] == 1.5 and got[4] is None and got[5] is None


def test_integer_ratio_by_zero(spark):
    df = spark.createDataFrame([(5, 0), (0, 0)], "a int, b int")
    got = [r[0] for r in df.select(ieee_ratio("a", "b")).collect()]
    assert got == [math.inf, None]


def test_group_rules(spark):
    rows = [(1, None), (1, None), (2, 5.0), (3, 1.0), (3, float("inf")), (4, 2.0), (4, 4.0)]
    df = spark.createDataFrame(rows, "k int, x double")
    spec = AggSpec(key="k", prefix="P", numeric={"x": ["sum", "var", "size", "nunique", "max", "mean"]})
    out = {r["k"]: r for r in multi_agg(df, spec).collect()}
    assert out[1]["P_X_SUM"] == 0.0            # N4: sum of nothing is 0
    assert out[1]["P_X_SIZE"] == 2             # N6: size counts missing rows
    assert out[1]["P_X_NUNIQUE"] == 0          # N7: missing not counted
    assert out[2]["P_X_VAR"] is None           # N5: one row -> missing
    assert out[3]["P_X_MAX"] == math.inf and out[3]["P_X_MEAN"] == math.inf   # N3
    assert math.isnan(out[3]["P_X_VAR"])
    assert out[4]["P_X_VAR"] == 2.0


def test_nunique_with_missing(spark):
    df = spark.createDataFrame([(1, None), (1, 2.0), (1, 2.0)], "k int, x double")
    out = multi_agg(df, AggSpec(key="k", prefix="P", numeric={"x": ["nunique_na"]})).collect()[0]
    assert out["P_X_NUNIQUE_NA"] == 2


def test_not_equal_keeps_missing(spark):
    df = spark.createDataFrame([("M",), ("XNA",), (None,)], "g string")
    assert sorted(df.filter(not_equal_keep_null("g", "XNA")).collect(), key=str) == sorted(
        [("M",), (None,)], key=str)
    assert df.filter(F.col("g") != "XNA").count() == 1    # plain != loses the missing row


def test_clamp_and_sentinel(spark):
    df = spark.createDataFrame([(3.0, 365243), (-2.0, 5), (None, None)], "d double, s int")
    got = df.select(clamp_positive("d").alias("c"), sentinel_to_null("s").alias("s")).collect()
    assert [r["c"] for r in got] == [3.0, 0.0, 0.0]        # N9: missing -> 0
    assert [r["s"] for r in got] == [None, 5, None]


def test_inf_to_null(spark):
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (float("nan"),), (1.5,)], "x double")
    assert [r[0] for r in df.select(inf_to_null("x")).collect()] == [None, None, None, 1.5]


def test_group_key_missing_dropped(spark):
    df = spark.createDataFrame([(None, 1.0), (1, 2.0)], "k int, x double")
    out = multi_agg(df, AggSpec(key="k", prefix="P", numeric={"x": ["sum"]})).collect()
    assert [r["k"] for r in out] == [1]                    # N20
