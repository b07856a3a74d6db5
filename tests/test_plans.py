"""Physical-plan checks: shared exchanges, pushdown, no single-task windows."""

import re

from riskloom.operators import rank
from riskloom.plans import modeling
from riskloom.sources import testbed as tb

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_star_join_reuses_partitioning(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(modeling.final_dataset(spark, SF))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    client = len(re.findall(r"Exchange hashpartitioning\(SK_ID_CURR#\d+L, \d+\)", plan))
    # base + five rollups on the client key; the five left joins add none
    assert client == 6, client
    assert len(re.findall(r"SortMergeJoin \[SK_ID_CURR", plan)) == 5


def test_scan_pruning_and_pushdown(spark):
    df = tb.read(spark, SF, "customer").select("c_custkey").filter("c_custkey > 10")
    plan = _plan(df)
    assert "ReadSchema: struct<c_custkey:bigint>" in plan
    assert "GreaterThan(c_custkey,10)" in plan


def test_hash_rank_window_is_bucketed(spark, monkeypatch):
    monkeypatch.setattr(rank, "TARGET_ROWS_PER_BUCKET", 16)
    app = tb.application_train(spark, SF)
    plan = _plan(rank.hash_rank(app, "SK_ID_CURR", 42, ["TARGET"]))
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("__b" in w for w in windows)   # every window is keyed or ordered by bucket
