import datetime as dt

from pyspark.sql import functions as F

from riskloom.operators import runs as rl


def _runs(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [
        ("r1", "e", "a", None, "FINISHED", t, {"model": "m1"}, {"business_cost": 10.0}, {}),
        ("r2", "e", "b", None, "FINISHED", t + dt.timedelta(hours=1), {"model": "m1", "sweep_step": "0.05"},
         {"best_business_cost": 12.0}, {}),
        ("r3", "e", "c", None, "FAILED", t + dt.timedelta(hours=2), {"model": "m2"}, {}, {}),
        ("r4", "e", "d", None, "FINISHED", t, {"model": "m2"}, {"business_cost": 5.0}, {}),
    ]
    return spark.createDataFrame(rows, rl.RUNS_SCHEMA)


def test_champion_prefers_best_cost(spark):
    assert rl.champion_row(_runs(spark))["run_id"] == "r2"


def test_search_and_latest(spark):
    s = [r["run_id"] for r in rl.search_runs(_runs(spark), "e", "business_cost", ["business_cost"]).collect()]
    assert s == ["r4", "r1", "r2"]                       # missing cost last
    latest = {r["model"]: r["run_id"] for r in rl.latest_runs(_runs(spark)).collect()}
    assert latest == {"m1": "r2", "m2": "r3"}


def test_params_long(spark):
    got = rl.params_long(_runs(spark), "sweep_").collect()
    assert [(r["run_id"], r["param"], r["value"]) for r in got] == [("r2", "step", "0.05")]


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0 and "SK_ID_CURR" in df.columns
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_oracle_agreement_small(spark):
    """A few registered queries against their DuckDB SQL at sf0.001."""
    import duckdb

    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ["customer", "orders", "lineitem", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sqls = entry.queries(), entry.oracle_sql()
    for name in ["bureau_features", "installments_features", "threshold_sweep", "relation_profile"]:
        sdf = qs[name](spark, sf)
        a = sorted(map(lambda r: tuple(str(x) for x in r), sdf.select(sorted(sdf.columns)).collect()))
        rel = con.sql(sqls[name])
        cols = rel.columns
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        b = sorted(tuple(str(r[i]) for i in order) for r in rel.fetchall())
        assert a == b, name
