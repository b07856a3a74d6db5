"""What keeps shuffles and plans small on large tables, and that results stay exact."""

import random
import statistics

from pyspark.sql import functions as F

from riskloom.operators import aggspec, corr, ml, profile, rank


def _wide(spark, rows=300, width=12):
    rng = random.Random(5)
    data = [(i, *[None if rng.random() < 0.2 else float(rng.randint(-20, 20)) for _ in range(width)]) for i in range(rows)]
    names = [f"c{k}" for k in range(width)]
    return spark.createDataFrame(data, "id long, " + ", ".join(f"{n} double" for n in names)), data, names


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_column_statistics_have_one_projection_whatever_the_width(spark):
    df, _, names = _wide(spark)
    assert "Expand" not in _plan(profile.column_stats(df, names))
    assert "Expand" not in _plan(corr.pearson_with_target(df, "c0", names[1:]))
    assert "Expand" not in _plan(ml.fit_scaler(df, names))


def test_median_ranks_only_the_middle(spark, monkeypatch):
    df, data, names = _wide(spark)

    def full(*_):
        raise AssertionError("all values were ranked")

    monkeypatch.setattr(ml, "cumulative_below", full)
    got = {r["column"]: r["median"] for r in ml.exact_median(df, names).collect()}
    assert got == {n: statistics.median(r[k + 1] for r in data if r[k + 1] is not None) for k, n in enumerate(names)}


def test_median_of_a_bracket_that_missed(spark, monkeypatch):
    df, data, names = _wide(spark)
    monkeypatch.setattr(ml, "MEDIAN_BRACKET", (0.9, 0.95))
    got = {r["column"]: r["median"] for r in ml.exact_median(df.withColumn("none", F.lit(None).cast("double")), [*names, "none"]).collect()}
    want = {n: statistics.median(r[k + 1] for r in data if r[k + 1] is not None) for k, n in enumerate(names)}
    assert got == {**want, "none": None}


def test_wide_rollups_move_rows_once(spark):
    df, data, names = _wide(spark)
    keyed = df.withColumn("k", F.col("id") % 7)
    spec = aggspec.AggSpec(key="k", prefix="P", numeric={n: ["min", "max", "mean", "sum"] for n in names}, count_name="N")
    out = aggspec.multi_agg(keyed, spec)
    plan = _plan(out)
    assert plan.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_COL" in plan
    row = {r["k"]: r for r in out.collect()}[3]
    mine = [r[1] for r in data if r[0] % 7 == 3 and r[1] is not None]
    assert (row["P_C0_MIN"], row["P_C0_MAX"], row["P_C0_SUM"]) == (min(mine), max(mine), sum(mine))


def test_split_tasks_sort_a_bounded_number_of_rows():
    assert 1_000_000 / 2 ** rank.bucket_bits(1_000_000) <= 100_000


def test_spearman_matrix_ranks_a_column_once_per_set_of_rows(spark):
    rng = random.Random(3)
    rows = []
    for i in range(200):
        a, b, c, d, e = (float(rng.randint(-9, 9)) for _ in range(5))
        if i % 3 == 0:
            a = b = None                                       # the same rows for both
        rows.append((i, a, b, c, None if i % 5 == 0 else d, e + (a or 0.0), 1.0))
    cols = ["a", "b", "c", "d", "e", "one"]
    df = spark.createDataFrame(rows, "id long, " + ", ".join(f"{x} double" for x in cols))
    present = corr._complete_rows(df, cols)
    # c, e and one: alone, with a or b, with d; a and b: alone, with d; d: alone, with a or b
    assert max(corr.rankings(present).values()) + 1 == 3 * 3 + 2 * 2 + 2
    got = {(r["col_a"], r["col_b"]): r["r"] for r in corr.spearman_matrix(df, cols, "id").collect()}
    assert len(got) == len(cols) ** 2
    for x in cols:
        for y in cols:
            if "one" in (x, y):
                assert got[x, y] is None
            else:
                assert abs(got[x, y] - _spearman(rows, cols.index(x) + 1, cols.index(y) + 1)) < 1e-9


def _spearman(rows, i, j):
    pairs = [(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None]

    def ranks(v):
        return [sum(o < x for o in v) + (v.count(x) + 1) / 2 for x in v]

    x, y = (ranks([p[k] for p in pairs]) for k in (0, 1))
    mx, my = statistics.mean(x), statistics.mean(y)
    cov = sum((a - mx) * (b - my) for a, b in zip(x, y))
    return cov / (sum((a - mx) ** 2 for a in x) * sum((b - my) ** 2 for b in y)) ** 0.5


def test_boosting_counts_rows_only_where_a_split_asks(spark):
    import numpy as np

    from riskloom.operators import boosting

    rng = np.random.default_rng(1)
    x = [rng.normal(size=400).round(1), np.where(rng.random(400) < 0.3, np.nan, rng.normal(size=400)), np.zeros(400)]
    y = (x[0] > 0.2).astype(float)
    p = dict(ml.depth_wise_spec(rounds=3, min_weight=5.0).params, weight_multiplier=1.0)
    seen = []
    real, boosting.best_split = boosting.best_split, lambda h, *a: seen.append(h.shape[:2]) or real(h, *a)
    try:
        fast = boosting.fit_arrays(x, y, p, 1)
        assert set(seen) <= {(2, 1), (2, 2)}                    # two sums, never the constant feature
        counted = boosting.fit_arrays(x, y, p | {"min_rows": 2}, 1)
        assert any(s[0] == 3 for s in seen)
    finally:
        boosting.best_split = real
    assert fast == counted


def test_duplicates_are_compared_in_full_only_where_hashes_repeat(spark):
    df, data, names = _wide(spark)

    def plan(d):
        out = profile.table_summary(d, "t")
        return out.collect()[0]["duplicates"], out._jdf.queryExecution().optimizedPlan().toString()

    none, unique = plan(df)
    some, twice = plan(df.unionByName(df.limit(3)))
    assert (none, some) == (0, 3)
    assert "LeftSemi" not in unique and "LeftSemi" in twice


def test_a_holdout_compares_rows_with_a_cut_and_moves_none(spark):
    from riskloom.operators import split

    df = spark.range(3000).selectExpr("id", "cast(id % 10 = 0 as int) as y", *[f"id * {k} as c{k}" for k in range(8)])
    df = df.unionByName(df.filter("id % 3 = 0"))               # every third id stands for two rows
    fit, valid = split.stratified_split(df, "y", "id", 0.2, seed=42)
    assert (fit.count(), valid.count(), valid.filter("y = 1").count()) == (3200, 800, 80)
    assert fit.unionByName(valid).exceptAll(df).count() == 0 and fit.columns == df.columns
    unique = df.filter("id % 3 > 0")
    plan = _plan(split.stratified_split(unique, "y", "id", 0.2, seed=42)[0])
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan
    ranked = rank.hash_rank(unique, "id", 42, ["y"])
    quota = {0: 360, 1: 40}
    want = {r["id"] for r in ranked.collect() if r["rank"] <= quota[r["y"]]}
    assert {r["id"] for r in split.stratified_split(unique, "y", "id", 0.2, seed=42)[1].collect()} == want


def test_a_cut_inside_equal_ids(spark):
    from riskloom.operators import split

    df = spark.createDataFrame([(None if i < 30 else 7, i % 2, i) for i in range(60)], "id long, y int, v int")
    kept = split.stratified_sample(df, "y", "id", 20)
    assert kept.count() == 20 and kept.filter("y = 1").count() == 10 and kept.select("v").distinct().count() == 20
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, split.stratified_sample(df.repartition(7), "y", "id", 20).collect()))


def test_a_fit_keeps_one_copy_of_its_rows(spark, monkeypatch):
    df, _, names = _wide(spark)
    df = df.withColumn("label", (F.col("id") % 2).cast("int"))
    kept = []
    frame = type(df)
    real = frame.persist
    monkeypatch.setattr(frame, "persist", lambda self, *a: kept.append(self.columns) or real(self, *a))
    ml.fit_model(df, names, ml.logistic_spec(5), "label")
    assert kept == [["label_d", "features", "weight"]]


def test_spearman_matrix_moves_blocks_not_cells(spark, monkeypatch):
    df, data, names = _wide(spark)
    assert "posexplode" not in _plan(corr.spearman_matrix(df, names, "id"))
    monkeypatch.setattr(corr, "BLOCK_ROWS", 40)
    monkeypatch.setattr(corr, "BUCKET_ROWS", 50)               # five buckets a column
    got = {(r["col_a"], r["col_b"]): r["r"] for r in corr.spearman_matrix(df, names, "id").collect()}
    for x, y in (("c0", "c1"), ("c3", "c11"), ("c7", "c7")):
        assert abs(got[x, y] - _spearman(data, names.index(x) + 1, names.index(y) + 1)) < 1e-9


def test_spearman_matrix_of_repeated_and_missing_ids(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(None if i < 4 else i // 2, *[None if rng.random() < 0.2 else float(rng.randint(-5, 5)) for _ in range(2)]) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, a double, b double")

    def ranks(c, o):
        v = [r[c] for r in rows if r[1] is not None and r[2] is not None]
        return {(k, x): sum(z < x for z in v) + (v.count(x) + 1) / 2 for k, x in enumerate(v)}

    both = [r for r in rows if r[1] is not None and r[2] is not None]
    ra, rb = ranks(1, 2), ranks(2, 1)
    best = {}
    for k, r in enumerate(both):
        a, b = best.get(r[0], (0, 0))
        best[r[0]] = (max(a, ra[k, r[1]]), max(b, rb[k, r[2]]))
    x, y = zip(*best.values())
    want = statistics.correlation(x, y)
    for size in (10_000, 30):
        monkeypatch.setattr(corr, "BLOCK_ROWS", size)
        got = {(r["col_a"], r["col_b"]): r["r"] for r in corr.spearman_matrix(df, ["a", "b"], "id").collect()}
        assert abs(got["a", "b"] - want) < 1e-9 and got["a", "b"] == got["b", "a"]
