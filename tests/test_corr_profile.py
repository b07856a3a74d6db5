import numpy as np
import pandas as pd

from riskloom.operators import corr, profile


def _frame(spark):
    rng = np.random.default_rng(5)
    n = 400
    x = rng.normal(size=n)
    pdf = pd.DataFrame({"y": (rng.random(n) < 0.3).astype(float), "a": x, "b": 2 * x + rng.normal(size=n) * 0.1,
                        "c": rng.normal(size=n), "k": np.ones(n)})
    pdf.loc[::7, "a"] = np.nan
    pdf.loc[::5, "c"] = np.nan
    pdf["y"] = pdf["y"] + pdf["a"].fillna(0) * 0.0
    return spark.createDataFrame(pdf), pdf


def test_pearson_with_target(spark):
    df, pdf = _frame(spark)
    got = {r["column"]: r["pearson"] for r in corr.pearson_with_target(df, "y").collect()}
    assert "k" not in got                                   # constant dropped (N14)
    for c in ("a", "b", "c"):
        assert abs(got[c] - pdf[c].corr(pdf["y"])) < 1e-10


def test_spearman_with_binary_target(spark):
    df, pdf = _frame(spark)
    got = {r["column"]: r["spearman"] for r in corr.spearman_with_binary_target(df, "y").collect()}
    for c in ("a", "b", "c"):
        pair = pdf[[c, "y"]].dropna().rank()              # average ranks, pairwise complete
        assert abs(got[c] - pair[c].corr(pair["y"])) < 1e-10


def test_gram_matrix_pairwise(spark):
    df, pdf = _frame(spark)
    cols = ["a", "b", "c", "k"]
    got = {(r["col_a"], r["col_b"]): r["r"] for r in corr.pearson_matrix(df.repartition(3), cols, False).collect()}
    ref = pdf[cols].corr()
    for a in cols:
        for b in cols:
            if a == "k" or b == "k":
                assert got[(a, b)] is None
            else:
                assert abs(got[(a, b)] - ref.loc[a, b]) < 1e-10


def test_constant_and_missing(spark):
    df = spark.createDataFrame([(1, None, 2.0, None), (2, None, 2.0, 3.0), (3, None, 2.0, 3.0)],
                               "id int, allnull double, konst double, konst_null double")
    assert profile.constant_columns(df, exclude=("id",)) == ["allnull", "konst"]   # constant + NULL is not
    rep = {r["column"]: r for r in profile.missing_report(df).collect()}
    assert rep["allnull"]["missing_count"] == 3 and abs(rep["konst_null"]["missing_rate"] - 1 / 3) < 1e-12


def test_table_summary_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "x int, s string")
    r = profile.table_summary(df, "t").collect()[0]
    assert (r["rows"], r["duplicates"], r["total_missing_values"]) == (3, 1, 1)


def test_key_and_relation_profile(spark):
    parent = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    child = spark.createDataFrame([(1,), (1,), (4,), (None,)], "k int")
    kp = profile.key_profile({"child": (child, ["k", "absent"])}).collect()
    row = [r for r in kp if r["key"] == "k"][0]
    assert (row["rows"], row["unique_keys"], row["missing_keys"], row["duplicated_key_rows"]) == (4, 2, 1, 1)
    assert [r for r in kp if r["key"] == "absent"][0]["key_exists"] is False
    rp = profile.relation_profile([("p", parent, "c", child, "k")]).collect()[0]
    assert (rp["common_keys"], rp["parent_only_keys"], rp["child_only_keys"]) == (1, 2, 1)


def test_spearman_matrix_pairwise(spark):
    df, pdf = _frame(spark)
    pdf = pdf.assign(id=range(len(pdf)))
    sdf = spark.createDataFrame(pdf)
    cols = ["a", "b", "c"]
    got = {(r["col_a"], r["col_b"]): r["r"] for r in corr.spearman_matrix(sdf, cols, "id").collect()}
    for a in cols:
        for b in cols:
            if a == b:
                assert abs(got[(a, b)] - 1.0) < 1e-12
                continue
            pair = pdf[[a, b]].dropna()
            ra, rb = pair[a].rank(), pair[b].rank()
            assert abs(got[(a, b)] - ra.corr(rb)) < 1e-10


def test_hash_sample_deterministic(spark):
    base = spark.range(1000).withColumnRenamed("id", "k")
    a = profile.hash_sample(base.repartition(1), 50, "k", seed=42)
    b = profile.hash_sample(base.repartition(6), 50, "k", seed=42)
    assert a.count() == 50 and sorted(r[0] for r in a.collect()) == sorted(r[0] for r in b.collect())
    assert profile.hash_sample(base, 5000, "k").count() == 1000      # all rows when fewer


def test_matrices_take_the_leading_columns(spark, monkeypatch):
    from riskloom.plans import catalog, q_corr

    rng = np.random.default_rng(8)
    y = (rng.random(200) < 0.4).astype(float)
    pdf = pd.DataFrame({"SK_ID_CURR": np.arange(200), "TARGET": y}
                       | {f"f{i:02d}": y * i + rng.normal(size=200) * 8 for i in range(32)})
    df = spark.createDataFrame(pdf)
    monkeypatch.setattr(q_corr, "prepared_train", lambda spark, sf: df)
    for name, method, k in (("corr_matrix_top25", "pearson", 25), ("corr_matrix_top30", "pearson", 30),
                            ("spearman_matrix_top25", "spearman", 25)):
        full = (pdf if method == "pearson" else pdf.rank()).drop(columns="SK_ID_CURR").corr()
        top = full["TARGET"].drop("TARGET").abs().sort_values(ascending=False).index[:k]
        want = full.loc[["TARGET", *top], ["TARGET", *top]]
        rows = catalog.QUERIES[name](spark, "").collect()
        assert {(r["col_a"], r["col_b"]) for r in rows} == {(a, b) for a in want for b in want}
        assert all(abs(r["r"] - want.loc[r["col_a"], r["col_b"]]) < 2e-4 for r in rows)
