from riskloom.functions.names import clean_names, feature_name
from riskloom.operators import onehot


def test_feature_name_keeps_text():
    assert feature_name("bb", "STATUS_x y", "mean") == "BB_STATUS_X Y_MEAN"


def test_clean_names_modes():
    names = ["a b", "a/b", "a_b", "[x]<y>", "", "__"]
    assert clean_names(names, "light") == ["a_b", "a_b", "a_b", "_x__y_", "", "__"]
    assert clean_names(names, "strict") == ["a_b", "a_b", "a_b", "x_y", "", ""]
    ded = clean_names(names, "dedupe")
    assert ded == ["a_b", "a_b_2", "a_b_3", "x_y", "feature", "feature_2"]
    assert len(set(ded)) == len(ded)


def test_dedupe_suffix_collision():
    ded = clean_names(["a", "a", "a_2"], "dedupe")
    assert len(set(ded)) == 3


def test_vocabulary_and_transform(spark):
    train = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "id int, c string")
    test = spark.createDataFrame([(4, "z")], "id int, c string")
    vocab = onehot.fit_vocabulary(train.unionByName(test))     # fitted on the union (N12)
    assert vocab == {"c": ["a", "b", "z"]}
    enc = onehot.transform(train, vocab)
    assert enc.columns == ["id", "c_a", "c_b", "c_z", "c_nan"]  # N10: _nan always, after passthrough
    rows = {r["id"]: r for r in enc.collect()}
    assert (rows[3]["c_nan"], rows[3]["c_a"]) == (1, 0)


def test_vocabulary_guard(spark):
    import pytest

    df = spark.createDataFrame([(str(i),) for i in range(20)], "c string")
    with pytest.raises(ValueError):
        onehot.fit_vocabulary(df, max_values=10)


def test_wide_share_equals_narrow(spark):
    from riskloom.operators.aggspec import AggSpec, multi_agg

    rows = [(1, "a"), (1, "b"), (1, None), (2, "a"), (3, "c"), (3, "c")]
    df = spark.createDataFrame(rows, "k int, c string")
    vocab = onehot.fit_vocabulary(df)
    narrow = {r["k"]: r.asDict() for r in multi_agg(df, AggSpec(key="k", prefix="P", vocab=vocab)).collect()}
    wide = {r["k"]: r.asDict() for r in onehot.category_share_wide(df, "k", "c", vocab["c"], "P").collect()}
    assert narrow.keys() == wide.keys()
    for k in narrow:
        for name, v in narrow[k].items():
            assert abs(wide[k][name] - v) < 1e-12, (k, name)


def test_multi_agg_switches_to_wide(spark, monkeypatch):
    from riskloom.operators import aggspec
    from riskloom.operators.aggspec import AggSpec, multi_agg

    rows = [(1, "a", 1.0), (1, "b", 2.0), (1, None, 3.0), (2, "a", 4.0), (3, "c", 5.0)]
    df = spark.createDataFrame(rows, "k int, c string, x double")
    vocab = onehot.fit_vocabulary(df)
    spec = AggSpec(key="k", prefix="P", numeric={"x": ["sum"]}, vocab=vocab, count_name="P_COUNT")
    narrow = {r["k"]: r.asDict() for r in multi_agg(df, spec).collect()}
    monkeypatch.setattr(aggspec, "WIDE_VOCAB", 1)
    wide = {r["k"]: r.asDict() for r in multi_agg(df, spec).collect()}
    assert narrow == wide


def test_one_layout_for_any_number_of_values(spark):
    from riskloom.operators.aggspec import AggSpec, multi_agg

    for n in (64, 65):
        df = spark.createDataFrame([(i % 3, f"v{i:03d}", float(i)) for i in range(n)], "k int, c string, x double")
        vocab = onehot.fit_vocabulary(df)
        spec = AggSpec(key="k", prefix="P", numeric={"x": ["sum"]}, vocab=vocab, count_name="P_COUNT")
        cols = multi_agg(df, spec).columns
        assert cols[:2] == ["k", "P_X_SUM"] and cols[-1] == "P_COUNT" and len(cols) == n + 4
        assert cols[2:-1] == onehot.share_names(vocab, "P")


def test_no_value_limit(spark):
    df = spark.range(6000).selectExpr("concat('v', id) as c")
    assert len(onehot.fit_vocabulary(df)["c"]) == 6000
