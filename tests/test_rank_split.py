from pyspark.sql import Window
from pyspark.sql import functions as F

from riskloom.operators import rank, split


def _frame(spark, n=2000, parts=8):
    return spark.range(n).repartition(parts).select(
        F.col("id"), (F.col("id") % 13 == 0).cast("int").alias("y"), ((F.col("id") * 7) % 50).alias("v"))


def test_hash_rank_matches_row_number(spark, monkeypatch):
    monkeypatch.setattr(rank, "TARGET_ROWS_PER_BUCKET", 50)
    df = _frame(spark)
    got = rank.hash_rank(df, "id", 42, ["y"])
    ref = df.withColumn("rr", F.row_number().over(
        Window.partitionBy("y").orderBy(F.xxhash64("id", F.lit(42)), "id")))
    assert got.join(ref.select("id", "rr"), "id").filter("rank != rr").count() == 0


def test_partition_count_invariance(spark, monkeypatch):
    monkeypatch.setattr(rank, "TARGET_ROWS_PER_BUCKET", 64)
    a = rank.hash_rank(_frame(spark, parts=1), "id", 7, ["y"]).select("id", "rank")
    b = rank.hash_rank(_frame(spark, parts=8), "id", 7, ["y"]).select("id", "rank")
    assert a.exceptAll(b).count() == 0


def test_average_rank_ties(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (3.0,), (None,)], "v double")
    got = {r["v"]: r["avg_rank"] for r in rank.average_rank(df, "v", n_buckets=2).collect()}
    assert got == {1.0: 1.0, 2.0: 2.5, 3.0: 4.0}


def test_kfold_sizes(spark):
    df = split.stratified_kfold(_frame(spark, 1000), "y", "id", k=3)
    sizes = [r["count"] for r in df.groupBy("fold").count().collect()]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == 1000
    per = df.groupBy("y", "fold").count().collect()
    for y in (0, 1):
        s = [r["count"] for r in per if r["y"] == y]
        assert max(s) - min(s) <= 1


def test_stratified_split_exact(spark):
    df = _frame(spark, 1001)
    train, valid = split.stratified_split(df, "y", "id", 0.2)
    assert valid.count() == 201 and train.count() == 800
    assert train.join(valid, "id").count() == 0
    pos = valid.filter("y = 1").count()
    assert abs(pos - 0.2 * df.filter("y = 1").count()) < 1


def test_largest_remainder():
    assert split.largest_remainder({0: 7, 1: 3}, 5) == {0: 4, 1: 1} or \
        sum(split.largest_remainder({0: 7, 1: 3}, 5).values()) == 5
    assert sum(split.largest_remainder({0: 920, 1: 80}, 333).values()) == 333


def test_sample_returns_all_when_small(spark):
    df = _frame(spark, 100)
    assert split.stratified_sample(df, "y", "id", n=1000).count() == 100
    assert split.stratified_sample(df, "y", "id", n=40).count() == 40


def test_null_groups_and_many_buckets(spark):
    from riskloom.operators import evaluate as ev
    from riskloom.operators import rank

    rows = [(None if i % 3 == 0 else i % 3, i % 7, float(i % 11)) for i in range(300)]
    df = spark.createDataFrame([(g, i, l % 2, s) for i, (g, l, s) in enumerate(rows)], "g int, id long, label int, score double")
    assert rank.hash_rank(df, "id", 1, ["g"]).count() == 300
    one = {r["g"]: r["roc_auc"] for r in ev.roc_auc(df, group_cols=["g"]).collect()}
    assert set(one) == {None, 1, 2} and all(v is not None for v in one.values())
    a = {(r["g"], r["score"]): r["below_n"] for r in
         rank.cumulative_below(df, "score", {"n": rank.F.lit(1)}, ["g"], n_buckets=1).collect()}
    b = {(r["g"], r["score"]): r["below_n"] for r in
         rank.cumulative_below(df, "score", {"n": rank.F.lit(1)}, ["g"], n_buckets=5).collect()}
    assert a == b


def test_missing_scores_are_negative_everywhere(spark):
    from riskloom.operators import evaluate as ev

    df = spark.createDataFrame([(1, None), (0, float("nan")), (1, 0.9), (0, 0.2), (1, 0.7)], "label int, score double")
    c = ev.confusion_counts(df, 0.5).first()
    s = ev.threshold_sweep(df, [0.5], with_auc=False).first()
    assert (c["tn"], c["fp"], c["fn"], c["tp"]) == (s["tn"], s["fp"], s["fn"], s["tp"]) == (2, 0, 1, 2)


def test_missing_label_is_refused(spark):
    import pytest

    from riskloom.operators import split

    df = spark.createDataFrame([(1, 0), (2, 1), (3, None)], "id long, y int")
    with pytest.raises(ValueError, match="1 rows have no y"):
        split.stratified_split(df, "y", "id")


def test_sample_quotas(spark):
    from riskloom.operators import split

    df = spark.range(1000).selectExpr("id", "cast(id % 10 = 0 as int) as y")
    got = {r["y"]: r["count"] for r in split.stratified_sample(df, "y", "id", 100).groupBy("y").count().collect()}
    assert got == {0: 90, 1: 10}
