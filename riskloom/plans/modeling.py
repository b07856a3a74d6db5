"""Modelling table: application base + five rollups -> split -> drop/rename.

``final_dataset`` is one lazy plan. ``prepare_modeling`` runs two small
actions (the drop decision, learned on train only) and applies the same
projection to train and test.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.names import rename_columns
from riskloom.functions.nulls import bools_to_int_all, replace_inf_all
from riskloom.operators import profile
from riskloom.plans import features as fx
from riskloom.sources import testbed as tb

ID, TARGET = "SK_ID_CURR", "TARGET"


def _builders(spark: SparkSession, sf: str):
    return [
        lambda: fx.bureau_features(tb.bureau(spark, sf), tb.bureau_balance(spark, sf)),
        lambda: fx.previous_features(tb.previous_application(spark, sf)),
        lambda: fx.pos_features(tb.pos_cash_balance(spark, sf)),
        lambda: fx.installments_features(tb.installments_payments(spark, sf)),
        lambda: fx.credit_card_features(tb.credit_card_balance(spark, sf)),
    ]


def feature_tables(spark: SparkSession, sf: str) -> list[DataFrame]:
    """The five per-client rollups, in the reference's join order.

    Building a rollup runs its small vocabulary job; the five builders are
    independent, so driver threads submit them concurrently.
    """
    with ThreadPoolExecutor(max_workers=5) as pool:
        return list(pool.map(lambda b: b(), _builders(spark, sf)))


def final_dataset(spark: SparkSession, sf: str) -> DataFrame:
    with ThreadPoolExecutor(max_workers=1) as pool:
        base_future = pool.submit(fx.application_base, tb.application_train(spark, sf),
                                  tb.application_test(spark, sf))
        feats = feature_tables(spark, sf)
        base, _ = base_future.result()
    return fx.star_join(base, feats)


TESTBED_INPUTS = ("customer", "orders", "lineitem", "events")


def processed(spark: SparkSession, sf: str) -> DataFrame:
    """The final dataset as a Parquet stage (written once per set of input
    files, then scanned): what the analysis and preparation steps read, as the
    reference's processed-file hand-off."""
    from riskloom.session import input_fingerprint, stage_table

    fp = input_fingerprint(spark, [f"{sf.rstrip('/')}/{t}.parquet" for t in TESTBED_INPUTS])
    return stage_table(spark, "final_dataset", fp, lambda: final_dataset(spark, sf))


def prepare_modeling(train: DataFrame, test: DataFrame, threshold: float = 0.80
                     ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """inf -> NULL, bool -> int, drop (high-missing or constant, learned on
    train), light rename. Returns (train, test, drop report)."""
    if TARGET not in train.columns or ID not in train.columns or ID not in test.columns:
        raise ValueError("train needs TARGET and SK_ID_CURR, test needs SK_ID_CURR")
    train = bools_to_int_all(replace_inf_all(train))
    test = bools_to_int_all(replace_inf_all(test))
    report = profile.drop_decision(train, threshold=threshold, protected=(TARGET, ID))
    drop = [r["column"] for r in report.collect()]
    train = rename_columns(train.drop(*drop), "light")
    test = rename_columns(test.drop(*drop), "light")
    if TARGET not in train.columns:
        raise ValueError("TARGET was dropped by mistake")
    if TARGET in test.columns:
        test = test.drop(TARGET)
    return train, test, report


def modeling_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    train, test = fx.split_train_test(processed(spark, sf))
    return prepare_modeling(train, test)


def features_and_label(df: DataFrame, target: str = TARGET, id_col: str = ID
                       ) -> tuple[list[str], DataFrame]:
    """Feature names = every column except target and id; label cast to int."""
    feats = [c for c in df.columns if c not in (target, id_col)]
    return feats, df.select(F.col(id_col), *[F.col(f"`{c}`") for c in feats],
                            F.col(target).cast("int").alias(target))
