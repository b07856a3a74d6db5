"""Feature plans: raw client history -> one row per client.

Each rollup is one hash aggregate keyed by client. The only driver round
trips are the vocabulary fits (distinct values of the text columns), whose
size is checked before collection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.nulls import clamp_positive, ieee_ratio, not_equal_keep_null, sentinel_to_null
from riskloom.operators import onehot
from riskloom.operators.aggspec import AggSpec, all_numeric_spec, gather, multi_agg

CLIENT = "SK_ID_CURR"

# Aggregation specs of the reference rollups (column -> aggregates).
BUREAU_BALANCE_NUMERIC = {"MONTHS_BALANCE": ["min", "max", "size"]}
BUREAU_NUMERIC = {
    "DAYS_CREDIT": ["min", "max", "mean", "var"],
    "DAYS_CREDIT_ENDDATE": ["min", "max", "mean"],
    "DAYS_CREDIT_UPDATE": ["mean"],
    "CREDIT_DAY_OVERDUE": ["max", "mean"],
    "AMT_CREDIT_MAX_OVERDUE": ["mean"],
    "AMT_CREDIT_SUM": ["max", "mean", "sum"],
    "AMT_CREDIT_SUM_DEBT": ["max", "mean", "sum"],
    "AMT_CREDIT_SUM_OVERDUE": ["mean"],
    "AMT_CREDIT_SUM_LIMIT": ["mean", "sum"],
    "AMT_ANNUITY": ["max", "mean"],
    "CNT_CREDIT_PROLONG": ["sum"],
}
PREVIOUS_NUMERIC = {
    "AMT_ANNUITY": ["min", "max", "mean"],
    "AMT_APPLICATION": ["min", "max", "mean"],
    "AMT_CREDIT": ["min", "max", "mean"],
    "APP_CREDIT_PERC": ["min", "max", "mean", "var"],
    "AMT_DOWN_PAYMENT": ["min", "max", "mean"],
    "AMT_GOODS_PRICE": ["min", "max", "mean"],
    "HOUR_APPR_PROCESS_START": ["min", "max", "mean"],
    "RATE_DOWN_PAYMENT": ["min", "max", "mean"],
    "DAYS_DECISION": ["min", "max", "mean"],
    "CNT_PAYMENT": ["mean", "sum"],
}
STATUS_NUMERIC = {
    "AMT_APPLICATION": ["mean", "max"],
    "AMT_CREDIT": ["mean", "max"],
    "APP_CREDIT_PERC": ["mean"],
    "DAYS_DECISION": ["mean"],
    "CNT_PAYMENT": ["mean"],
}
STATUS_PREFIXES = {"APPROVED": "Approved", "REFUSED": "Refused"}
POS_NUMERIC = {
    "MONTHS_BALANCE": ["max", "mean", "size"],
    "CNT_INSTALMENT": ["mean", "sum"],
    "CNT_INSTALMENT_FUTURE": ["mean", "sum"],
    "SK_DPD": ["max", "mean"],
    "SK_DPD_DEF": ["max", "mean"],
}
INSTALLMENTS_NUMERIC = {
    "NUM_INSTALMENT_VERSION": ["nunique"],
    "NUM_INSTALMENT_NUMBER": ["max", "mean"],
    "DPD": ["max", "mean", "sum"],
    "DBD": ["max", "mean", "sum"],
    "PAYMENT_PERC": ["max", "mean", "sum", "var"],
    "PAYMENT_DIFF": ["max", "mean", "sum", "var"],
    "AMT_INSTALMENT": ["max", "mean", "sum"],
    "AMT_PAYMENT": ["min", "max", "mean", "sum"],
    "DAYS_ENTRY_PAYMENT": ["max", "mean", "sum"],
    "DAYS_INSTALMENT": ["max", "mean", "sum"],
}
CARD_AGGS = ["min", "max", "mean", "sum", "var"]
APPLICATION_SENTINEL_COLUMNS = ["DAYS_EMPLOYED"]
PREVIOUS_SENTINEL_COLUMNS = [
    "DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION",
    "DAYS_LAST_DUE", "DAYS_TERMINATION",
]
# name -> (numerator, denominator)
APPLICATION_RATIOS = {
    "DAYS_EMPLOYED_PERC": ("DAYS_EMPLOYED", "DAYS_BIRTH"),
    "INCOME_CREDIT_PERC": ("AMT_INCOME_TOTAL", "AMT_CREDIT"),
    "INCOME_PER_PERSON": ("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"),
    "ANNUITY_INCOME_PERC": ("AMT_ANNUITY", "AMT_INCOME_TOTAL"),
    "PAYMENT_RATE": ("AMT_ANNUITY", "AMT_CREDIT"),
}
SPLIT_MARKER = "dataset_type"


def replace_sentinels(df: DataFrame, columns: list[str]) -> DataFrame:
    """365243 -> NULL on the listed columns that exist (one projection)."""
    present = [c for c in columns if c in df.columns]
    return df.select(*[sentinel_to_null(F.col(c)).alias(c) if c in present else F.col(f"`{c}`")
                       for c in df.columns])


def add_ratios(df: DataFrame, ratios: dict[str, tuple[str, str]]) -> DataFrame:
    """Append each ratio whose two inputs exist (presence guard at plan time)."""
    cols = set(df.columns)
    new = [ieee_ratio(a, b).alias(name) for name, (a, b) in ratios.items() if a in cols and b in cols]
    return df.select("*", *new)


# ---------------------------------------------------------------- application
def tag_union(train: DataFrame, test: DataFrame, marker: str = SPLIT_MARKER) -> DataFrame:
    """Tag train/test rows and union by name; test gets a NULL TARGET."""
    return (train.withColumn(marker, F.lit("train"))
            .unionByName(test.withColumn(marker, F.lit("test")), allowMissingColumns=True))


def clean_application(df: DataFrame) -> DataFrame:
    df = replace_sentinels(df, APPLICATION_SENTINEL_COLUMNS)
    if "CODE_GENDER" in df.columns:
        df = df.filter(not_equal_keep_null("CODE_GENDER", "XNA"))
    return df


def application_base(train: DataFrame, test: DataFrame,
                     vocab: onehot.Vocabulary | None = None) -> tuple[DataFrame, onehot.Vocabulary]:
    """union -> clean -> ratios -> one-hot (vocabulary fitted on the union,
    the split marker kept as text)."""
    df = add_ratios(clean_application(tag_union(train, test)), APPLICATION_RATIOS)
    if vocab is None:
        vocab = onehot.fit_vocabulary(df, exclude=(SPLIT_MARKER,))
    return onehot.transform(df, vocab), vocab


# --------------------------------------------------------------------- bureau
def bureau_balance_features(bureau_balance: DataFrame,
                            vocab: onehot.Vocabulary | None = None) -> DataFrame:
    """Level 2 -> 1: per credit, months min/max/size and status shares (BB_)."""
    vocab = onehot.fit_vocabulary(bureau_balance) if vocab is None else vocab
    spec = AggSpec(key="SK_ID_BUREAU", prefix="BB", numeric=BUREAU_BALANCE_NUMERIC, vocab=vocab)
    return multi_agg(bureau_balance, spec)


def bureau_features(bureau: DataFrame, bureau_balance: DataFrame) -> DataFrame:
    """Level 1 -> 0: left join the BB_ rollup, then one client aggregate (BURO_)."""
    bb = bureau_balance_features(bureau_balance)
    joined = bureau.join(bb, "SK_ID_BUREAU", "left").drop("SK_ID_BUREAU")
    vocab = onehot.fit_vocabulary(bureau)
    spec = AggSpec(key=CLIENT, prefix="BURO", numeric=BUREAU_NUMERIC, vocab=vocab,
                   extra_mean=[c for c in bb.columns if c.startswith("BB_")],
                   count_name="BURO_CREDIT_COUNT")
    return multi_agg(joined, spec)


# ------------------------------------------------------------------- previous
def clean_previous(df: DataFrame) -> DataFrame:
    df = replace_sentinels(df, PREVIOUS_SENTINEL_COLUMNS)
    return add_ratios(df, {"APP_CREDIT_PERC": ("AMT_APPLICATION", "AMT_CREDIT")})


def previous_features(previous: DataFrame, status_column: str = "NAME_CONTRACT_STATUS") -> DataFrame:
    """PREV_ rollup plus APPROVED_/REFUSED_ conditional rollups in one pass.

    Clients with no row of a status get NULL for that status (count included).
    """
    df = clean_previous(previous)
    vocab = onehot.fit_vocabulary(df)
    conditional = {}
    if status_column in df.columns:
        for prefix, value in STATUS_PREFIXES.items():
            if value in vocab.get(status_column, []):
                conditional[prefix] = (F.col(status_column) == F.lit(value), STATUS_NUMERIC)
    spec = AggSpec(key=CLIENT, prefix="PREV", numeric=PREVIOUS_NUMERIC, vocab=vocab,
                   count_name="PREV_APPLICATION_COUNT", conditional=conditional)
    return multi_agg(df, spec)


# ------------------------------------------------------------------------ pos
def pos_features(pos: DataFrame) -> DataFrame:
    vocab = onehot.fit_vocabulary(pos)
    spec = AggSpec(key=CLIENT, prefix="POS", numeric=POS_NUMERIC, vocab=vocab,
                   count_name="POS_CASH_COUNT")
    return multi_agg(pos, spec)


# --------------------------------------------------------------- installments
def clean_installments(df: DataFrame) -> DataFrame:
    cols = set(df.columns)
    new = []
    if {"AMT_PAYMENT", "AMT_INSTALMENT"} <= cols:
        new.append(ieee_ratio("AMT_PAYMENT", "AMT_INSTALMENT").alias("PAYMENT_PERC"))
        new.append((F.col("AMT_INSTALMENT") - F.col("AMT_PAYMENT")).alias("PAYMENT_DIFF"))
    if {"DAYS_ENTRY_PAYMENT", "DAYS_INSTALMENT"} <= cols:
        new.append(clamp_positive(F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT")).alias("DPD"))
        new.append(clamp_positive(F.col("DAYS_INSTALMENT") - F.col("DAYS_ENTRY_PAYMENT")).alias("DBD"))
    return df.select("*", *new)


def installments_features(installments: DataFrame) -> DataFrame:
    spec = AggSpec(key=CLIENT, prefix="INSTAL", numeric=INSTALLMENTS_NUMERIC, count_name="INSTAL_COUNT")
    return multi_agg(clean_installments(gather(installments, CLIENT)), spec, gathered=True)


# ---------------------------------------------------------------- credit card
def credit_card_features(card: DataFrame) -> DataFrame:
    """Every numeric column x {min,max,mean,sum,var} plus status shares (CC_)."""
    df = card.drop("SK_ID_PREV")
    vocab = onehot.fit_vocabulary(df)
    spec = AggSpec(key=CLIENT, prefix="CC", numeric=all_numeric_spec(df, CLIENT, "CC", CARD_AGGS),
                   vocab=vocab, count_name="CC_COUNT")
    return multi_agg(df, spec)


# ------------------------------------------------------------------ star join
def star_join(base: DataFrame, features: list[DataFrame], key: str = CLIENT) -> DataFrame:
    """Left-join each per-client feature table onto the base.

    Every side is an aggregate grouped by ``key``, so each arrives hash
    partitioned on the key and the joins reuse that partitioning (no extra
    exchange per join); the right sides are unique on the key by
    construction, so no fan-out.
    """
    if key not in base.columns:
        raise KeyError(f"key {key} missing from base table")
    out = base
    for f in features:
        if key not in f.columns:
            raise KeyError(f"key {key} missing from a feature table")
        out = out.join(f, key, "left")
    return out


def split_train_test(df: DataFrame, marker: str = SPLIT_MARKER,
                     target: str = "TARGET") -> tuple[DataFrame, DataFrame]:
    """Two filters over one plan; the test side loses TARGET and the marker."""
    if marker not in df.columns:
        raise KeyError(f"split marker {marker} missing")
    train = df.filter(F.col(marker) == "train").drop(marker)
    test = df.filter(F.col(marker) == "test").drop(marker, target)
    return train, test
