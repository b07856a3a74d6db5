"""Named raw tables (key -> path, schema, options), stage scans and sinks.

Columns are found by the names of a file's header, whatever their order there. Schemas are declared, never inferred: a full inference pass over 100 TB of CSV
is a second scan, and inferred types drift with the data.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.session import path_exists

# Text markers that pandas reads as missing by default.
MISSING_MARKERS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

L, I, D, S = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


def _application_columns(with_target: bool) -> list[tuple[str, T.DataType]]:
    cols = [("SK_ID_CURR", L)]
    if with_target:
        cols.append(("TARGET", I))
    text = [
        "NAME_CONTRACT_TYPE", "CODE_GENDER", "FLAG_OWN_CAR", "FLAG_OWN_REALTY",
        "NAME_TYPE_SUITE", "NAME_INCOME_TYPE", "NAME_EDUCATION_TYPE",
        "NAME_FAMILY_STATUS", "NAME_HOUSING_TYPE", "OCCUPATION_TYPE",
        "WEEKDAY_APPR_PROCESS_START", "ORGANIZATION_TYPE", "FONDKAPREMONT_MODE",
        "HOUSETYPE_MODE", "WALLSMATERIAL_MODE", "EMERGENCYSTATE_MODE",
    ]
    ints = [
        "CNT_CHILDREN", "DAYS_BIRTH", "DAYS_EMPLOYED", "DAYS_ID_PUBLISH",
        "HOUR_APPR_PROCESS_START", "REGION_RATING_CLIENT", "REGION_RATING_CLIENT_W_CITY",
        "FLAG_MOBIL", "FLAG_EMP_PHONE", "FLAG_WORK_PHONE", "FLAG_CONT_MOBILE",
        "FLAG_PHONE", "FLAG_EMAIL", "REG_REGION_NOT_LIVE_REGION",
        "REG_REGION_NOT_WORK_REGION", "LIVE_REGION_NOT_WORK_REGION",
        "REG_CITY_NOT_LIVE_CITY", "REG_CITY_NOT_WORK_CITY", "LIVE_CITY_NOT_WORK_CITY",
    ] + [f"FLAG_DOCUMENT_{i}" for i in range(2, 22)]
    doubles = [
        "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE",
        "CNT_FAM_MEMBERS", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3",
        "DAYS_REGISTRATION", "DAYS_LAST_PHONE_CHANGE", "OWN_CAR_AGE",
        "REGION_POPULATION_RELATIVE", "TOTALAREA_MODE",
    ]
    doubles += [f"AMT_REQ_CREDIT_BUREAU_{p}" for p in ("HOUR", "DAY", "WEEK", "MON", "QRT", "YEAR")]
    doubles += [f"{a}_{d}_CNT_SOCIAL_CIRCLE" for a in ("OBS", "DEF") for d in ("30", "60")]
    building = [
        "APARTMENTS", "BASEMENTAREA", "YEARS_BEGINEXPLUATATION", "YEARS_BUILD",
        "COMMONAREA", "ELEVATORS", "ENTRANCES", "FLOORSMAX", "FLOORSMIN", "LANDAREA",
        "LIVINGAPARTMENTS", "LIVINGAREA", "NONLIVINGAPARTMENTS", "NONLIVINGAREA",
    ]
    doubles += [f"{b}_{s}" for s in ("AVG", "MODE", "MEDI") for b in building]
    cols += [(c, S) for c in text] + [(c, I) for c in ints] + [(c, D) for c in doubles]
    return cols


@dataclass(frozen=True)
class TableSpec:
    file_name: str
    schema: T.StructType
    options: dict[str, str] = field(default_factory=dict)


# Registry of the raw tables: logical key -> file, declared schema, reader options.
RAW_TABLES: dict[str, TableSpec] = {
    "application_train": TableSpec("application_train.csv", _schema(*_application_columns(True))),
    "application_test": TableSpec("application_test.csv", _schema(*_application_columns(False))),
    "bureau": TableSpec("bureau.csv", _schema(
        ("SK_ID_CURR", L), ("SK_ID_BUREAU", L), ("CREDIT_ACTIVE", S), ("CREDIT_CURRENCY", S),
        ("DAYS_CREDIT", I), ("CREDIT_DAY_OVERDUE", I), ("DAYS_CREDIT_ENDDATE", D),
        ("DAYS_ENDDATE_FACT", D), ("AMT_CREDIT_MAX_OVERDUE", D), ("CNT_CREDIT_PROLONG", I),
        ("AMT_CREDIT_SUM", D), ("AMT_CREDIT_SUM_DEBT", D), ("AMT_CREDIT_SUM_LIMIT", D),
        ("AMT_CREDIT_SUM_OVERDUE", D), ("CREDIT_TYPE", S), ("DAYS_CREDIT_UPDATE", I),
        ("AMT_ANNUITY", D))),
    "bureau_balance": TableSpec("bureau_balance.csv", _schema(
        ("SK_ID_BUREAU", L), ("MONTHS_BALANCE", I), ("STATUS", S))),
    "previous_application": TableSpec("previous_application.csv", _schema(
        ("SK_ID_PREV", L), ("SK_ID_CURR", L), ("NAME_CONTRACT_TYPE", S), ("AMT_ANNUITY", D),
        ("AMT_APPLICATION", D), ("AMT_CREDIT", D), ("AMT_DOWN_PAYMENT", D), ("AMT_GOODS_PRICE", D),
        ("WEEKDAY_APPR_PROCESS_START", S), ("HOUR_APPR_PROCESS_START", I),
        ("FLAG_LAST_APPL_PER_CONTRACT", S), ("NFLAG_LAST_APPL_IN_DAY", I),
        ("RATE_DOWN_PAYMENT", D), ("RATE_INTEREST_PRIMARY", D), ("RATE_INTEREST_PRIVILEGED", D),
        ("NAME_CASH_LOAN_PURPOSE", S), ("NAME_CONTRACT_STATUS", S), ("DAYS_DECISION", I),
        ("NAME_PAYMENT_TYPE", S), ("CODE_REJECT_REASON", S), ("NAME_TYPE_SUITE", S),
        ("NAME_CLIENT_TYPE", S), ("NAME_GOODS_CATEGORY", S), ("NAME_PORTFOLIO", S),
        ("NAME_PRODUCT_TYPE", S), ("CHANNEL_TYPE", S), ("SELLERPLACE_AREA", I),
        ("NAME_SELLER_INDUSTRY", S), ("CNT_PAYMENT", D), ("NAME_YIELD_GROUP", S),
        ("PRODUCT_COMBINATION", S), ("DAYS_FIRST_DRAWING", D), ("DAYS_FIRST_DUE", D),
        ("DAYS_LAST_DUE_1ST_VERSION", D), ("DAYS_LAST_DUE", D), ("DAYS_TERMINATION", D),
        ("NFLAG_INSURED_ON_APPROVAL", D))),
    "pos_cash_balance": TableSpec("POS_CASH_balance.csv", _schema(
        ("SK_ID_PREV", L), ("SK_ID_CURR", L), ("MONTHS_BALANCE", I), ("CNT_INSTALMENT", D),
        ("CNT_INSTALMENT_FUTURE", D), ("NAME_CONTRACT_STATUS", S), ("SK_DPD", I),
        ("SK_DPD_DEF", I))),
    "installments_payments": TableSpec("installments_payments.csv", _schema(
        ("SK_ID_PREV", L), ("SK_ID_CURR", L), ("NUM_INSTALMENT_VERSION", D),
        ("NUM_INSTALMENT_NUMBER", I), ("DAYS_INSTALMENT", D), ("DAYS_ENTRY_PAYMENT", D),
        ("AMT_INSTALMENT", D), ("AMT_PAYMENT", D))),
    "credit_card_balance": TableSpec("credit_card_balance.csv", _schema(
        ("SK_ID_PREV", L), ("SK_ID_CURR", L), ("MONTHS_BALANCE", I), ("AMT_BALANCE", D),
        ("AMT_CREDIT_LIMIT_ACTUAL", I), ("AMT_DRAWINGS_ATM_CURRENT", D),
        ("AMT_DRAWINGS_CURRENT", D), ("AMT_DRAWINGS_OTHER_CURRENT", D),
        ("AMT_DRAWINGS_POS_CURRENT", D), ("AMT_INST_MIN_REGULARITY", D),
        ("AMT_PAYMENT_CURRENT", D), ("AMT_PAYMENT_TOTAL_CURRENT", D),
        ("AMT_RECEIVABLE_PRINCIPAL", D), ("AMT_RECIVABLE", D), ("AMT_TOTAL_RECEIVABLE", D),
        ("CNT_DRAWINGS_ATM_CURRENT", D), ("CNT_DRAWINGS_CURRENT", I),
        ("CNT_DRAWINGS_OTHER_CURRENT", D), ("CNT_DRAWINGS_POS_CURRENT", D),
        ("CNT_INSTALMENT_MATURE_CUM", D), ("NAME_CONTRACT_STATUS", S), ("SK_DPD", I),
        ("SK_DPD_DEF", I))),
    "columns_description": TableSpec("HomeCredit_columns_description.csv", _schema(
        ("Unnamed: 0", I), ("Table", S), ("Row", S), ("Description", S), ("Special", S)),
        {"encoding": "ISO-8859-1"}),
    "sample_submission": TableSpec("sample_submission.csv", _schema(("SK_ID_CURR", L), ("TARGET", D))),
}


#: Of the encodings tried after UTF-8 the first one that reads every file.
FALLBACK_ENCODING = "ISO-8859-1"


def missing_to_null(c: Column) -> Column:
    """NULL for the usual missing-value markers, else the text."""
    return F.when(~F.array_contains(F.array(*[F.lit(m) for m in MISSING_MARKERS]), c), c)


def parse_as(c: Column, dtype: T.DataType) -> Column:
    """Text as ``dtype``; NULL where it can't be read. Whole numbers may be
    written as decimals ("2.0")."""
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, (T.IntegerType, T.LongType)):
        d = c.try_cast("double")
        whole = F.when((d == F.floor(d)) & (F.abs(d) < 2 ** 53), d)
        return F.coalesce(c.try_cast("bigint"), whole.cast("bigint")).try_cast(dtype.simpleString())
    return c.try_cast(dtype.simpleString())


def text_format(spark: SparkSession, path: str) -> dict[str, str]:
    """Reader options that a CSV file needs, from one scan of its lines without parsing.

    Text that is not valid UTF-8 is read as ``FALLBACK_ENCODING``, in which every byte is
    a character. Lines with an odd number of quotes mean that a quoted field holds a line
    break; only then are records read across lines, as such a file is read by one task.
    """
    quotes = F.octet_length("value") - F.octet_length(F.translate("value", '"', ""))
    bad, odd = spark.read.text(path).agg(F.max(~F.is_valid_utf8("value")), F.max(quotes % 2 == 1)).first()
    return {**({"encoding": FALLBACK_ENCODING} if bad else {}), **({"multiLine": "true"} if odd else {})}


def load_raw_table(
    spark: SparkSession, raw_dir: str, key: str, nrows: int | None = None, check: bool = True
) -> DataFrame:
    """Scan one registered CSV table by the names of its header.

    Every column is read as text under its header's name, missing markers (NaN
    among them) become NULL in all types, and each registered column is cast by
    name; the result has the registered columns in their order. Unknown keys raise
    with the list of valid ones, a missing file or column raises before any job
    runs. ``check`` counts the values that can't be cast, in one pass, and raises
    with the counts; without it they are NULL. ``nrows`` is a plain ``limit`` (no
    order promise). Quoted fields may hold commas, doubled quotes and line breaks;
    encoding and line breaks are found by ``text_format``.
    """
    if key not in RAW_TABLES:
        raise KeyError(f"unknown table {key!r}; valid keys: {sorted(RAW_TABLES)}")
    spec = RAW_TABLES[key]
    path = f"{raw_dir.rstrip('/')}/{spec.file_name}"
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    # quotes inside quotes are doubled, as other CSV readers and writers have it
    reader = spark.read.option("header", "true").option("inferSchema", "false").option("escape", '"')
    for k, v in {**text_format(spark, path), **spec.options}.items():
        reader = reader.option(k, v)
    raw = reader.csv(path)
    absent = [f.name for f in spec.schema.fields if f.name not in raw.columns]
    if absent:
        raise ValueError(f"{path}: no column {absent}; the header has {raw.columns}")
    text = raw.select(*[missing_to_null(F.col(f"`{f.name}`")).alias(f.name) for f in spec.schema.fields])
    if nrows is not None:
        text = text.limit(nrows)
    fields = [(f.name, parse_as(F.col(f"`{f.name}`"), f.dataType)) for f in spec.schema.fields]
    if check:
        bad = text.agg(*[F.count_if(F.col(f"`{n}`").isNotNull() & c.isNull()).alias(n) for n, c in fields]).first().asDict()
        bad = {n: k for n, k in bad.items() if k}
        if bad:
            raise ValueError(f"{path}: values that are not of the registered type: {bad}")
    return text.select(*[c.alias(n) for n, c in fields])


def load_all_raw_tables(
    spark: SparkSession, raw_dir: str, nrows: int | None = None
) -> dict[str, DataFrame]:
    return {k: load_raw_table(spark, raw_dir, k, nrows) for k in RAW_TABLES}


def load_stage(spark: SparkSession, path: str) -> DataFrame:
    """Scan a stage table written by ``write_stage``; fails early if absent."""
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    return spark.read.parquet(path)


def write_stage(
    df: DataFrame, path: str, bucket_key: str | None = None, n_buckets: int | None = None
) -> None:
    """Overwrite a Parquet stage table.

    Feature tables keyed by client are range-partitioned and sorted on the key
    inside files, so min/max statistics prune lookups by key and readers can
    merge-join without re-sorting.
    """
    if bucket_key is not None:
        # without a number, adaptive execution sizes the files by bytes
        ranged = df.repartitionByRange(n_buckets, bucket_key) if n_buckets else df.repartitionByRange(bucket_key)
        df = ranged.sortWithinPartitions(bucket_key)
    df.write.mode("overwrite").parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """Small report tables as one CSV file with header (report sizes are bounded)."""
    df.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def stage_inventory(tables: dict[str, DataFrame], key: str = "SK_ID_CURR",
                    target: str = "TARGET") -> DataFrame:
    """Per table: columns, rows, has key, has target, overall missing rate.

    One aggregate per table; the small per-table rows are unioned.
    """
    parts = []
    for name, df in tables.items():
        n_cols = len(df.columns)
        nulls = sum((F.col(f"`{c}`").isNull().cast("long") for c in df.columns), F.lit(0).cast("long"))
        parts.append(df.agg(
            F.lit(name).alias("table_name"),
            F.lit(n_cols).cast("int").alias("n_columns"),
            F.count(F.lit(1)).alias("n_rows"),
            F.lit(key in df.columns).alias("has_key"),
            F.lit(target in df.columns).alias("has_target"),
            F.try_divide(F.sum(nulls).cast("double"), F.count(F.lit(1)) * n_cols).alias("missing_rate"),
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
