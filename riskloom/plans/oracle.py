"""DuckDB SQL for the registered queries (the correctness oracle).

The test-table mapping of ``sources.testbed`` is re-stated here as SQL views
(CTEs), written independently of the Spark code. Wide rollups are emitted from
the same aggregation specs as SQL text; everything else is hand written.
Output rules shared with ``plans.catalog.finish``: doubles are rounded to 4
places (2 for variances and standard deviations), -0.0 becomes 0.0, and
inf/NaN become NULL. Rounding boundaries are shifted by ``TIE_SHIFT`` of a
step: means of 2-decimal amounts often sit exactly on a rounding midpoint, and
two engines that sum in different orders then round the same exact value in
opposite directions.
"""

from __future__ import annotations

DAYS = "date_diff('day', DATE '2002-01-01', CAST({c} AS DATE))"

CTE = {
    "app": f"""app AS (
  SELECT c_custkey AS SK_ID_CURR,
    CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(c_acctbal < 0 AS INTEGER) END AS TARGET,
    CASE WHEN c_custkey % 7 = 0 THEN 'test' ELSE 'train' END AS dataset_type,
    CASE WHEN c_nationkey = 24 THEN 'XNA' WHEN c_nationkey = 23 THEN NULL
         WHEN c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END AS CODE_GENDER,
    NULLIF(c_mktsegment, 'HOUSEHOLD') AS NAME_CONTRACT_TYPE,
    CASE WHEN c_custkey % 3 = 0 THEN 'Y' ELSE 'N' END AS FLAG_OWN_CAR,
    CAST(c_nationkey % 4 AS INTEGER) AS CNT_CHILDREN,
    CAST(-(7000 + (c_custkey * 37) % 18000) AS INTEGER) AS DAYS_BIRTH,
    CAST(CASE WHEN c_custkey % 11 = 0 THEN 365243 ELSE -((c_custkey * 13) % 9000) END AS INTEGER) AS DAYS_EMPLOYED,
    CAST((c_custkey * 7) % 40 AS DOUBLE) * 2500.0e0 AS AMT_INCOME_TOTAL,
    CAST(c_custkey % 13 AS DOUBLE) * 15000.0e0 AS AMT_CREDIT,
    CAST(NULLIF(c_custkey % 17, 0) AS DOUBLE) * 900.0e0 AS AMT_ANNUITY,
    CAST(c_custkey % 5 AS DOUBLE) AS CNT_FAM_MEMBERS
  FROM customer)""",
    "bur": f"""bur AS (
  SELECT o_custkey AS SK_ID_CURR, o_orderkey AS SK_ID_BUREAU,
    o_orderstatus AS CREDIT_ACTIVE,
    CASE WHEN o_orderkey % 10 = 0 THEN 'currency 2' ELSE 'currency 1' END AS CREDIT_CURRENCY,
    CAST({DAYS.format(c='o_orderdate')} AS INTEGER) AS DAYS_CREDIT,
    CAST(o_orderkey % 90 AS INTEGER) AS CREDIT_DAY_OVERDUE,
    CAST({DAYS.format(c='o_orderdate')} + o_orderkey % 1800 AS DOUBLE) AS DAYS_CREDIT_ENDDATE,
    CASE WHEN o_orderstatus <> 'O' THEN CAST({DAYS.format(c='o_orderdate')} + o_orderkey % 700 AS DOUBLE) END AS DAYS_ENDDATE_FACT,
    CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderkey % 500 AS DOUBLE) END AS AMT_CREDIT_MAX_OVERDUE,
    CAST(o_orderkey % 3 AS INTEGER) AS CNT_CREDIT_PROLONG,
    o_totalprice AS AMT_CREDIT_SUM,
    o_totalprice * 0.5e0 AS AMT_CREDIT_SUM_DEBT,
    CAST(o_orderkey % 1000 AS DOUBLE) AS AMT_CREDIT_SUM_LIMIT,
    CAST(o_orderkey % 3 AS DOUBLE) AS AMT_CREDIT_SUM_OVERDUE,
    o_orderpriority AS CREDIT_TYPE,
    CAST({DAYS.format(c='o_orderdate')} + o_orderkey % 60 AS INTEGER) AS DAYS_CREDIT_UPDATE,
    CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 12.0e0 END AS AMT_ANNUITY
  FROM orders)""",
    "bb": """bb AS (
  SELECT l_orderkey AS SK_ID_BUREAU, CAST(-l_linenumber AS INTEGER) AS MONTHS_BALANCE,
         l_returnflag AS STATUS
  FROM lineitem)""",
    "prev": f"""prev AS (
  SELECT o_orderkey AS SK_ID_PREV, o_custkey AS SK_ID_CURR,
    o_orderpriority AS NAME_CONTRACT_TYPE,
    o_totalprice / 24.0e0 AS AMT_ANNUITY,
    CASE WHEN o_orderkey % 45 = 0 THEN 0.0e0 ELSE o_totalprice END AS AMT_APPLICATION,
    CASE WHEN o_orderkey % 9 = 0 THEN 0.0e0 ELSE o_totalprice * 0.9e0 END AS AMT_CREDIT,
    CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderkey % 2000 AS DOUBLE) END AS AMT_DOWN_PAYMENT,
    o_totalprice AS AMT_GOODS_PRICE,
    CAST(o_orderkey % 24 AS INTEGER) AS HOUR_APPR_PROCESS_START,
    CAST(o_orderkey % 100 AS DOUBLE) / 100.0e0 AS RATE_DOWN_PAYMENT,
    CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'P' THEN 'Refused' ELSE 'Canceled' END AS NAME_CONTRACT_STATUS,
    CAST({DAYS.format(c='o_orderdate')} AS INTEGER) AS DAYS_DECISION,
    CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey % 48 AS DOUBLE) END AS CNT_PAYMENT,
    CASE o_orderkey % 5 WHEN 1 THEN 'low_normal' WHEN 2 THEN 'middle' WHEN 3 THEN 'high'
         WHEN 4 THEN 'XNA' END AS NAME_YIELD_GROUP,
    CAST(CASE WHEN o_orderkey % 6 = 0 THEN 365243 ELSE {DAYS.format(c='o_orderdate')} + 30 END AS DOUBLE) AS DAYS_FIRST_DUE,
    CAST(CASE WHEN o_orderkey % 8 = 0 THEN 365243 ELSE {DAYS.format(c='o_orderdate')} + 400 END AS DOUBLE) AS DAYS_LAST_DUE,
    CAST(CASE WHEN o_orderkey % 10 = 0 THEN 365243 ELSE {DAYS.format(c='o_orderdate')} + 420 END AS DOUBLE) AS DAYS_TERMINATION
  FROM orders)""",
    "pos": """pos AS (
  SELECT event_id AS SK_ID_PREV, user_id AS SK_ID_CURR,
    CAST(-(event_id % 24) AS INTEGER) AS MONTHS_BALANCE,
    value AS CNT_INSTALMENT,
    CASE WHEN event_type <> 'error' THEN CAST(floor(value) AS DOUBLE) END AS CNT_INSTALMENT_FUTURE,
    event_type AS NAME_CONTRACT_STATUS,
    CAST(event_id % 30 AS INTEGER) AS SK_DPD,
    CAST(event_id % 7 AS INTEGER) AS SK_DPD_DEF
  FROM events)""",
    "inst": f"""inst AS (
  SELECT l_orderkey AS SK_ID_PREV, o_custkey AS SK_ID_CURR,
    CAST(l_linenumber % 3 AS DOUBLE) AS NUM_INSTALMENT_VERSION,
    l_linenumber AS NUM_INSTALMENT_NUMBER,
    CAST({DAYS.format(c='o_orderdate')} AS DOUBLE) AS DAYS_INSTALMENT,
    CASE WHEN l_discount <> 0 THEN CAST({DAYS.format(c='l_shipdate')} AS DOUBLE) END AS DAYS_ENTRY_PAYMENT,
    l_extendedprice * l_tax + 0.0e0 AS AMT_INSTALMENT,
    l_extendedprice * l_discount + 0.0e0 AS AMT_PAYMENT
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "cc": """cc AS (
  SELECT l_orderkey AS SK_ID_PREV, o_custkey AS SK_ID_CURR,
    CAST(-l_linenumber AS INTEGER) AS MONTHS_BALANCE,
    l_extendedprice AS AMT_BALANCE,
    l_quantity AS AMT_DRAWINGS_CURRENT,
    CAST(l_quantity AS INTEGER) AS CNT_DRAWINGS_CURRENT,
    NULLIF(l_discount, 0.0e0) + 0.0e0 AS AMT_PAYMENT_CURRENT,
    NULLIF(l_tax, 0.0e0) + 0.0e0 AS AMT_INST_MIN_REGULARITY,
    l_extendedprice * (1.0e0 - l_discount) AS AMT_RECIVABLE,
    CAST(l_linenumber % 3 AS INTEGER) AS SK_DPD,
    l_linestatus AS NAME_CONTRACT_STATUS
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "scored": """scored AS (
  SELECT c_custkey AS id, CAST(c_custkey % 3 AS INTEGER) AS fold,
    CAST(c_acctbal < 0 AS INTEGER) AS label,
    CAST((c_custkey * 7919) % 700 + CAST(c_acctbal < 0 AS INTEGER) * 300 AS DOUBLE) / 1000.0e0 AS score
  FROM customer)""",
    "models": """models AS (
  SELECT m.model, c_custkey AS id, CAST(c_custkey % 3 AS INTEGER) AS fold,
    CAST(c_acctbal < 0 AS INTEGER) AS label,
    CAST((c_custkey * m.mult) % m.md + CAST(c_acctbal < 0 AS INTEGER) * m.lift AS DOUBLE) / 1000.0e0 AS score
  FROM customer CROSS JOIN (VALUES ('alpha', 7919, 700, 300), ('beta', 104729, 900, 150),
                                   ('gamma', 15485863, 1000, 0)) AS m(model, mult, md, lift))""",
}

# Column types of the derived tables (needed to type the emitted aggregates).
INT_COLUMNS = {
    "CNT_CHILDREN", "DAYS_BIRTH", "DAYS_EMPLOYED", "MONTHS_BALANCE", "DAYS_CREDIT",
    "CREDIT_DAY_OVERDUE", "CNT_CREDIT_PROLONG", "DAYS_CREDIT_UPDATE", "HOUR_APPR_PROCESS_START",
    "DAYS_DECISION", "SK_DPD", "SK_DPD_DEF", "NUM_INSTALMENT_NUMBER", "CNT_DRAWINGS_CURRENT",
    "TARGET",
}

# Vocabularies of the derived text columns on the driver's tables.
VOCAB = {
    "STATUS": ["A", "N", "R"],
    "CREDIT_ACTIVE": ["F", "O", "P"],
    "CREDIT_CURRENCY": ["currency 1", "currency 2"],
    "CREDIT_TYPE": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "NAME_CONTRACT_TYPE_PREV": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "NAME_CONTRACT_STATUS_PREV": ["Approved", "Canceled", "Refused"],
    "NAME_YIELD_GROUP": ["XNA", "high", "low_normal", "middle"],
    "NAME_CONTRACT_STATUS_POS": ["click", "error", "purchase", "signup", "view"],
    "NAME_CONTRACT_STATUS_CC": ["F", "O"],
    "CODE_GENDER": ["F", "M"],
    "NAME_CONTRACT_TYPE_APP": ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"],
    "FLAG_OWN_CAR": ["N", "Y"],
}


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


# Fixed value: fraction of a rounding step added before rounding outputs.
TIE_SHIFT = 0.0033


def tie_shift(digits: int) -> float:
    return TIE_SHIFT * 10.0 ** (-digits)


def rnd(expr: str, digits: int = 4) -> str:
    """Output rule for doubles (see module docstring)."""
    return (f"CASE WHEN isinf({expr}) OR isnan({expr}) THEN NULL "
            f"ELSE round({expr} + {tie_shift(digits)!r}, {digits}) + 0.0e0 END")


def digits_for(name: str) -> int:
    up = name.upper()
    return 2 if up.endswith("_VAR") or up.endswith("_STD") or up.startswith("VAR_") else 4


def with_ctes(*names: str) -> str:
    return "WITH " + ",\n".join(CTE[n] for n in names) + "\n"


def agg_sql(col: str, agg: str, pred: str | None = None) -> tuple[str, bool]:
    """(SQL aggregate, is_double) with the same missing-value rules as the Spark specs."""
    c = q(col) if pred is None else f"CASE WHEN {pred} THEN {q(col)} END"
    is_int = col in INT_COLUMNS
    if agg in ("min", "max"):
        return f"{agg}({c})", not is_int
    if agg == "mean":
        return f"avg({c})", True
    if agg == "sum":
        return (f"CAST(COALESCE(sum({c}), 0) AS BIGINT)", False) if is_int else (f"COALESCE(sum({c}), 0.0e0)", True)
    if agg == "var":
        return (f"CASE WHEN var_samp({c}) <= 1e-24 * avg({c}) * avg({c}) THEN 0.0e0 ELSE var_samp({c}) END"), True
    if agg == "std":
        return f"stddev_samp({c})", True
    if agg == "size":
        return ("count(*)" if pred is None else f"count(*) FILTER (WHERE {pred})"), False
    if agg == "nunique":
        return f"count(DISTINCT {c})", False
    raise ValueError(agg)


def rollup_sql(source: str, key: str, prefix: str, numeric: dict[str, list[str]],
               vocab: dict[str, list[str]] | None = None, extra_mean: list[str] = (),
               count_name: str | None = None,
               conditional: dict[str, tuple[str, dict[str, list[str]]]] | None = None,
               ) -> tuple[str, list[tuple[str, bool]]]:
    """SELECT list + GROUP BY for one rollup; returns (sql, [(out_name, is_double)])."""
    items: list[tuple[str, str, bool]] = []
    for col, aggs in numeric.items():
        for a in aggs:
            expr, dbl = agg_sql(col, a)
            items.append((f"{prefix}_{col}_{a}".upper(), expr, dbl))
    for col, values in (vocab or {}).items():
        for v in values:
            items.append((f"{prefix}_{col}_{v}_mean".upper(),
                          f"avg(CASE WHEN {q(col)} = '{v}' THEN 1.0e0 ELSE 0.0e0 END)", True))
        items.append((f"{prefix}_{col}_nan_mean".upper(),
                      f"avg(CASE WHEN {q(col)} IS NULL THEN 1.0e0 ELSE 0.0e0 END)", True))
    for col in extra_mean:
        items.append((f"{prefix}_{col}_mean".upper(), f"avg({q(col)})", True))
    for cprefix, (pred, spec) in (conditional or {}).items():
        for col, aggs in spec.items():
            for a in aggs:
                expr, dbl = agg_sql(col, a, pred)
                items.append((f"{cprefix}_{col}_{a}".upper(), expr, dbl))
        items.append((f"{cprefix}_APPLICATION_COUNT", f"NULLIF(count(*) FILTER (WHERE {pred}), 0)", False))
    if count_name:
        items.append((count_name, "count(*)", False))
    select = ",\n  ".join([q(key)] + [f"{e} AS {q(n)}" for n, e, _ in items])
    sql = f"SELECT\n  {select}\nFROM {source}\nWHERE {q(key)} IS NOT NULL\nGROUP BY {q(key)}"
    return sql, [(n, d) for n, _, d in items]


def finish_sql(inner: str, doubles: list[str]) -> str:
    """Wrap a query so its double columns follow the output rule."""
    if not doubles:
        return inner
    repl = ", ".join(f"{rnd(q(c), digits_for(c))} AS {q(c)}" for c in doubles)
    return f"SELECT * REPLACE ({repl}) FROM (\n{inner}\n) AS t_out"


def spark_round(expr: str, digits: int) -> str:
    """Spark's ``round`` on a double: half-up on the shortest decimal text."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38, 12)), {digits}) AS DOUBLE)"


# Schemas of the derived tables, as (name, is_numeric) in column order.
_APP_COLS = [("SK_ID_CURR", 1), ("TARGET", 1), ("CODE_GENDER", 0), ("NAME_CONTRACT_TYPE", 0),
             ("FLAG_OWN_CAR", 0), ("CNT_CHILDREN", 1), ("DAYS_BIRTH", 1), ("DAYS_EMPLOYED", 1),
             ("AMT_INCOME_TOTAL", 1), ("AMT_CREDIT", 1), ("AMT_ANNUITY", 1), ("CNT_FAM_MEMBERS", 1)]
DERIVED = {
    "application_train": ("app_train", _APP_COLS),
    "application_test": ("app_test", [c for c in _APP_COLS if c[0] != "TARGET"]),
    "bureau": ("bur", [("SK_ID_CURR", 1), ("SK_ID_BUREAU", 1), ("CREDIT_ACTIVE", 0), ("CREDIT_CURRENCY", 0),
                       ("DAYS_CREDIT", 1), ("CREDIT_DAY_OVERDUE", 1), ("DAYS_CREDIT_ENDDATE", 1),
                       ("DAYS_ENDDATE_FACT", 1), ("AMT_CREDIT_MAX_OVERDUE", 1), ("CNT_CREDIT_PROLONG", 1),
                       ("AMT_CREDIT_SUM", 1), ("AMT_CREDIT_SUM_DEBT", 1), ("AMT_CREDIT_SUM_LIMIT", 1),
                       ("AMT_CREDIT_SUM_OVERDUE", 1), ("CREDIT_TYPE", 0), ("DAYS_CREDIT_UPDATE", 1),
                       ("AMT_ANNUITY", 1)]),
    "bureau_balance": ("bb", [("SK_ID_BUREAU", 1), ("MONTHS_BALANCE", 1), ("STATUS", 0)]),
    "previous_application": ("prev", [
        ("SK_ID_PREV", 1), ("SK_ID_CURR", 1), ("NAME_CONTRACT_TYPE", 0), ("AMT_ANNUITY", 1),
        ("AMT_APPLICATION", 1), ("AMT_CREDIT", 1), ("AMT_DOWN_PAYMENT", 1), ("AMT_GOODS_PRICE", 1),
        ("HOUR_APPR_PROCESS_START", 1), ("RATE_DOWN_PAYMENT", 1), ("NAME_CONTRACT_STATUS", 0),
        ("DAYS_DECISION", 1), ("CNT_PAYMENT", 1), ("NAME_YIELD_GROUP", 0), ("DAYS_FIRST_DUE", 1),
        ("DAYS_LAST_DUE", 1), ("DAYS_TERMINATION", 1)]),
    "pos_cash_balance": ("pos", [("SK_ID_PREV", 1), ("SK_ID_CURR", 1), ("MONTHS_BALANCE", 1),
                                 ("CNT_INSTALMENT", 1), ("CNT_INSTALMENT_FUTURE", 1),
                                 ("NAME_CONTRACT_STATUS", 0), ("SK_DPD", 1), ("SK_DPD_DEF", 1)]),
    "installments_payments": ("inst", [("SK_ID_PREV", 1), ("SK_ID_CURR", 1), ("NUM_INSTALMENT_VERSION", 1),
                                       ("NUM_INSTALMENT_NUMBER", 1), ("DAYS_INSTALMENT", 1),
                                       ("DAYS_ENTRY_PAYMENT", 1), ("AMT_INSTALMENT", 1), ("AMT_PAYMENT", 1)]),
    "credit_card_balance": ("cc", [("SK_ID_PREV", 1), ("SK_ID_CURR", 1), ("MONTHS_BALANCE", 1),
                                   ("AMT_BALANCE", 1), ("AMT_DRAWINGS_CURRENT", 1), ("CNT_DRAWINGS_CURRENT", 1),
                                   ("AMT_PAYMENT_CURRENT", 1), ("AMT_INST_MIN_REGULARITY", 1),
                                   ("AMT_RECIVABLE", 1), ("SK_DPD", 1), ("NAME_CONTRACT_STATUS", 0)]),
}
CTE["app_train"] = "app_train AS (SELECT * EXCLUDE (dataset_type) FROM app WHERE dataset_type = 'train')"
CTE["app_test"] = "app_test AS (SELECT * EXCLUDE (dataset_type, TARGET) FROM app WHERE dataset_type = 'test')"
DERIVED_CTES = ("app", "app_train", "app_test", "bur", "bb", "prev", "pos", "inst", "cc")


def missing_cells_sql(cols: list[tuple[str, int]]) -> str:
    return "CAST(sum(" + " + ".join(f"CAST({q(c)} IS NULL AS BIGINT)" for c, _ in cols) + ") AS BIGINT)"
