"""Missing-value, ratio and infinity rules as Spark column expressions.

All functions return ``Column`` objects, so they stay inside whole-stage
codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the "no date" marker used by the relative-day columns.
DAYS_SENTINEL = 365243

_NUMERIC = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType,
    T.FloatType, T.DoubleType, T.DecimalType,
)
_FLOATING = (T.FloatType, T.DoubleType)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ieee_ratio(a: Column | str, b: Column | str) -> Column:
    """``a / b`` with IEEE results under ANSI mode.

    x/0 is +inf or -inf by the sign of x, 0/0 is NULL (missing), and NULL on
    either side stays NULL. ``try_divide`` alone would turn x/0 into NULL,
    which changes later group max/mean values.
    """
    a, b = _col(a).cast("double"), _col(b).cast("double")
    return (
        F.when(b == 0, F.when(a > 0, F.lit(float("inf"))).when(a < 0, F.lit(float("-inf"))))
        .otherwise(F.try_divide(a, b))
    )


def clamp_positive(c: Column | str) -> Column:
    """``c if c > 0 else 0``: a missing value, NULL or NaN, also becomes 0."""
    c = _col(c)
    return F.when((c > 0) & ~F.isnan(c.cast("double")), c).otherwise(F.lit(0))


def sentinel_to_null(c: Column | str, sentinel: int = DAYS_SENTINEL) -> Column:
    """Replace the sentinel value by NULL."""
    return F.nullif(_col(c), F.lit(sentinel))


def not_equal_keep_null(c: Column | str, value) -> Column:
    """Filter predicate ``c != value`` that keeps rows where ``c`` is NULL."""
    return ~_col(c).eqNullSafe(F.lit(value))


def nan_to_null(c: Column | str) -> Column:
    """NaN becomes NULL; other values unchanged."""
    c = _col(c)
    return F.when(~F.isnan(c), c)


def inf_to_null(c: Column | str) -> Column:
    """+inf, -inf and NaN become NULL (the late clean-up step)."""
    c = _col(c)
    return F.when(~(F.isnan(c) | (F.abs(c) == F.lit(float("inf")))), c)


def bool_to_int(c: Column | str) -> Column:
    return _col(c).cast("tinyint")


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, _NUMERIC)


def is_floating(dtype: T.DataType) -> bool:
    return isinstance(dtype, _FLOATING)


def replace_inf_all(df: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Map ±inf/NaN to NULL in every floating column with one ``select``."""
    cols = []
    for f in df.schema.fields:
        if is_floating(f.dataType) and f.name not in exclude:
            cols.append(inf_to_null(F.col(f"`{f.name}`")).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def bools_to_int_all(df: DataFrame) -> DataFrame:
    """Cast every boolean column to tinyint with one ``select``."""
    return df.select(*[
        bool_to_int(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, T.BooleanType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])
