"""Registry of named queries: ``name -> (spark_query, oracle_sql | None)``.

Each query takes ``(spark, sf_dir)``, reads the driver's tables through
``sources.testbed`` and returns a lazy DataFrame. ``finish`` applies the
output rule shared with the SQL oracle (rounded doubles, no -0.0, inf/NaN as
NULL) so that two engines with different summation orders compare equal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.plans.oracle import digits_for, tie_shift

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, Callable[[], str]] = {}


def register(name: str, sql: str | Callable[[], str] | None = None):
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql if callable(sql) else (lambda s=sql: s)
        return fn
    return deco


def finish(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            d = digits_for(f.name)
            c = F.when(~(F.isnan(c) | (F.abs(c) == F.lit(float("inf")))),
                       F.round(c.cast("double") + F.lit(tie_shift(d)), d) + F.lit(0.0))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def load_all() -> None:
    """Import the query modules (each registers its queries)."""
    from riskloom.plans import (  # noqa: F401
        q_eval, q_features, q_ml, q_prep, q_profile, q_runs, q_scan, q_split, q_corr,
    )
