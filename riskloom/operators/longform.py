"""Wide table -> one row per row and column, for statistics of every column.

The columns go into one array that is exploded with its positions, so the plan has one
projection and one generator whatever the width (``unpivot`` plans one projection per
column), and the position, an int, is the key in shuffles; names come back at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PLACE = "__place"


def long_form(df: DataFrame, columns: list[str], keep: tuple[str, ...] = (), value: str = "value",
              kind: str = "double") -> DataFrame:
    """(keep..., ``PLACE``, value) with the columns cast to ``kind``; missing values are kept."""
    cells = F.array(*[F.col(f"`{c}`").cast(kind) for c in columns])
    return df.select(*[F.col(f"`{c}`") for c in keep], F.posexplode(cells).alias(PLACE, value))


def named(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with ``column``, the name at ``PLACE``, in front of the other columns."""
    names = F.array(*[F.lit(c) for c in columns])
    rest = [F.col(f"`{c}`") for c in df.columns if c != PLACE]
    return df.select(F.element_at(names, F.col(PLACE) + 1).alias("column"), *rest)
