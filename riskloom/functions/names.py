"""Column-name rules: feature names and the three clean-up modes.

Renaming is metadata only: one ``toDF`` over the new names, no data pass.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters replaced by "_" in the light mode, in this order.
LIGHT_REPLACED = ["[", "]", "<", ">", " ", "/", ","]
_STRICT_BAD = re.compile(r"[^A-Za-z0-9_]+")
_UNDERSCORES = re.compile(r"_+")


def feature_name(prefix: str, column: str, agg: str) -> str:
    """``PREFIX_COLUMN_AGG`` upper-cased; category text (and spaces) kept."""
    return f"{prefix}_{column}_{agg}".upper()


def light_name(name: str) -> str:
    for ch in LIGHT_REPLACED:
        name = name.replace(ch, "_")
    return name


def strict_name(name: str) -> str:
    name = _STRICT_BAD.sub("_", str(name))
    return _UNDERSCORES.sub("_", name).strip("_")


def clean_names(names: list[str], mode: str = "light") -> list[str]:
    """Return cleaned names.

    ``light``: replace ``[ ] < > space / ,`` by ``_``.
    ``strict``: runs of non-alphanumerics become ``_``, squeezed and stripped.
    ``dedupe``: strict, then empty names become ``feature`` and repeats get
    ``_2``, ``_3``...; the loop continues until every name is unique, since a
    suffixed name can itself collide with a later column.
    """
    if mode == "light":
        return [light_name(n) for n in names]
    cleaned = [strict_name(n) for n in names]
    if mode == "strict":
        return cleaned
    if mode != "dedupe":
        raise ValueError(f"unknown mode {mode!r}")
    cleaned = [c or "feature" for c in cleaned]
    taken: set[str] = set()
    seen: dict[str, int] = {}
    out = []
    for c in cleaned:
        seen[c] = seen.get(c, 0) + 1
        candidate = c if seen[c] == 1 else f"{c}_{seen[c]}"
        k = seen[c]
        while candidate in taken:
            k += 1
            candidate = f"{c}_{k}"
        taken.add(candidate)
        out.append(candidate)
    return out


def clean_text(column: Column, mode: str = "light") -> Column:
    """The same rules for a column of names (``light`` and ``strict``)."""
    if mode == "light":
        return F.translate(column, "".join(LIGHT_REPLACED), "_" * len(LIGHT_REPLACED))
    if mode == "strict":
        return F.trim(F.regexp_replace(F.regexp_replace(column, _STRICT_BAD.pattern, "_"), _UNDERSCORES.pattern, "_"), F.lit("_"))
    raise ValueError(f"unknown mode {mode!r}")


def check_unique(names: list[str]) -> None:
    dupes = sorted({n for n in names if names.count(n) > 1})
    if dupes:
        raise ValueError(f"column names collide after cleaning: {dupes}")


def rename_columns(df: DataFrame, mode: str = "light") -> DataFrame:
    """Apply ``clean_names`` to a DataFrame; fail on collisions (light/strict)."""
    names = clean_names(df.columns, mode)
    check_unique(names)
    return df.toDF(*names)
