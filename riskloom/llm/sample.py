"""Bounded, reproducible samples of labelled rows for model fitting."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Distinct labels a classifier may have.
MAX_LABELS = 1000


def per_label(df: DataFrame, key: str, label: str, n: int, seed: int) -> DataFrame:
    """At most ``n`` rows of each label, chosen by a hash of ``key``; rows without
    a label are left out.

    A hash threshold sized by the label's count thins each label in the scan, so
    the window that then takes exactly ``n`` ranks some 1.5 n rows per label.
    """
    df = df.filter(F.col(label).isNotNull())
    counts = {r[0]: r[1] for r in df.groupBy(label).count().limit(MAX_LABELS + 1).collect()}
    if len(counts) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels")
    if not counts:
        return df.limit(0)
    u = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 40)) / float(1 << 40)
    keep = F.lit(False)
    for value, count in sorted(counts.items(), key=lambda kv: str(kv[0])):
        keep = keep | ((F.col(label) == F.lit(value)) & (u < min(1.0, (1.5 * n + 50) / count)))
    w = Window.partitionBy(label).orderBy(F.xxhash64(F.lit(seed), F.col(key)), F.col(key))
    return df.filter(keep).withColumn("__rank", F.row_number().over(w)).filter(F.col("__rank") <= n).drop("__rank")
