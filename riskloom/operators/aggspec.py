"""Declarative multi-aggregation: ``{column: [aggs]}`` -> one ``groupBy().agg()``.

Every spec is one hash aggregate with one shuffle: of partial sums, at most one row
per key and task, or, for wide specs, of the rows themselves. Conditional
aggregates (per-status features), category shares and the group row count are
folded into the same pass instead of extra passes and joins.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.names import feature_name

SUPPORTED = ("min", "max", "mean", "sum", "var", "std", "size", "nunique", "nunique_na")


def agg_expr(column: str, agg: str, when: Column | None = None) -> Column:
    """Aggregate with the reference's missing-value rules.

    sum over nothing is 0 (not NULL); var/std are sample statistics (one row
    gives NULL); size counts rows including missing values; nunique ignores
    missing values unless ``nunique_na``.
    """
    c = F.col(f"`{column}`")
    if when is not None:
        c = F.when(when, c)
    if agg == "min":
        return F.min(c)
    if agg == "max":
        return F.max(c)
    if agg == "mean":
        return F.avg(c)
    if agg == "sum":
        return F.coalesce(F.sum(c), F.lit(0))
    if agg == "var":
        # a spread below 1e-12 of the mean is the rounding of equal values
        v = F.var_samp(c)
        return F.when(v <= F.lit(1e-24) * F.avg(c) * F.avg(c), F.lit(0.0)).otherwise(v)
    if agg == "std":
        return F.stddev_samp(c)
    if agg == "size":
        return F.count(F.lit(1)) if when is None else F.count_if(when)
    if agg == "nunique":
        return F.count_distinct(c)
    if agg == "nunique_na":
        return F.count_distinct(c) + F.max(c.isNull().cast("int"))
    raise ValueError(f"unsupported aggregate {agg!r}; use one of {SUPPORTED}")


@dataclass
class AggSpec:
    """Aggregation plan for one rollup.

    ``numeric``: ordered ``{column: [aggs]}``; columns absent from the input
    are skipped (presence guard). ``vocab``: category shares. ``count_name``:
    name of the group row count, folded into the same aggregate.
    ``conditional``: ``{prefix: (predicate, {column: [aggs]})}`` evaluated in the
    same pass; groups without matching rows get NULL, including the count.
    """

    key: str
    prefix: str
    numeric: dict[str, list[str]] = field(default_factory=dict)
    vocab: dict[str, list[str]] = field(default_factory=dict)
    extra_mean: list[str] = field(default_factory=list)
    count_name: str | None = None
    conditional: dict[str, tuple[Column, dict[str, list[str]]]] = field(default_factory=dict)

    def restrict(self, columns: list[str]) -> "AggSpec":
        present = set(columns)
        return AggSpec(
            key=self.key, prefix=self.prefix,
            numeric={c: a for c, a in self.numeric.items() if c in present},
            vocab={c: v for c, v in self.vocab.items() if c in present},
            extra_mean=[c for c in self.extra_mean if c in present],
            count_name=self.count_name,
            conditional={p: (w, {c: a for c, a in spec.items() if c in present})
                         for p, (w, spec) in self.conditional.items()},
        )

    def expressions(self) -> list[Column]:
        from riskloom.operators.onehot import share_columns

        exprs = [agg_expr(c, a).alias(feature_name(self.prefix, c, a))
                 for c, aggs in self.numeric.items() for a in aggs]
        exprs += share_columns(self.vocab, self.prefix)
        exprs += [F.avg(F.col(f"`{c}`")).alias(feature_name(self.prefix, c, "mean"))
                  for c in self.extra_mean]
        for prefix, (predicate, spec) in self.conditional.items():
            exprs += [agg_expr(c, a, predicate).alias(feature_name(prefix, c, a))
                      for c, aggs in spec.items() for a in aggs]
            exprs.append(F.nullif(F.count_if(predicate), F.lit(0)).alias(f"{prefix}_APPLICATION_COUNT"))
        if self.count_name:
            exprs.append(F.count(F.lit(1)).alias(self.count_name))
        return exprs


# Category columns with more values than this get their shares from pivot
# counts (one extra aggregate on the same key) instead of one expression each;
# the output columns and their order are the same.
WIDE_VOCAB = 64
# Aggregates from which the rows of a group are brought together before any are computed.
WIDE_AGGREGATE = 16


def gather(df: DataFrame, key: str) -> DataFrame:
    """``df`` without NULL keys, every key's rows in one partition."""
    c = F.col(f"`{key}`")
    return df.filter(c.isNotNull()).repartition(c)


def multi_agg(df: DataFrame, spec: AggSpec, gathered: bool = False) -> DataFrame:
    """One hash aggregate per spec; NULL keys are dropped like pandas groupby.
    ``gathered``: ``df`` went through ``gather``, before columns were derived.

    Wide category columns are aggregated by ``category_share_wide`` and joined
    on the key; both sides are grouped on the key, so the join needs no
    further exchange.
    """
    from dataclasses import replace

    from riskloom.operators.onehot import category_share_wide, share_names

    spec = spec.restrict(df.columns)
    df = df.filter(F.col(spec.key).isNotNull())
    wide = {c: v for c, v in spec.vocab.items() if len(v) > WIDE_VOCAB}
    narrow = replace(spec, vocab={c: v for c, v in spec.vocab.items() if c not in wide})
    exprs = narrow.expressions()
    if len(exprs) >= WIDE_AGGREGATE and not gathered:
        # A group's running sums are several times as wide as its rows, and a client's rows
        # lie in many tasks: the rows are moved, not the sums, and aggregated where they meet.
        df = gather(df, spec.key)
    out = (df.groupBy(spec.key).agg(*exprs) if exprs
           else df.select(spec.key).distinct())
    for c, values in wide.items():
        out = out.join(category_share_wide(df, spec.key, c, values, spec.prefix), spec.key, "left")
    if not wide:
        return out
    # one layout whatever the number of values: shares stand between numeric and other columns
    shares = [n for c, v in spec.vocab.items() for n in share_names({c: v}, spec.prefix)]
    first = [feature_name(spec.prefix, c, a) for c, aggs in spec.numeric.items() for a in aggs]
    placed = {spec.key, *first, *shares}
    return out.select(*[F.col(f"`{c}`") for c in [spec.key, *first, *shares, *[c for c in out.columns if c not in placed]]])


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    from riskloom.functions.nulls import is_numeric

    return [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in exclude]


def all_numeric_spec(df: DataFrame, key: str, prefix: str, aggs: list[str],
                     exclude: tuple[str, ...] = ()) -> dict[str, list[str]]:
    """``{column: aggs}`` for every numeric column except the key (schema-driven)."""
    return {c: list(aggs) for c in numeric_columns(df, exclude=(key,) + tuple(exclude))}
