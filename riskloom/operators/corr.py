"""Pearson and Spearman correlation at width, pairwise-complete.

* Few columns against one target: central-moment aggregates in one pass.
  ``corr`` itself raises DIVIDE_BY_ZERO under ANSI on a constant column, so r
  is ``covar_samp / (stddev_samp * stddev_samp)`` with ``try_divide``, each
  moment restricted to the rows where both values are present.
* Spearman against a binary target: average ranks per distinct value from
  the bucketed prefix sums; r follows from per-value sums (no join back).
* Many columns x many columns: each task builds Gram blocks of its rows
  with numpy (counts, sums, squares and cross products over pairwise-complete
  rows, after centring on the column means); Spark sums the blocks by
  (i, j). One pass over the data, independent of the number of pairs.
* Spearman for many columns: rows are dealt into blocks by their id; a block sends the
  distinct values of a column and their counts to be ranked, and gets the ranks back.
  Both ways are packed numbers of a block, not a row per cell.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.nulls import inf_to_null, is_numeric
from riskloom.operators.longform import PLACE, long_form, named
from riskloom.operators.rank import buckets_per_group, cumulative_below


# Values whose spread is below this share of their mean are summation noise of a
# constant (a mean of identical ratios differs in its last bits): no correlation.
RELATIVE_SPREAD = 1e-12


def significant(c: Column, digits: int = 12) -> Column:
    """``c`` to so many significant digits, whatever its size: what counts as a
    tie in a ranking of computed doubles."""
    scale = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(c))))
    return F.when((c == 0) | (scale == 0), c).otherwise(F.round(c / scale, digits - 1) * scale)


def numeric_prepare(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Numeric and boolean columns only; bool -> int; ±inf/NaN -> NULL."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.BooleanType):
            cols.append(c.cast("int").alias(f.name))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(inf_to_null(c).alias(f.name))
        elif is_numeric(f.dataType) or f.name in keep:
            cols.append(c)
    return df.select(*cols)


def pearson_with_target(df: DataFrame, target: str, columns: list[str] | None = None) -> DataFrame:
    """(column, pearson, abs_pearson) over pairwise-complete rows; constant
    columns (NULL r) are dropped; ranked by |r| desc, then column.

    Long form (column, x, y) grouped by column: a fixed handful of aggregate
    expressions whatever the number of columns.
    """
    columns = [c for c in (columns or df.columns) if c != target]
    long = (long_form(df.withColumn("__y", F.col(f"`{target}`").cast("double")), columns, ("__y",), "__x")
            .filter(F.col("__x").isNotNull() & F.col("__y").isNotNull()))
    x, y = F.col("__x"), F.col("__y")
    spread = F.stddev_samp(x) > RELATIVE_SPREAD * F.abs(F.avg(x))
    r = F.when(spread, F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y)))
    rep = named(long.groupBy(PLACE).agg(r.alias("pearson")), columns)
    return (rep.filter(F.col("pearson").isNotNull() & ~F.isnan("pearson"))
            .select("column", "pearson", F.abs("pearson").alias("abs_pearson"))
            .orderBy(F.desc("abs_pearson"), "column"))


def spearman_with_binary_target(df: DataFrame, target: str, columns: list[str] | None = None) -> DataFrame:
    """(column, spearman, abs_spearman) for a 0/1 target, pairwise-complete.

    With average ranks R of x on the n complete rows and P positives:
    cov = sum(R * y)/n - (n+1)/2 * P/n, var_R = sum(R^2)/n - ((n+1)/2)^2,
    var_y = P/n (1 - P/n); every sum comes from the distinct-value table.
    """
    columns = [c for c in (columns or df.columns) if c != target]
    long = (long_form(df.withColumn("__y", F.col(f"`{target}`").cast("double")), columns, ("__y",))
            .filter(F.col("value").isNotNull() & F.col("__y").isNotNull())
            .withColumn("value", significant(F.col("value"))))
    cb = cumulative_below(long, "value", {"n": F.lit(1), "pos": F.col("__y")}, [PLACE],
                          buckets_per_group(df, len(columns)))
    avg_rank = F.col("below_n") + (F.col("n") + 1) / 2.0
    s = cb.groupBy(PLACE).agg(
        F.sum("n").alias("n"), F.sum("pos").alias("p"),
        F.sum(avg_rank * F.col("pos")).alias("sry"), F.sum(avg_rank * avg_rank * F.col("n")).alias("srr"))
    n = F.col("n").cast("double")
    mean_r = (n + 1) / 2.0
    py = F.col("p") / n
    cov = F.col("sry") / n - mean_r * py
    var_r = F.col("srr") / n - mean_r * mean_r
    var_y = py * (1 - py)
    rel = var_r / (mean_r * mean_r)
    r = F.when((rel > 1e-12) & (var_y > 0), F.try_divide(cov, F.sqrt(var_r * var_y)))
    return (named(s.select(PLACE, r.alias("spearman")), columns).filter(F.col("spearman").isNotNull())
            .select("column", "spearman", F.abs("spearman").alias("abs_spearman"))
            .orderBy(F.desc("abs_spearman"), "column"))


def top_k(report: DataFrame, by: str, k: int, name_col: str = "column") -> DataFrame:
    """k rows with the largest ``by`` (ties: name) -> TakeOrderedAndProject."""
    return report.orderBy(F.desc(by), name_col).limit(k)


_GRAM_SCHEMA = T.StructType([
    T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType()),
    T.StructField("n", T.DoubleType()), T.StructField("sx", T.DoubleType()), T.StructField("sy", T.DoubleType()),
    T.StructField("sxx", T.DoubleType()), T.StructField("syy", T.DoubleType()), T.StructField("sxy", T.DoubleType()),
])


def _gram_blocks(p: int, upper_only: bool):
    def run(batches):
        acc = None
        for pdf in batches:
            x = pdf.to_numpy(dtype="float64", na_value=np.nan)
            m = (~np.isnan(x)).astype("float64")
            x0 = np.where(m > 0, x, 0.0)
            block = (m.T @ m, x0.T @ m, m.T @ x0, (x0 * x0).T @ m, m.T @ (x0 * x0), x0.T @ x0)
            acc = block if acc is None else tuple(a + b for a, b in zip(acc, block))
        if acc is None:
            return
        ii, jj = (np.triu_indices(p) if upper_only else np.indices((p, p)).reshape(2, -1))
        yield pd.DataFrame({"i": ii.astype("int32"), "j": jj.astype("int32"), "n": acc[0][ii, jj],
                            "sx": acc[1][ii, jj], "sy": acc[2][ii, jj], "sxx": acc[3][ii, jj],
                            "syy": acc[4][ii, jj], "sxy": acc[5][ii, jj]})
    return run


def pearson_matrix(df: DataFrame, columns: list[str], upper_only: bool = True) -> DataFrame:
    """Pairwise-complete Pearson r for all column pairs as (col_a, col_b, r).

    Columns are centred on their means first (one aggregate), which keeps the
    moment formula accurate; a pair whose variance vanishes on its complete
    rows gives NULL.
    """
    p = len(columns)
    xs = [F.col(f"`{c}`").cast("double") for c in columns]
    means = df.agg(*[F.avg(x).alias(f"m{i}") for i, x in enumerate(xs)]).collect()[0]
    centred = df.select(*[(x - F.lit(means[f"m{i}"] if means[f"m{i}"] is not None else 0.0)).alias(f"c{i}")
                          for i, x in enumerate(xs)])
    # Every task emits one block set; the sums by (i, j) are the only shuffle.
    sums = (centred.mapInPandas(_gram_blocks(p, upper_only), _GRAM_SCHEMA)
            .groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")]))
    vx = F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")
    vy = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    cxy = F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")
    size = F.array(*[F.lit(abs(means[f"m{i}"] or 0.0) * RELATIVE_SPREAD) for i in range(p)])
    least = lambda k: F.element_at(size, F.col(k) + 1) * F.element_at(size, F.col(k) + 1) * F.col("n")
    tiny_x = (vx <= 1e-10 * F.abs(F.col("sxx")) + 1e-300) | (vx <= least("i"))
    tiny_y = (vy <= 1e-10 * F.abs(F.col("syy")) + 1e-300) | (vy <= least("j"))
    r = F.when((F.col("n") > 1) & ~tiny_x & ~tiny_y, F.try_divide(cxy, F.sqrt(vx * vy)))
    names = F.array(*[F.lit(c) for c in columns])
    clamped = F.when(r.isNotNull(), F.least(F.greatest(r, F.lit(-1.0)), F.lit(1.0)))
    return sums.select(F.element_at(names, F.col("i") + 1).alias("col_a"),
                       F.element_at(names, F.col("j") + 1).alias("col_b"), clamped.alias("r"))


def correlated_pairs(df: DataFrame, columns: list[str], threshold: float = 0.90) -> DataFrame:
    """Distinct pairs (i < j) with |r| > threshold, sorted by |r| desc."""
    m = pearson_matrix(df, columns, upper_only=True).filter(F.col("col_a") != F.col("col_b"))
    return (m.filter(F.abs("r") > threshold)
            .select(F.least("col_a", "col_b").alias("col_a"), F.greatest("col_a", "col_b").alias("col_b"),
                    "r", F.abs("r").alias("abs_r"))
            .orderBy(F.desc("abs_r"), "col_a", "col_b"))


def _complete_rows(df: DataFrame, columns: list[str]) -> np.ndarray:
    """Rows in which both columns of each pair are present, as a matrix."""
    def run(batches):
        acc = np.zeros((len(columns), len(columns)))
        for pdf in batches:
            m = pdf.to_numpy(dtype="float64")
            acc += m.T @ m
        ii, jj = np.indices(acc.shape).reshape(2, -1).astype("int32")
        yield pd.DataFrame({"i": ii, "j": jj, "n": acc[ii, jj].astype("int64")})

    present = df.select(*[F.col(f"`{c}`").isNotNull().cast("int").alias(f"c{k}") for k, c in enumerate(columns)])
    out = np.zeros((len(columns), len(columns)), np.int64)
    for r in present.mapInPandas(run, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect():
        out[r["i"], r["j"]] = r["n"]
    return out


def rankings(n: np.ndarray) -> dict[tuple[int, int], int]:
    """The rankings that all pairs of columns need, numbered: (a, b) is column a on the rows
    that have b too. ``n`` counts complete rows: columns with the same rows share their
    rankings, and where every row with a has b it is a's own, (a, a)."""
    first = [next(j for j in range(len(n)) if n[j, j] == n[j, k] == n[k, k]) for k in range(len(n))]
    found: dict[tuple[int, int], int] = {}
    out = {}
    for a in range(len(n)):
        for b in range(len(n)):
            out[a, b] = found.setdefault((a, a if n[a, b] == n[a, a] else first[b]), len(found))
    return out


_RANK_PAIRS = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"
# Rows of a block, and of a column's values that one task ranks, about.
BLOCK_ROWS, BUCKET_ROWS = 10_000, 200_000
_BLOCK_PART = "block long, place int, bucket int, data binary, n binary"
_BLOCK_SCHEMA = pa.schema([("block", pa.int64()), ("place", pa.int32()), ("bucket", pa.int32()), ("data", pa.binary()), ("n", pa.binary())])


def _parts(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * 5
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _BLOCK_SCHEMA)], schema=_BLOCK_SCHEMA)


def _cells(table: pa.Table, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Values (-0.0 as 0.0) and presence of column ``k``; NaN is a value, above all others."""
    column = table.column(f"c{k}").combine_chunks()
    present = column.is_valid().to_numpy(zero_copy_only=False)
    return np.where(present, column.fill_null(0.0).to_numpy(zero_copy_only=False), 0.0) + 0.0, present


def _block_codes(p: int):
    """Per block: the place of each cell among its column's distinct values (0: missing), rows
    in the order of their ids, and where a new id begins."""
    def run(key, table):
        ids = table.column("__rid").combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        order = np.argsort(ids, kind="stable")
        begins = np.flatnonzero(np.r_[True, np.diff(ids[order]) != 0])
        codes = np.zeros((p, len(ids)), np.int32)
        for k in range(p):
            v, present = _cells(table, k)
            codes[k, present] = 1 + np.unique(v[present], return_inverse=True)[1]
        return _parts([(key[0].as_py(), -1, 0, codes[:, order].tobytes(), begins.astype(np.int64).tobytes())])
    return run


def _block_values(p: int, others: list[list[int]], bounds: list[np.ndarray]):
    """Per block, column and bucket of values: the distinct values, and in how many rows each
    stands, for every ranking of the column."""
    def run(key, table):
        out = []
        cells = [_cells(table, k) for k in range(p)]
        for k, (v, present) in enumerate(cells):
            u, code = np.unique(v[present], return_inverse=True)
            n = np.stack([np.bincount(code[cells[b][1][present]], minlength=len(u)) for b in others[k]]).astype(np.int32)
            cut = np.r_[0, np.searchsorted(u, bounds[k], "right"), len(u)]
            for bucket, (i, j) in enumerate(zip(cut[:-1], cut[1:])):
                if j > i:
                    out.append((key[0].as_py(), k, bucket, u[i:j].tobytes(), np.ascontiguousarray(n[:, i:j]).tobytes()))
        return _parts(out)
    return run


def _rank_bucket(below: list[np.ndarray]):
    """Average ranks of the values of one column and bucket, back to the blocks they came
    from; ``below`` has the rows in lower buckets by column, ranking and bucket."""
    def run(key, table):
        k, bucket = key[0].as_py(), key[1].as_py()
        values = [np.frombuffer(x, np.float64) for x in table.column("data").to_pylist()]
        counts = [np.frombuffer(x, np.int32).reshape(-1, len(v)) for x, v in zip(table.column("n").to_pylist(), values)]
        u, code = np.unique(np.concatenate(values), return_inverse=True)
        at = np.split(code, np.cumsum([len(v) for v in values])[:-1])
        ranks = []
        for r in range(len(below[k])):
            n = np.zeros(len(u))
            for c, i in zip(counts, at):
                n[i] += c[r]                               # a block's values are distinct
            ranks.append(below[k][r][bucket] + n.cumsum() - n + (n + 1) / 2.0)
        ranks = np.stack(ranks)
        return _parts([(block, k, bucket, np.ascontiguousarray(ranks[:, i]).tobytes(), b"")
                       for block, i in zip(table.column("block").to_pylist(), at)])
    return run


def _rank_grams(p: int, others: list[list[int]], numbers: list[list[int]], centres: np.ndarray, need: np.ndarray):
    """Per block: sums over the rows with both rankings of each pair in ``need`` (two rows of numbers)."""
    def run(key, table):
        parts = {}
        for place, bucket, data, n in zip(*(table.column(c).to_pylist() for c in ("place", "bucket", "data", "n"))):
            parts.setdefault(place, {})[bucket] = (data, n)
        codes, begins = (np.frombuffer(x, t) for x, t in zip(parts[-1][0], (np.int32, np.int64)))
        codes = codes.reshape(p, -1)
        rows = codes.shape[1]
        x, m = np.zeros((rows, len(centres))), np.zeros((rows, len(centres)))
        for k in range(p):
            if k not in parts:                              # no values in this block
                continue
            ranks = np.concatenate([np.frombuffer(parts[k][b][0], np.float64).reshape(len(others[k]), -1)
                                    for b in sorted(parts[k])], axis=1)
            for r, (b, number) in enumerate(zip(others[k], numbers[k])):
                at = np.flatnonzero((codes[k] > 0) & (codes[b] > 0))
                x[at, number], m[at, number] = ranks[r, codes[k, at] - 1] - centres[number], 1.0
        if len(begins) < rows:                              # an id that comes twice has its greatest rank
            x = np.maximum.reduceat(np.where(m > 0, x, -np.inf), begins, axis=0)
            m = np.maximum.reduceat(m, begins, axis=0)
            x = np.where(m > 0, x, 0.0)
        acc = (m.T @ m, x.T @ m, m.T @ x, (x * x).T @ m, m.T @ (x * x), x.T @ x)
        i, j = need
        return pa.table({"i": i.astype(np.int32), "j": j.astype(np.int32),
                         **{name: a[i, j] for name, a in zip(("n", "sx", "sy", "sxx", "syy", "sxy"), acc)}})
    return run


def _value_bounds(base: DataFrame, p: int, buckets: int) -> list[np.ndarray]:
    """Ascending values that cut each column into about ``buckets`` equal buckets."""
    if buckets <= 1:
        return [np.zeros(0)] * p
    probs = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    row = base.agg(*[F.percentile_approx(f"c{k}", probs, max(1000, 10 * buckets)).alias(f"c{k}") for k in range(p)]).first()
    return [np.unique(np.array(row[k] or [], float) + 0.0) for k in range(p)]


def _rows_below(base: DataFrame, p: int, others: list[list[int]], bounds: list[np.ndarray]) -> list[np.ndarray]:
    """By column: rows in lower buckets, for each ranking and bucket."""
    def run(batches):
        acc = [np.zeros((len(others[k]), len(bounds[k]) + 1), np.int64) for k in range(p)]
        for batch in batches:
            cells = [_cells(pa.table(batch.columns, batch.schema.names), k) for k in range(p)]
            for k, (v, present) in enumerate(cells):
                bucket = np.searchsorted(bounds[k], v, "left")
                for r, b in enumerate(others[k]):
                    acc[k][r] += np.bincount(bucket[present & cells[b][1]], minlength=acc[k].shape[1])
        yield pa.RecordBatch.from_pydict({"place": np.arange(p, dtype=np.int32), "n": [a.tobytes() for a in acc]})

    total = [np.zeros((len(others[k]), len(bounds[k]) + 1), np.int64) for k in range(p)]
    if any(len(b) for b in bounds):
        for r in base.drop("__rid").mapInArrow(run, "place int, n binary").toLocalIterator():
            total[r["place"]] += np.frombuffer(r["n"], np.int64).reshape(total[r["place"]].shape)
    return [t.cumsum(axis=1) - t for t in total]


def spearman_matrix(df: DataFrame, columns: list[str], id_col: str) -> DataFrame:
    """Pairwise-complete Spearman r for all ordered column pairs (col_a, col_b, r).

    For each pair, ranks are those of the rows where both values are present (pandas
    semantics). Columns that are present in the same rows share them, so a column is
    ranked once per set of rows it meets (``rankings``), not once per pair. Blocks of rows
    send each column's distinct values, by buckets, to be ranked over all blocks; r comes
    from Gram blocks of the rank columns, centred, summed by pair.
    ``id_col`` must be unique: rows that repeat an id count once, with their greatest ranks.
    """
    p = len(columns)
    xs = {c: significant(F.col(f"`{c}`").cast("double")) for c in columns}
    base = df.select(F.col(id_col).alias("__rid"), *[xs[c].alias(f"c{k}") for k, c in enumerate(columns)])
    present = _complete_rows(base, [f"c{k}" for k in range(p)])
    number = rankings(present)
    of = {}
    for (a, b), k in number.items():
        of.setdefault(k, (a, b))
    others = [[b for k, (a, b) in sorted(of.items()) if a == c] for c in range(p)]
    numbers = [[k for k, (a, b) in sorted(of.items()) if a == c] for c in range(p)]
    n_rows = int(present.max(initial=0))
    bounds = _value_bounds(base, p, -(-n_rows // BUCKET_ROWS))
    below = _rows_below(base, p, others, bounds)
    pairs = [(a, b) for a in range(p) for b in range(a, p)]
    need = np.array([(number[a, b], number[b, a]) for a, b in pairs]).T.reshape(2, -1)
    centres = np.array([(present[of[k]] + 1) / 2.0 for k in range(len(of))])
    blocks = base.withColumn("__block", F.pmod(F.xxhash64("__rid"), F.lit(max(1, -(-n_rows // BLOCK_ROWS))))).groupBy("__block")
    ranked = (blocks.applyInArrow(_block_values(p, others, bounds), _BLOCK_PART)
              .groupBy("place", "bucket").applyInArrow(_rank_bucket(below), _BLOCK_PART))
    sums = (blocks.applyInArrow(_block_codes(p), _BLOCK_PART).unionByName(ranked).groupBy("block")
            .applyInArrow(_rank_grams(p, others, numbers, centres, np.unique(need, axis=1)), _RANK_PAIRS)
            .groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")]))
    vx = F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")
    vy = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    cxy = F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")
    spread = (F.col("n") > 1) & (vx > 1e-12 * F.col("sxx")) & (vy > 1e-12 * F.col("syy"))
    r = F.when(spread, F.least(F.greatest(F.try_divide(cxy, F.sqrt(vx) * F.sqrt(vy)), F.lit(-1.0)), F.lit(1.0)))
    wanted = df.sparkSession.createDataFrame([(columns[a], columns[b], *map(int, ij)) for (a, b), ij in zip(pairs, need.T)
                                              if present[a, b]], "col_a string, col_b string, i int, j int")
    upper = wanted.join(sums.select("i", "j", r.alias("r")), ["i", "j"]).select("col_a", "col_b", "r")
    lower = upper.filter(F.col("col_a") != F.col("col_b")).select(
        F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "r")
    return upper.unionByName(lower)
