"""Near-duplicate documents by fast similarity sketching (operator 10).

Sketch of a shingle set: in round i every shingle is hashed to one of t bins with
a value in [i, i + 1), and a bin keeps its least value; rounds go on until no bin
is empty, and in rounds t .. 2t every shingle goes to bin i - t, so each
coordinate fills after 2t rounds at most and after few for larger sets. Two sets
agree in a coordinate with the probability of their Jaccard similarity, with the
concentration of t independent draws.

Equal sets form one class. Classes that share a band of the sketch are candidates.
In each bucket every class is checked against the bucket's centre on the full
sets; classes of a centre that are still in different components are then checked
against each other, block by block, unless distances to the centre rule the link
out (Jaccard distance is a metric). Components of the confirmed links are the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import textbatch as tb
from riskloom.llm.components import components
from riskloom.llm.store import drop, if_small, written

SHINGLE_WORDS = 5
MIN_PERCENT = 80
#: 24 bands of 4 coordinates: a pair at similarity 0.8 shares none with probability 3e-6.
BANDS, ROWS = 24, 4
#: Sets on either side of a task that compares classes block by block.
BLOCK = 1000

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(column: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text (A-Z lower-cased); a text with
    fewer words is one shingle, a text without words none."""
    data, offs = tb.text_bytes(column)
    data = tb.LOWER[data]
    s, e, doc = tb.word_spans(data, offs)
    h = tb.word_hashes(data, s, e)
    n = len(offs) - 1
    sh, pos = tb.shingle_hashes(h, doc, words)
    at = np.searchsorted(doc[pos], np.arange(n + 1))
    first = np.searchsorted(doc, np.arange(n + 1))
    out = []
    for i in range(n):
        if at[i + 1] > at[i]:
            out.append(np.unique(sh[at[i]:at[i + 1]]))
        elif first[i + 1] > first[i]:
            acc = np.uint64(first[i + 1] - first[i])
            with np.errstate(over="ignore"):
                for x in h[first[i]:first[i + 1]]:
                    acc = tb.mix(np.array([acc]))[0] + x
            out.append(np.array([acc], dtype=np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def sketch(items: np.ndarray, t: int) -> np.ndarray:
    """Fast similarity sketch of a non-empty set of 64-bit hashes: t values that
    hold the round in the top bits and the hash below them."""
    out = np.full(t, _EMPTY)
    for i in range(2 * t):
        h = tb.mix(items ^ tb.mix(np.array([i + 1], dtype=np.uint64)))
        if i < t:
            bins = ((h >> np.uint64(40)) * np.uint64(t)) >> np.uint64(24)
        else:
            bins = np.full(len(items), i - t, dtype=np.uint64)
        value = (np.uint64(i) << np.uint64(48)) | (tb.mix(h) >> np.uint64(16))
        now = np.full(t, _EMPTY)
        np.minimum.at(now, bins.astype(np.int64), value)
        empty = out == _EMPTY
        out[empty] = now[empty]
        if not (out == _EMPTY).any():
            break
    return out


def band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band."""
    acc = np.arange(1, bands + 1, dtype=np.uint64) * tb.MIX_A
    for col in values[:bands * rows].reshape(bands, rows).T:
        acc = tb.mix(acc ^ col) + col
    return tb.mix(acc)


def sketches(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """(id, n, hi, lo, keys) of each row of ``docs`` (id, text): set size, a
    128-bit fingerprint of the set, and its band keys."""
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in tb.slices(batch, "text"):
                sets = shingle_sets(part.column(1), words)
                with np.errstate(over="ignore"):
                    hi = np.array([tb.mix(x).sum(dtype=np.uint64) for x in sets], dtype=np.uint64)
                    lo = np.array([tb.mix(x ^ tb.MIX_A).sum(dtype=np.uint64) for x in sets], dtype=np.uint64)
                keys = [band_keys(sketch(x, bands * rows), bands, rows).view(np.int64) if len(x) else None for x in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.array(hi.view(np.int64)),
                     pa.array(lo.view(np.int64)), pa.array(keys, pa.list_(pa.int64()))],
                    names=["id", "n", "hi", "lo", "keys"])

    return docs.mapInArrow(run, f"id {id_type}, n bigint, hi bigint, lo bigint, keys array<bigint>")


def full_sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """(id, s) with the whole shingle set of the rows of ``docs`` (id, text)
    whose id is in ``ids``."""
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in tb.slices(batch, "text"):
                sets = [x.view(np.int64) for x in shingle_sets(part.column(1), words)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["id", "s"])

    return docs.join(if_small(ids), "id", "left_semi").mapInArrow(run, f"id {id_type}, s array<bigint>")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with ``inter`` and ``total``, the sizes of the sets'
    intersection and union."""
    a = sets.select(F.col("id").alias("a"), F.col("s").alias("sa"))
    b = sets.select(F.col("id").alias("b"), F.col("s").alias("sb"))
    both = pairs.join(b, "b").join(a, "a").withColumn("inter", F.size(F.array_intersect("sa", "sb")))
    return both.withColumn("total", F.size("sa") + F.size("sb") - F.col("inter")).drop("sa", "sb")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
                    min_percent: int = MIN_PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Component of every document: ``id_col``, n_shingles, component_id, kept.

    Documents are linked if 100 * |intersection| >= ``min_percent`` * |union| of
    their sets of distinct ``words``-word shingles; ``component_id`` is the
    smallest id reachable by links, and ``kept`` marks the row that has it. A text
    without words, or null, has an empty set and is linked with nothing; a shorter
    text is one shingle. Rows with one id are one node, linked by any of their texts,
    and get one component (kept or not together). A null id is linked with nothing: null component, kept. An
    empty table gives no rows; other columns are not read.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    marks = written(sketches(src, words, bands, rows), "near-sketches")
    # classes of equal sets; of several rows with one id each may be in another class
    first = marks.filter("n > 0 and id is not null").groupBy("hi", "lo").agg(F.min(F.struct("id", "n", "keys")).alias("m"))
    classes = written(first.select("hi", "lo", F.col("m.id").alias("id"), F.col("m.n").alias("n"),
                                   F.col("m.keys").alias("keys")), "near-classes")
    # one id with several texts: its classes are linked through the id itself
    same_id = marks.filter("n > 0 and id is not null").join(
        classes.select("hi", "lo", F.col("id").alias("v")), ["hi", "lo"]).filter("id != v").select(F.col("id").alias("u"), "v")
    twice = marks.filter("id is not null").groupBy("id").agg(
        F.count(F.lit(1)).alias("c")).filter("c > 1").select("id")
    id_links = same_id.join(twice, same_id["u"] == twice["id"], "left_semi")

    spread = classes.select("id", "n", F.explode("keys").alias("key"))
    centres = written(spread.groupBy("key").agg(F.min("id").alias("centre"), F.count(F.lit(1)).alias("c"))
                      .filter("c > 1").select("key", "centre"), "near-centres")
    members = written(spread.join(centres, "key"), "near-members")      # classes in buckets of two and more
    ids = written(members.select("id").distinct(), "near-ids")
    sets = full_sets(src, ids, words)
    if not twice.isEmpty():                                    # an id's several texts each count, its copies once
        sets = sets.dropDuplicates(["id", "s"])
    sets = written(sets, "near-sets")

    limit = F.lit(min_percent)
    stars = (members.filter("id != centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct())
    star = written(verified(stars, sets), "near-stars")
    linked = 100 * F.col("inter") >= limit * F.col("total")
    links = star.filter(linked).select(F.col("a").alias("u"), F.col("b").alias("v"))
    parts = written(components(links), "near-parts")

    rest = open_links(star, parts, sets, min_percent)
    final = written(components(_as_links(parts).unionByName(rest).unionByName(id_links)), "near-parts")
    for df in (centres, members, ids, sets, star, parts):
        drop(df)

    by_class = classes.select("hi", "lo", "id").join(final.withColumnRenamed("node", "id"), "id", "left").select(
        "hi", "lo", F.coalesce("component", "id").alias("part"))
    named = written(by_class, "near-named")
    in_class = marks.join(named, ["hi", "lo"], "left")
    part = F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, F.coalesce("part", "id")).otherwise(F.col("id")))
    return in_class.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), part.alias("component_id"),
                           F.col("id").eqNullSafe(part).alias("kept"))


def _as_links(parts: DataFrame) -> DataFrame:
    """Found components as links to their roots."""
    return parts.select(F.col("node").alias("u"), F.col("component").alias("v"))


def open_links(star: DataFrame, parts: DataFrame, sets: DataFrame, min_percent: int) -> DataFrame:
    """Links (u, v) between classes that a centre brought together and that are
    still in different components.

    ``star`` has the exact similarity of each class to its centre. A link needs a
    Jaccard distance of at most 1 - min_percent / 100; by the triangle inequality
    the distances of its two ends to the centre then differ by no more than that,
    and the smaller set has at least ``min_percent`` of the larger one's size. What
    is left is compared block against block in numpy: classes outside the centre's
    component (probes) against all of the centre's classes, with at most some
    ``BLOCK`` sets on either side of a task. Only links come out as rows.
    """
    part = parts.withColumnRenamed("node", "id")
    near = (star.select(F.col("a").alias("centre"), F.col("b").alias("id"),
                        (1.0 - F.col("inter") / F.col("total")).alias("d"))
            .join(part, "id", "left").withColumn("part", F.coalesce("component", "id")).drop("component")
            .join(parts.select(F.col("node").alias("centre"), F.col("component").alias("main")), "centre", "left")
            .withColumn("outside", F.col("part") != F.coalesce("main", "centre")).drop("main"))
    near = written(near, "near-around")
    # a centre with one class has been compared with it
    sizes = near.groupBy("centre").agg(F.count(F.lit(1)).alias("c"), F.count_if("outside").alias("o")).filter("o > 0 and c > 1")
    some = near.join(sizes, "centre").withColumn("blocks", F.ceil(F.col("c") / BLOCK).cast("int")).withColumn(
        "probes", F.ceil(F.col("o") / BLOCK).cast("int"))
    mine = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cols = ["centre", "id", "d", "part", "outside"]
    base = some.withColumn("bb", mine("blocks")).select(*cols, "bb", every("probes").alias("pb"), F.lit(False).alias("probe"))
    probe = some.filter("outside").withColumn("pb", mine("probes")).select(
        *cols, every("blocks").alias("bb"), "pb", F.lit(True).alias("probe"))
    rows = base.unionByName(probe.select(*base.columns)).join(sets, "id")
    id_type = star.schema["a"].dataType.simpleString()
    reach = 1.0 - min_percent / 100.0 + 1e-9

    def compare(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_pylist()
        parts_ = table.column("part").to_pylist()
        code = {p: k for k, p in enumerate(dict.fromkeys(parts_))}
        part_ = np.array([code[p] for p in parts_])
        d, outside = table.column("d").to_numpy(), np.array(table.column("outside").to_pylist())
        is_probe = np.array(table.column("probe").to_pylist())
        values = [np.asarray(x, dtype=np.int64) for x in table.column("s").to_numpy()]
        size = np.array([len(x) for x in values])
        base_at, found = np.flatnonzero(~is_probe), []
        if len(base_at):
            flat = np.concatenate([values[k] for k in base_at])
            owner = np.repeat(np.arange(len(base_at)), size[base_at])
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], owner[order]
            for k in np.flatnonzero(is_probe):
                can = ((part_[base_at] != part_[k]) & (np.abs(d[base_at] - d[k]) <= reach)
                       & (100 * np.minimum(size[base_at], size[k]) >= min_percent * np.maximum(size[base_at], size[k])))
                if not can.any():
                    continue
                lo, hi = np.searchsorted(flat, values[k], "left"), np.searchsorted(flat, values[k], "right")
                inter = np.bincount(owner[tb.ragged(lo, hi - lo)], minlength=len(base_at))
                hit = can & (100 * inter >= min_percent * (size[base_at] + size[k] - inter))
                # two classes outside meet twice; one of them reports the link
                found += [(ids[k], ids[j]) for j in base_at[hit] if not outside[j] or ids[k] < ids[j]]
        kind = table.schema.field("id").type
        return pa.table({"u": pa.array([x[0] for x in found], kind), "v": pa.array([x[1] for x in found], kind)})

    return rows.groupBy("centre", "bb", "pb").applyInArrow(compare, f"u {id_type}, v {id_type}")


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, without those that ``near_duplicates``
    does not keep; of rows with one id and text one stays."""
    marks = near_duplicates(docs, id_col, text_col, **options)
    gone = written(marks.filter(~F.col("kept")).select(F.col(id_col).alias("id")).distinct(), "near-gone")
    rows = docs.select(F.col(id_col).alias("id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    left = rows.join(if_small(gone), "id", "left_anti")
    again = rows.filter("id is not null").groupBy("id").count().filter("count > 1")
    if not again.isEmpty():
        left = (left.withColumn("hash", F.xxhash64(F.col("row").getField(text_col)))
                .withColumn("none", F.when(F.col("id").isNull(), F.monotonically_increasing_id()))
                .dropDuplicates(["id", "hash", "none"]))
    return left.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
