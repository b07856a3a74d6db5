"""Ranked lexical search by pair-bound MaxScore (operator 11).

The index is cut by documents: a task turns the texts it reads into segments of a
bounded number of text bytes, one posting list per term and segment. Global counts
give the weights. For the terms of a block of queries, each segment then gets its
impacts and, for pairs of terms that queries hold together, precomputed intersection
lists with the largest joint impact any document of the segment reaches.

A query pairs its terms where that lowers the bound most: a pair adds at most its
joint maximum or its larger single one, never their sum unless a document has both.
From the strongest pair down, documents become candidates as long as what is left can
reach the threshold; a term whose own maximum cannot is read through its intersection
list. Candidates are scored pair by pair and dropped as soon as the bound of the rest
(a partner's bound tightened by the impact already found) falls below the threshold.

Segments are searched in rounds of growing size. Each round starts from the score of
the k-th best document found so far, so later rounds return few rows a segment.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import textbatch as tb
from riskloom.llm.store import new_path, written

K = 50
#: Text bytes and documents of a segment (a longer text is a segment of its own).
SEGMENT_BYTES = 16 << 20
SEGMENT_DOCS = 1 << 16
#: Queries of a block, on average.
BLOCK_QUERIES = 500
#: A query's term is paired with one of so many next weaker ones.
PAIR_REACH = 3
#: Segments of the first round, and growth of the rounds.
FIRST_SEGMENTS, ROUND_GROWTH = 16, 8

# Fixed values of the score: w * ((SCALE * TF * tf) div (TF * tf + K1 * m)),
# m = 100 - B + (B * n * N) div L, w = floor(1000 * ln((2N + 2) / (2df + 1))).
SCALE, TF, K1, B = 1_000_000, 1000, 20, 50

_TERM = np.zeros(256, dtype=bool)
_TERM[0x30:0x3A] = _TERM[0x41:0x5B] = _TERM[0x61:0x7B] = _TERM[0x80:] = True


def terms_of(column: pa.Array):
    """(document, code, distinct terms) of the terms of a text column: the maximal
    runs of letters and digits of ASCII and of all other characters, A-Z lower-cased."""
    data, offs = tb.text_bytes(column)
    data = tb.LOWER[data]
    s, e, doc = tb.mask_spans(_TERM[data], offs)
    codes, distinct = tb.spans_to_ids(data, s, e)
    return doc, codes, distinct


def _binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Slices ``data[bounds[i]:bounds[i + 1]]`` as a binary array, without copies."""
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [
        None, pa.py_buffer((bounds * data.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


class _Segment:
    """Postings of consecutive documents of a task."""

    def __init__(self):
        self.ids, self.lens, self.parts, self.codes, self.bytes = [], [], [], {}, 0

    def add(self, part: pa.RecordBatch) -> None:
        doc, codes, distinct = terms_of(part.column(1))
        n = part.num_rows
        own = np.fromiter((self.codes.setdefault(w, len(self.codes)) for w in tb.byte_strings(distinct)), np.int64, len(distinct))
        both, tf = np.unique(codes * n + doc, return_counts=True)
        term, local = np.divmod(both, max(n, 1))
        self.parts.append((own[term].astype(np.int32), (local + sum(map(len, self.ids))).astype(np.uint16), tf.astype(np.int32)))
        self.ids.append(part.column(0))
        self.lens.append(np.bincount(doc, minlength=n).astype(np.int64))
        self.bytes += part.column(1).nbytes

    def rows(self, number: int, id_type: pa.DataType):
        """The segment's document row, then a row per term."""
        ids, lens = pa.concat_arrays([x.cast(id_type) for x in self.ids]), np.concatenate(self.lens)
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([None], pa.string()), pa.array([int((lens > 0).sum())], pa.int64()),
             pa.array([int(lens.sum())], pa.int64()), pa.array([None], pa.binary()), pa.array([lens.tobytes()], pa.binary()),
             pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)], names=NAMES)
        term, doc, tf = (np.concatenate(x) for x in zip(*self.parts))
        if len(term) == 0:
            return
        order = np.argsort(term, kind="stable")                    # parts are in document order
        term, doc, tf = term[order], doc[order], tf[order]
        words = np.array(list(self.codes), dtype=object)
        bounds = np.searchsorted(term, np.arange(len(words) + 1))
        step = 20_000
        for a in range(0, len(words), step):
            at = bounds[a:a + step + 1]
            m = len(at) - 1
            lo, hi = at[0], at[-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(m, number)), pa.array([w.decode() for w in words[a:a + m]], pa.string()), pa.array(np.diff(at)),
                 pa.nulls(m, pa.int64()), _binary(doc[lo:hi], at - lo), _binary(tf[lo:hi], at - lo),
                 pa.nulls(m, pa.list_(id_type))], names=NAMES)


NAMES = ["segment", "term", "df", "total", "docs", "counts", "ids"]


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_bytes: int = SEGMENT_BYTES,
                segment_docs: int = SEGMENT_DOCS) -> DataFrame:
    """Index of all rows of ``docs``, written to the shared folder.

    A row per segment and term: term, df, docs (places in the segment) and counts;
    and one per segment (null term): ids, counts (terms of each document), df
    (documents with a term) and total (their terms).
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = src.schema["id"].dataType.simpleString()

    def run(batches):
        from pyspark import TaskContext

        number, now, kind = TaskContext.get().partitionId() << 32, None, None
        for batch in batches:
            kind = batch.schema.field(0).type
            for big in tb.slices(batch, "text"):
                for at in range(0, big.num_rows, segment_docs):
                    part = big.slice(at, segment_docs)
                    held = sum(map(len, now.ids)) if now else 0
                    if now and (now.bytes + part.column(1).nbytes > segment_bytes or held + part.num_rows > segment_docs):
                        yield from now.rows(number, kind)
                        number, now = number + 1, None
                    now = now or _Segment()
                    now.add(part)
        if now:
            yield from now.rows(number, kind)

    return written(src.mapInArrow(run, f"segment bigint, term string, df bigint, total bigint, docs binary, counts binary, "
                                       f"ids array<{id_type}>"), "lexical-index")


def query_terms(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, term): the distinct terms of each query; rows with one id are one query."""
    src = queries.select(F.col(id_col).alias("item"), F.col(text_col).alias("text"))
    kind = src.schema["item"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in tb.slices(batch, "text"):
                doc, codes, distinct = terms_of(part.column(1))
                both = np.unique(doc * max(len(distinct), 1) + codes)
                rows, codes = np.divmod(both, max(len(distinct), 1))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows)), distinct.take(pa.array(codes)).cast(pa.string())],
                                                 names=["item", "term"])

    return src.mapInArrow(run, f"item {kind}, term string").distinct()


def _round(segment: Column, shares: list[float]) -> Column:
    """Round of a segment: ``shares`` are the upper ends of the rounds in [0, 1]."""
    u = F.pmod(F.xxhash64(segment), F.lit(1 << 30)) / float(1 << 30)
    out = F.lit(len(shares) - 1)
    for k in range(len(shares) - 2, -1, -1):
        out = F.when(u < shares[k], F.lit(k)).otherwise(out)
    return out.cast("int")


def search(index: DataFrame, queries: DataFrame, k: int = K, item_col: str = "item_id", text_col: str = "text",
           id_name: str = "doc_id") -> DataFrame:
    """The ``k`` documents of ``index`` with the highest scores for each query:
    ``item_col``, rank, ``id_name``, score.

    Equal scores go by ascending id (null last); documents with a score of 0 and
    queries without a hit give no row. Rows of the index with one id rank on their
    own; queries with one id are one query with the terms of all.
    """
    spark = index.sparkSession
    item_type, id_type = queries.schema[item_col].dataType.simpleString(), index.schema["ids"].dataType.elementType.simpleString()
    empty = f"{item_col} {item_type}, rank int, {id_name} {id_type}, score bigint"
    lists, segments = index.filter("term is not null"), index.filter("term is null")
    stats = segments.agg(F.sum("df"), F.sum("total"), F.count(F.lit(1))).first()
    n, total, many = (int(x or 0) for x in stats)
    if n == 0:
        return spark.createDataFrame([], empty)

    asked = written(query_terms(queries, item_col, text_col), "lexical-queries")
    blocks = max(1, asked.select("item").distinct().count() // BLOCK_QUERIES)
    block = F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int")
    words = written(asked.withColumn("block", block).groupBy("block", "term").agg(F.collect_list(F.struct("item")).alias("items")),
                    "lexical-terms")
    df = lists.select("term", "df").join(words.select("term").distinct(), "term").groupBy("term").agg(F.sum("df").alias("n"))
    weight = F.floor(1000 * F.log((2 * F.lit(float(n)) + 2) / (2 * F.col("n").cast("double") + 1))).cast("bigint")
    words = written(words.join(df.select("term", weight.alias("w")), "term"), "lexical-weights")

    # segments of the first round, then ROUND_GROWTH times as many in each
    rounds = 1 + max(0, math.ceil(math.log(max(1.0, many / FIRST_SEGMENTS), ROUND_GROWTH)))
    shares = [ROUND_GROWTH ** -(rounds - 1 - r) for r in range(rounds)]
    plain = lists.select("segment", "term", "docs", "counts").join(words, "term").select(
        "segment", "block", "term", "w", "items", "docs", "counts", F.lit(None).cast(f"array<{id_type}>").alias("ids"))
    heads = segments.select("segment", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "counts", "ids")
    both = plain.unionByName(heads, allowMissingColumns=True)
    lists_of = "array<struct<a:int,b:int,top:bigint,docs:binary,impacts:binary>>"
    ready = (both.groupBy("segment", "block").applyInArrow(
        lambda table: _prepare(table, n, total),
        f"segment bigint, block int, ids array<{id_type}>, lists {lists_of}, queries array<struct<item:{item_type},terms:array<int>>>")
        .withColumn("round", _round(F.col("segment"), shares)))
    path = new_path(spark, "lexical-impacts")
    ready.write.partitionBy("round").parquet(path)
    ready = spark.read.schema(ready.schema).parquet(path)

    best = None
    top = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    for r in range(rounds):
        now = ready.filter(F.col("round") == r).select("block", "ids", "lists", "queries")
        least = f"array<struct<item:{item_type},least:bigint>>"
        if best is None:
            now = now.withColumn("least", F.lit(None).cast(least))
        else:
            full = best.groupBy("item").agg(F.count(F.lit(1)).alias("c"), F.min("score").alias("least")).filter(F.col("c") >= k)
            full = full.groupBy(block.alias("block")).agg(F.collect_list(F.struct("item", "least")).alias("least"))
            now = now.join(full, "block", "left")
        found = now.select("ids", "lists", "queries", "least").mapInArrow(
            lambda batches: _search(batches, k), f"item {item_type}, id {id_type}, score bigint")
        if best is not None:
            found = found.unionByName(best)
        best = written(found.withColumn("rank", F.row_number().over(top)).filter(F.col("rank") <= k)
                       .select("item", "id", "score", "rank"), "lexical-best").select("item", "id", "score", "rank")
        ranked = best
        best = best.drop("rank")
    return ranked.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_name), "score")


def _prepare(table: pa.Table, n: int, total: int) -> pa.Table:
    """One row: impact lists of the block's terms in a segment, and pair lists."""
    terms = table.column("term").to_pylist()
    head = terms.index(None)
    ids = table.column("ids")[head].values
    size = np.frombuffer(table.column("counts")[head].as_py(), dtype=np.int64)
    m = 100 - B + (B * size * n) // max(total, 1)
    names = table.schema.field("items").type.value_type.field("item").type
    docs, impacts, tops, queries, keys = [], [], [], {}, {}
    # a fixed order: ties between bounds fall alike in every run
    for row in sorted((r for r in range(len(terms)) if r != head), key=terms.__getitem__):
        d = np.frombuffer(table.column("docs")[row].as_py(), dtype=np.uint16)
        tf = np.frombuffer(table.column("counts")[row].as_py(), dtype=np.int32).astype(np.int64)
        impact = (SCALE * TF * tf) // (TF * tf + K1 * m[d]) * table.column("w")[row].as_py()
        for q in table.column("items")[row].as_py():
            queries.setdefault(q["item"], []).append(len(docs))
        docs.append(d)
        impacts.append(impact)
        tops.append(int(impact.max()))
    pairs = set()
    for own in queries.values():
        own.sort(key=lambda t: (-tops[t], t))
        for x in range(len(own)):
            pairs.update((min(own[x], y), max(own[x], y)) for y in own[x + 1:x + 1 + PAIR_REACH])
    a_, b_, top_ = list(range(len(docs))), [-1] * len(docs), list(tops)
    doc_ = [x.tobytes() for x in docs]
    impact_ = [x.tobytes() for x in impacts]
    dense, filled = np.full(len(size), -1, dtype=np.int64), -1
    for a, b in sorted(pairs):
        if a != filled:
            dense[:] = -1
            dense[docs[a]] = impacts[a]
            filled = a
        at = dense[docs[b]]
        both = at >= 0
        a_.append(a)
        b_.append(b)
        top_.append(int((at[both] + impacts[b][both]).max(initial=0)))
        # an intersection no shorter than half of a list saves nothing: its shorter list stands for it
        short = 2 * int(both.sum()) <= min(len(docs[a]), len(docs[b]))
        doc_.append(docs[b][both].tobytes() if short else None)
        impact_.append(None)
    lists = pa.StructArray.from_arrays(
        [pa.array(a_, pa.int32()), pa.array(b_, pa.int32()), pa.array(top_, pa.int64()), pa.array(doc_, pa.binary()),
         pa.array(impact_, pa.binary())], names=["a", "b", "top", "docs", "impacts"])
    one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
    asked = pa.StructArray.from_arrays(
        [pa.array(list(queries), names), pa.array(list(queries.values()), pa.list_(pa.int32()))], names=["item", "terms"])
    return pa.table({"segment": table.column("segment").slice(head, 1), "block": table.column("block").slice(head, 1),
                     "ids": one(ids), "lists": one(lists), "queries": one(asked)})


def _search(batches, k: int):
    """(item, id, score) of the best ``k`` documents of each row's segment, without
    those that cannot be among the best ``k`` of all."""
    for batch in batches:
        for r in range(batch.num_rows):
            ids = batch.column(0)[r].values
            lists = batch.column(1)[r].values
            if len(lists) == 0:
                continue
            a, b, top = (lists.field(c).to_pylist() for c in ("a", "b", "top"))
            docs, impacts = lists.field("docs"), lists.field("impacts")
            single = b.index(next((x for x in b if x >= 0), None)) if any(x >= 0 for x in b) else len(b)
            held = [(np.frombuffer(docs[t].as_py(), np.uint16), np.frombuffer(impacts[t].as_py(), np.int64)) for t in range(single)]
            kth = [int(np.partition(x, len(x) - k)[len(x) - k]) if len(x) >= k else 0 for _, x in held]
            pairs = {}
            for p in range(single, len(b)):
                raw = docs[p].as_py()
                pairs[a[p], b[p]] = (top[p], None if raw is None else np.frombuffer(raw, np.uint16))
            known = {x["item"]: x["least"] for x in batch.column(3)[r].as_py() or ()}
            items, places, scores = [], [], []
            for query in batch.column(2)[r].as_py():
                own = query["terms"]
                least = max([1, known.get(query["item"], 1), *(kth[t] for t in own)])
                d, s = best_of(len(ids), held, top, pairs, own, k, least)
                items += [query["item"]] * len(d)
                places.append(d)
                scores.append(s)
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, batch.schema.field(2).type.value_type.field("item").type),
                 ids.take(pa.array(np.concatenate(places).astype(np.int64))), pa.array(np.concatenate(scores))],
                names=["item", "id", "score"])


def units_of(terms: list[int], top: list[int], pairs: dict) -> list[tuple]:
    """(bound, a, b, joint, common) of disjoint pairs and single terms (b = -1), by
    descending bound: pairs are taken by how much they lower the sum of bounds."""
    saved = []
    for x, a in enumerate(terms):
        for b in terms[x + 1:]:
            pair = pairs.get((a, b) if a < b else (b, a))
            if pair:
                less = top[a] + top[b] - max(top[a], top[b], pair[0])
                if less > 0:
                    saved.append((less, a, b, pair))
    free, units = set(terms), []
    for less, a, b, (joint, common) in sorted(saved, key=lambda x: (-x[0], x[1], x[2])):
        if a in free and b in free:
            free -= {a, b}
            units.append((top[a] + top[b] - less, a, b, joint, common))
    units += [(top[t], t, -1, 0, None) for t in free]
    return sorted(units, key=lambda u: (-u[0], u[1]))


def _found(held: tuple[np.ndarray, np.ndarray], places: np.ndarray) -> np.ndarray:
    """Impacts of a list at ``places``, 0 where it has none."""
    docs, impacts = held
    at = np.minimum(np.searchsorted(docs, places), len(docs) - 1)
    return np.where(docs[at] == places, impacts[at], 0)


def best_of(n_docs: int, held: list, top: list[int], pairs: dict, terms: list[int], k: int, least: int):
    """(places, scores) of the documents of a segment with a score of at least
    ``least`` that may be among its best ``k``, ties at the end included."""
    units = units_of(terms, top, pairs)
    rest = np.cumsum([0, *(u[0] for u in reversed(units))])[::-1].tolist()     # bound of unit j and all behind it
    mark = np.zeros(n_docs, dtype=bool)
    for j, (_, a, b, joint, common) in enumerate(units):
        if rest[j] < least:
            break
        after = rest[j + 1]
        whole = [t for t in ((a, b) if b >= 0 else (a,)) if top[t] + after >= least]
        for t in whole:
            mark[held[t][0]] = True
        if b >= 0 and not whole and joint + after >= least:          # only documents with both can get there
            if common is None:
                common = min(held[a][0], held[b][0], key=len)
            mark[common] = True
    places = np.flatnonzero(mark).astype(np.uint16)
    scores = np.zeros(len(places), dtype=np.int64)
    for j, (_, a, b, joint, _) in enumerate(units):
        if len(places) == 0:
            break
        after = rest[j + 1]
        got = _found(held[a], places)
        scores = scores + got
        if b >= 0:
            partner = np.where(got > 0, np.minimum(top[b], np.maximum(joint - got, 0)), top[b])
            keep = scores + partner + after >= least
            places, scores = places[keep], scores[keep]
            if len(places) == 0:
                break
            scores = scores + _found(held[b], places)
        if len(places) > k:
            least = max(least, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
        keep = scores + after >= least
        places, scores = places[keep], scores[keep]
    return places, scores


def rank_documents(docs: DataFrame, queries: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", query_col: str = "text") -> DataFrame:
    """Index ``docs`` and return the best ``k`` of them for each row of ``queries``:
    ``item_col``, rank (from 1), ``id_col``, score.

    Null and empty texts hold no terms; long texts are indexed whole; repeated rows
    rank on their own, equal scores by ascending id (null last); queries with one id
    are one query; an empty table on either side gives no rows; other columns are not
    read.
    """
    return search(build_index(docs, id_col, text_col), queries, k, item_col, query_col, id_col)
