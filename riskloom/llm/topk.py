"""Exact k nearest binary codes by incremental multi-index hashing (operator 1).

Distinct codes are dealt into blocks, and so are the queries; a task answers a
block of queries on a block of codes, and the best of all blocks are merged. In a
block, a code is cut into segments of about log2(n) bits, each with a table of
the codes by value. Radius by radius, a query looks up the segment values at
exactly that distance from its own and verifies the full Hamming distance of what
it finds. After radius r in the first a segments and r - 1 in the others, a code
not met yet is at distance m*r + a or more, so the query is done once its k-th
verified distance is smaller. Only codes that can be among the k nearest of their
block come out as rows.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.store import written
from riskloom.llm.textbatch import ragged

K = 10
MIN_SEGMENT, MAX_SEGMENT = 8, 16
WORD = 63                          # bits of a code in one long
#: Distinct codes and distinct queries that one task holds, on average.
CODES_PER_TASK, QUERIES_PER_TASK = 16_384, 4_096
#: Rows with one code are spread over so many partial aggregates.
SALTS = 32


def sign_code(vector: Column, bits: int) -> Column:
    """Binary code of a vector, 63 bits a word: bit i is set if element i is above 0."""
    words = []
    for at in range(0, bits, 63):
        w = F.lit(0).cast("bigint")
        for j in range(min(63, bits - at)):
            w = w.bitwiseOR(F.when(F.get(vector, F.lit(at + j)) > 0, F.lit(1 << j).cast("bigint"))
                            .otherwise(F.lit(0).cast("bigint")))
        words.append(w)
    return F.array(*words)


def _flips(width: int, radius: int) -> np.ndarray:
    """All masks of ``width`` bits with ``radius`` of them set."""
    return np.array([sum(1 << b for b in c) for c in itertools.combinations(range(width), radius)] or [0], dtype=np.int64)


def _segment(words: np.ndarray, start: int, width: int) -> np.ndarray:
    """Bits ``start .. start + width`` of codes of 63-bit words; a segment may span two."""
    w, off = divmod(start, WORD)
    value = words[:, w] >> off
    if off + width > WORD:
        value = value | (words[:, w + 1] << (WORD - off))
    return value & ((1 << width) - 1)


class Index:
    """Multi-index of a block of distinct codes."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, bits: int):
        self.words, self.counts, self.bits = words, counts, bits
        width = min(MAX_SEGMENT, max(MIN_SEGMENT, round(math.log2(max(2, len(words))))), bits)
        self.m = -(-bits // width)
        self.spans = [(s * bits // self.m, (s + 1) * bits // self.m) for s in range(self.m)]
        self.tables = []
        for a, b in self.spans:
            value = _segment(words, a, b - a)
            order = np.argsort(value, kind="stable")
            self.tables.append((order, np.searchsorted(value[order], np.arange((1 << (b - a)) + 1))))
        self.flips = {b - a: {} for a, b in self.spans}

    def near(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(codes, distances) of all codes no farther than the ``k``-th nearest row."""
        dist = np.full(len(self.words), -1, dtype=np.int64)
        rows = np.zeros(self.bits + 1)
        own = [int(_segment(query[None, :], a, b - a)[0]) for a, b in self.spans]
        kth = self.bits + 1                                    # distance of the k-th row found so far
        for radius in range(max(b - a for a, b in self.spans) + 1):
            for s, (a, b) in enumerate(self.spans):
                # a code first met here and now differs by radius + 1 or more in the segments before
                # this one and by radius or more in the others
                if kth < self.m * radius + s:
                    break
                if radius > b - a:
                    continue
                known = self.flips[b - a]
                if radius not in known:
                    known[radius] = _flips(b - a, radius)
                order, at = self.tables[s]
                value = own[s] ^ known[radius]
                met = order[ragged(at[value], at[value + 1] - at[value])]
                met = met[dist[met] < 0]
                if len(met):
                    d = np.bitwise_count(self.words[met] ^ query).sum(axis=1).astype(np.int64)
                    dist[met] = d
                    rows += np.bincount(d, weights=self.counts[met], minlength=self.bits + 1)
                    full = np.flatnonzero(np.cumsum(rows) >= k)
                    kth = int(full[0]) if len(full) else self.bits + 1
            if kth < self.m * (radius + 1):
                break
        hit = np.flatnonzero((dist >= 0) & (dist <= kth))
        return hit, dist[hit]


def search(vectors: DataFrame, queries: DataFrame, bits: int, k: int = K, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """The ``k`` rows of ``vectors`` nearest to each row of ``queries`` in Hamming
    distance of sign codes: query_id, neighbour_id, distance, rank (from 1).

    Exact; ties go to the smaller id (a null id last). A query that is itself a
    row finds itself. Rows with a null vector, or with fewer than ``bits``
    elements, are no codes and find nothing; elements beyond ``bits`` and null
    elements count as 0. Repeated rows are rows of their own; queries with one id
    and code are answered once. With fewer than ``k`` codes all are returned; empty
    tables give no rows. Other columns are not read.
    """
    def coded(df):
        has = F.col(vector_col).isNotNull() & (F.size(vector_col) >= bits)
        return df.filter(has).select(F.col(id_col).alias("id"), sign_code(F.col(vector_col), bits).alias("code"))

    # the k smallest ids of every distinct code; a hot code is thinned in salted parts first
    w_salt = Window.partitionBy("code", "salt").orderBy(F.asc_nulls_last("id"))
    first = (coded(vectors).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
             .withColumn("n", F.row_number().over(w_salt)).filter(F.col("n") <= k))
    w_code = Window.partitionBy("code").orderBy(F.asc_nulls_last("id"))
    members = written(first.withColumn("n", F.row_number().over(w_code)).filter(F.col("n") <= k).select("code", "id"), "mih-codes")
    codes = members.groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    asked = written(coded(queries).distinct(), "mih-queries")
    wanted = asked.select(F.col("code").alias("q")).distinct()
    parts = max(1, -(-codes.count() // CODES_PER_TASK))
    blocks = max(1, -(-wanted.count() // QUERIES_PER_TASK))
    mine = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = codes.select("code", "n", mine("code", parts).alias("p"), every(blocks).alias("b"))
    right = wanted.select("q", mine("q", blocks).alias("b"), every(parts).alias("p"))

    def answer(some: pa.Table, ask: pa.Table) -> pa.Table:
        out_q, out_c, out_d = [], [], []
        if some.num_rows and ask.num_rows:
            words = np.array(some.column("code").to_pylist(), dtype=np.int64)
            q_words = np.array(ask.column("q").to_pylist(), dtype=np.int64)
            index = Index(words, some.column("n").to_numpy(), bits)
            for q in q_words:
                hit, d = index.near(q, k)
                out_q += [q] * len(hit)
                out_c += list(words[hit])
                out_d += d.tolist()
        kind = pa.list_(pa.int64())
        return pa.table({"q": pa.array(out_q, kind), "code": pa.array(out_c, kind), "distance": pa.array(out_d, pa.int32())})

    found = left.groupBy("p", "b").cogroup(right.groupBy("p", "b")).applyInArrow(
        answer, "q array<bigint>, code array<bigint>, distance int")
    order = Window.partitionBy("q").orderBy("distance", F.asc_nulls_last("id"))
    top = (found.join(members, "code").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
           .select("q", F.col("id").alias("neighbour_id"), "distance", "rank"))
    return asked.select(F.col("id").alias("query_id"), F.col("code").alias("q")).join(top, "q").drop("q")
