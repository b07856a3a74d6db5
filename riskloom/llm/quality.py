"""Quality rules: base text rules and a calibrated n-gram classifier (operator 3).

A logistic regression over hashed word uni- and bigrams and character 4-grams is
trained on labelled quality rows (a bounded sample), its score calibrated to a
probability on rows it was not fitted on (Platt's sigmoid), and every whole text
scored in Arrow batches against a fixed threshold. Scoring is numpy over all
texts of a slice at once; no row is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import sample
from riskloom.llm import textbatch as tb

# The rules every text has to meet before the classifier is asked.
MIN_WORDS = 50
MAX_REPEAT_SHARE = 0.5
SYMBOLS = b"#*$%&|<>"

#: A text is kept if its calibrated probability of good quality reaches this.
THRESHOLD = 0.1
#: Labelled rows of each class that the model is fitted on at most.
TRAIN_ROWS_PER_CLASS = 1200
#: One of so many training rows is kept for the calibration.
CALIBRATION_SHARE = 4
BUCKET_BITS = 18
FAMILIES = 3                       # word unigrams, word bigrams, character 4-grams
EPOCHS = 90
L2 = 1e-6

_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[list(SYMBOLS)] = True


@dataclass
class Model:
    weights: np.ndarray            # float32, FAMILIES x buckets
    bias: float
    slope: float = 1.0             # calibration: p = sigmoid(slope * score + shift)
    shift: float = 0.0

    def probability(self, score: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * score + self.shift, -50, 50)))


@dataclass
class Words:
    data: np.ndarray
    offs: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    code: np.ndarray               # exact code of each word within the slice
    hash: np.ndarray

    @classmethod
    def of(cls, column: pa.Array) -> "Words":
        data, offs = tb.text_bytes(column)
        s, e, d = tb.word_spans(data, offs)
        if len(s) == 0:
            return cls(data, offs, s, e, d, s, s.astype(np.uint64))
        code, distinct = tb.spans_to_ids(data, s, e)
        h = np.fromiter(map(tb.xxhash.xxh3_64_intdigest, tb.byte_strings(distinct)), np.uint64, len(distinct))
        return cls(data, offs, s, e, d, code, h[code])


def repeated_words(w: Words, n: int) -> np.ndarray:
    """Words of each document in 3-word windows that occur twice or more in it.

    Windows are sorted by a hash; neighbours count as equal only if document and
    words are equal, and a hash shared by unequal windows sorts by the words too.
    """
    m = len(w.code) - 2
    if m <= 0:
        return np.zeros(n, np.int64)
    pos = np.flatnonzero(w.doc[:m] == w.doc[2:])
    if len(pos) == 0:
        return np.zeros(n, np.int64)
    keys = (w.doc[pos], w.code[pos], w.code[pos + 1], w.code[pos + 2])
    h = tb.mix(tb.mix(tb.mix(keys[0].astype(np.uint64) + tb.MIX_A) + keys[1].astype(np.uint64))
               + keys[2].astype(np.uint64)) + keys[3].astype(np.uint64) * tb.MIX_B

    def runs(order):
        same = np.ones(len(order) - 1, dtype=bool)
        for k in keys:
            same &= k[order[1:]] == k[order[:-1]]
        return same

    order = np.argsort(h)
    same = runs(order)
    if (same != (h[order[1:]] == h[order[:-1]])).any():
        order = np.lexsort(keys[::-1])
        same = runs(order)
    twice = np.zeros(len(order), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    hit = np.zeros(len(w.code), dtype=bool)
    at = pos[order[twice]]
    hit[at], hit[at + 1], hit[at + 2] = True, True, True
    return tb.per_doc(hit, w.doc, n)


def duplicate_lines(w: Words, n: int) -> np.ndarray:
    """Lines of each document with a word that equal an earlier line of it."""
    if len(w.start) == 0:
        return np.zeros(n, np.int64)
    data, offs = w.data, w.offs
    newline = np.flatnonzero(data == 0x0A)
    starts = np.unique(np.concatenate([offs[:-1][np.diff(offs) > 0], newline + 1]))
    starts = starts[starts < len(data)]
    stop = np.zeros(len(data) + 1, dtype=bool)
    stop[newline] = True
    stop[offs] = True
    stops = np.flatnonzero(stop)
    ends = stops[np.searchsorted(stops, starts, side="left")]
    # an end equal to the start is an empty line, or a document's first byte
    empty = ends == starts
    is_doc_start = np.zeros(len(data) + 1, dtype=bool)
    is_doc_start[offs] = True
    fix = empty & is_doc_start[starts] & (data[starts] != 0x0A)
    ends[fix] = stops[np.searchsorted(stops, starts[fix], side="right")]
    has_word = np.searchsorted(w.start, ends) > np.searchsorted(w.start, starts)
    starts, ends = starts[has_word], ends[has_word]
    code, distinct = tb.spans_to_ids(data, starts, ends)
    doc = np.searchsorted(offs, starts, side="right") - 1
    lines = np.bincount(doc, minlength=n)
    firsts = np.unique(doc * len(distinct) + code) // max(1, len(distinct))
    return lines - np.bincount(firsts, minlength=n)


def base_columns(w: Words, n: int) -> dict[str, np.ndarray]:
    per = np.diff(w.offs)
    starts_char = (w.data & 0xC0) != 0x80
    chars = np.concatenate([[0], np.cumsum(starts_char)])
    symbols = np.concatenate([[0], np.cumsum(_IS_SYMBOL[w.data])])
    return {
        "n_words": np.bincount(w.doc, minlength=n).astype(np.int64) if len(w.doc) else np.zeros(n, np.int64),
        "word_chars": tb.per_doc(chars[w.end] - chars[w.start], w.doc, n),
        "n_symbols": (symbols[w.offs[1:]] - symbols[w.offs[:-1]]).astype(np.int64) if len(per) else per,
        "n_dup_lines": duplicate_lines(w, n).astype(np.int64),
        "n_repeat_words": repeated_words(w, n),
    }


def characters(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of each character as one number, its document)."""
    lead = np.flatnonzero((w.data & 0xC0) != 0x80)
    doc = np.repeat(np.arange(len(w.offs) - 1), np.diff(w.offs))[lead]
    width = np.diff(np.append(lead, len(w.data)))
    char = w.data[lead].astype(np.uint64)
    for k in (1, 2, 3):
        more = np.flatnonzero(width > k)
        char[more] |= w.data[lead[more] + k].astype(np.uint64) << np.uint64(8 * k)
    return char, doc


def features(w: Words, bits: int = BUCKET_BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """(document, bucket) of every occurrence, one pair of arrays per family."""
    shift = np.uint64(64 - bits)
    out = [(w.doc, (tb.mix(w.hash) >> shift).astype(np.int64))]
    h2, pos = tb.shingle_hashes(w.hash, w.doc, 2)
    out.append((w.doc[pos], (h2 >> shift).astype(np.int64)))
    char, doc = characters(w)
    n = max(0, len(char) - 3)
    gram = np.zeros(n, np.uint64)
    for k in range(4):
        gram = tb.mix(gram + char[k:k + n]) if k else gram + char[:n]
    inside = doc[:n] == doc[3:]
    out.append((doc[:n][inside], (tb.mix(gram[inside]) >> shift).astype(np.int64)))
    return out


def scores(model: Model, w: Words, n: int) -> np.ndarray:
    """Bias plus, for each family, the mean weight of the text's occurrences."""
    total = np.full(n, model.bias)
    for k, (doc, bucket) in enumerate(features(w)):
        if len(doc):
            s = np.bincount(doc, weights=model.weights[k][bucket], minlength=n)
            total += s / np.maximum(1, np.bincount(doc, minlength=n))
    return total


def fit_arrays(rows: np.ndarray, cols: np.ndarray, vals: np.ndarray, y: np.ndarray, held: np.ndarray,
               epochs: int = EPOCHS) -> Model:
    """Full-batch logistic regression by Adam on the rows outside ``held``, then
    Platt's sigmoid on the rows in it. ``cols`` counts through all families."""
    size = FAMILIES << BUCKET_BITS
    used = np.flatnonzero(np.bincount(cols, minlength=size))
    place = np.zeros(size, dtype=np.int32)
    place[used] = np.arange(len(used), dtype=np.int32)
    cols = place[cols]
    fit = ~held
    if y[fit].size == 0 or y[fit].min() == y[fit].max():
        p = float(np.clip(y.mean() if y.size else 1.0, 0.01, 0.99))    # one class only: a constant
        return Model(np.zeros((FAMILIES, 1 << BUCKET_BITS), np.float32), float(np.log(p / (1 - p))))
    wt = np.where(y == 1, 0.5 / max(1, (y[fit] == 1).sum()), 0.5 / max(1, (y[fit] == 0).sum())) * fit
    x, b = np.zeros(len(used)), 0.0
    m, v, mb, vb = np.zeros_like(x), np.zeros_like(x), 0.0, 0.0
    for t in range(1, epochs + 1):
        z = np.bincount(rows, weights=vals * x[cols], minlength=len(y)) + b
        g = wt * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y)
        gx, gb = np.bincount(cols, weights=vals * g[rows], minlength=len(x)) + L2 * x, g.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * gx, 0.99 * v + 0.01 * gx * gx, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        c1, c2 = 1 - 0.9 ** t, 1 - 0.99 ** t
        x -= 1.0 * (m / c1) / (np.sqrt(v / c2) + 1e-10)
        b -= 0.05 * (mb / c1) / (np.sqrt(vb / c2) + 1e-10)
    weights = np.zeros(size, np.float32)
    weights[used] = x
    model = Model(weights.reshape(FAMILIES, -1), float(b))
    z = (np.bincount(rows, weights=vals * x[cols], minlength=len(y)) + b)[held]
    t = y[held].astype(float)
    if t.size and 0 < t.sum() < t.size:
        n1, n0 = t.sum(), t.size - t.sum()
        target = np.where(t == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        a, c = 1.0, 0.0
        for _ in range(50):                                    # Newton steps of the two-parameter fit
            p = 1 / (1 + np.exp(-np.clip(a * z + c, -50, 50)))
            r, s = p - target, np.maximum(p * (1 - p), 1e-9)
            h = np.array([[(s * z * z).sum() + 1e-6, (s * z).sum()], [(s * z).sum(), s.sum() + 1e-6]])
            step = np.linalg.solve(h, np.array([(r * z).sum(), r.sum()]))
            a, c = a - np.clip(step[0], -1, 1), c - np.clip(step[1], -1, 1)
        if a > 0:
            model.slope, model.shift = float(a), float(c)
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", rows_per_class: int = TRAIN_ROWS_PER_CLASS, seed: int = 7) -> Model:
    """Fit on at most ``rows_per_class`` labelled rows of each class.

    Null ids, labels and texts take no part; an id labelled more than once takes
    its smallest label. Without labelled rows the model is a constant that keeps.
    The driver receives hashed counts of the sampled rows, never whole texts.
    """
    lab = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
           .filter("id is not null and y is not null").groupBy("id").agg(F.min("y").alias("y")))
    chosen = sample.per_label(lab, "id", "y", rows_per_class, seed)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text is not null").join(
        F.broadcast(chosen), "id")                             # at most two classes of rows_per_class ids

    def count(batches):
        for batch in batches:
            for part in tb.slices(batch, "text"):
                w, n = Words.of(part.column(1)), part.num_rows
                cols, vals = [[] for _ in range(n)], [[] for _ in range(n)]
                for k, (doc, bucket) in enumerate(features(w)):
                    key, cnt = np.unique((doc << BUCKET_BITS) + bucket, return_counts=True)
                    d = key >> BUCKET_BITS
                    per = np.bincount(doc, minlength=n)
                    val = (cnt / np.maximum(1, per[d])).astype(np.float32)
                    at = np.searchsorted(d, np.arange(n + 1))
                    col = ((key & ((1 << BUCKET_BITS) - 1)) + (k << BUCKET_BITS)).astype(np.int32)
                    for i in range(n):
                        cols[i].append(col[at[i]:at[i + 1]])
                        vals[i].append(val[at[i]:at[i + 1]])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2),
                     pa.array([np.concatenate(x).tobytes() for x in cols], pa.binary()),
                     pa.array([np.concatenate(x).tobytes() for x in vals], pa.binary())],
                    names=["id", "y", "cols", "vals"])

    id_type = rows.schema["id"].dataType.simpleString()
    got = sorted(rows.mapInArrow(count, f"id {id_type}, y int, cols binary, vals binary").collect(),
                 key=lambda r: (r["id"], r["cols"]))
    if not got:
        return Model(np.zeros((FAMILIES, 1 << BUCKET_BITS), np.float32), 5.0)
    y = np.array([r["y"] for r in got])
    row = np.repeat(np.arange(len(got), dtype=np.int32), [len(r["cols"]) // 4 for r in got])
    cols = np.frombuffer(b"".join(r["cols"] for r in got), np.int32)
    vals = np.frombuffer(b"".join(r["vals"] for r in got), np.float32)
    del got
    return fit_arrays(row, cols, vals, y, np.arange(len(y)) % CALIBRATION_SHARE == 0)


def apply_rules(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                threshold: float = THRESHOLD) -> DataFrame:
    """Rule columns and verdict of every whole text.

    One row per row of ``docs``: its own columns other than ``text_col`` are not
    read but for the id. A null or empty text has no words and fails the base
    rules; null and repeated ids are carried, each row for itself; an empty table
    gives no rows. ``kept`` is false if the base rules fail, else whether the
    calibrated ``quality_probability`` reaches ``threshold`` (a tie is kept).
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)               # FAMILIES x 2^BUCKET_BITS floats, 3 MB
    id_type = docs.schema[id_col].dataType.simpleString()
    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    schema = (f"id {id_type}, " + ", ".join(f"{c} bigint" for c in longs)
              + ", base_failed boolean, kept boolean, quality_probability double")

    def run(batches):
        mod = shared.value
        for batch in batches:
            for part in tb.slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column(0), *verdict(part.column(1), mod, threshold)],
                                                 names=["id", *longs, "base_failed", "kept", "quality_probability"])

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, schema).withColumnRenamed("id", id_col))


def filter_documents(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that ``apply_rules`` would keep."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        mod = shared.value
        for batch in batches:
            for part in tb.slices(batch, text_col):
                yield part.filter(verdict(part.column(at), mod, threshold)[-2])

    return docs.mapInArrow(run, docs.schema)


def verdict(texts: pa.Array, model: Model, threshold: float) -> list[pa.Array]:
    """Rule columns, base_failed, kept and probability of a slice of texts."""
    n = len(texts)
    w = Words.of(texts)
    base = base_columns(w, n)
    failed = (base["n_words"] < MIN_WORDS) | (base["n_repeat_words"] > MAX_REPEAT_SHARE * base["n_words"])
    p = model.probability(scores(model, w, n))
    return [*(pa.array(v, pa.int64()) for v in base.values()), pa.array(failed),
            pa.array(~failed & (p >= threshold)), pa.array(p, pa.float64())]
