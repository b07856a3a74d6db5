"""Language identification by a byte convolutional network (operator 9).

Bytes are embedded, convolved with filters of several widths, max-pooled over a
fixed-length window and classified by softmax. The network is trained in numpy
on windows of a bounded sample of labelled texts. A text is cut into windows
that cover all of it; its prediction is the mean of its windows' probabilities.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import sample
from riskloom.llm import textbatch as tb

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8                        # of each width
EMBED = 4
#: Training bound: texts of each language, and windows of each text.
TRAIN_TEXTS = 400
TRAIN_WINDOWS = 4
EPOCHS = 25
BATCH = 64
RATE = 0.01
#: Least mean probability of a text that a filter keeps.
MIN_SCORE = 0.4
#: Windows classified at once in a task.
WINDOWS_AT_ONCE = 256
UNDETERMINED = "und"

_LETTER = regex.compile(r"\p{L}")


@dataclass
class Network:
    langs: list[str]
    embed: np.ndarray              # 256 x EMBED
    conv: np.ndarray               # (widest * EMBED) x (FILTERS * widths), zero beyond a filter's width
    conv_bias: np.ndarray
    out: np.ndarray                # filters x languages
    out_bias: np.ndarray

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(maxima, their positions, unfolded input) of windows of bytes."""
        n, length = windows.shape
        widest = max(WIDTHS)
        x = np.ascontiguousarray(self.embed[windows])                      # n x length x EMBED
        steps = length - widest + 1
        unfolded = np.lib.stride_tricks.as_strided(
            x, (n, steps, widest * EMBED), (x.strides[0], x.strides[1], x.strides[2])).reshape(n * steps, -1)
        z = (unfolded @ self.conv).reshape(n, steps, -1)
        return z, unfolded, x

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        z = self.pooled(windows)[0].max(axis=1) + self.conv_bias
        return softmax(np.maximum(z, 0) @ self.out + self.out_bias)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def filter_mask() -> np.ndarray:
    """Which inputs of the widest window each filter sees."""
    rows = np.repeat(np.arange(max(WIDTHS)), EMBED)[:, None]
    return (rows < np.repeat(WIDTHS, FILTERS)[None, :]).astype(np.float32)


def fit(windows: np.ndarray, y: np.ndarray, langs: list[str], seed: int = 3, epochs: int = EPOCHS) -> Network:
    """Adam on the cross entropy, each language weighing the same."""
    rng = np.random.default_rng(seed)
    mask, nf = filter_mask(), FILTERS * len(WIDTHS)
    p = {"embed": rng.normal(0, 0.5, (256, EMBED)), "conv": rng.normal(0, 0.3, mask.shape) * mask,
         "conv_bias": np.zeros(nf), "out": rng.normal(0, 0.3, (nf, len(langs))), "out_bias": np.zeros(len(langs))}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v2 = {k: np.zeros_like(v) for k, v in p.items()}
    weight = (len(y) / (len(langs) * np.maximum(1, np.bincount(y, minlength=len(langs))))).astype(np.float32)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for i in range(0, len(order), BATCH):
            at = order[i:i + BATCH]
            w, t = windows[at], y[at]
            net = Network(langs, **p)
            z, unfolded, _ = net.pooled(w)
            best = z.argmax(axis=1)                                        # batch x filters
            top = np.take_along_axis(z, best[:, None, :], axis=1)[:, 0] + p["conv_bias"]
            act = np.maximum(top, 0)
            prob = softmax(act @ p["out"] + p["out_bias"])
            d = prob
            d[np.arange(len(t)), t] -= 1
            d *= (weight[t] / len(t))[:, None]
            da = (d @ p["out"].T) * (top > 0)
            rows = (np.arange(len(t))[:, None] * z.shape[1] + best)        # unfolded row of each maximum
            seen = unfolded[rows]                                          # batch x filters x inputs
            dconv = np.einsum("bfi,bf->if", seen, da) * mask
            dx = np.einsum("if,bf->bfi", p["conv"], da).reshape(-1, EMBED)
            byte = np.take_along_axis(w[:, None, :], best[:, :, None] + np.arange(max(WIDTHS)), axis=2).ravel()
            dembed = np.zeros_like(p["embed"])
            np.add.at(dembed, byte, dx)
            grads = {"embed": dembed, "conv": dconv, "conv_bias": da.sum(0), "out": act.T @ d, "out_bias": d.sum(0)}
            step += 1
            for k, g in grads.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v2[k] = 0.999 * v2[k] + 0.001 * g * g
                p[k] = p[k] - RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v2[k] / (1 - 0.999 ** step)) + 1e-8)
    return Network(langs, **{k: v.astype(np.float32) for k, v in p.items()})


def window_starts(offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of the windows that cover each document; the last
    window of a longer document is moved back to be full."""
    size = np.diff(offs)
    count = -(-size // WINDOW)
    doc = np.repeat(np.arange(len(size)), count)
    k = tb.ragged(np.zeros(len(size), np.int64), count)
    start = np.minimum(offs[doc] + k * WINDOW, np.maximum(offs[doc], offs[doc + 1] - WINDOW))
    return start, np.minimum(start + WINDOW, offs[doc + 1]), doc


def window_matrix(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Windows of bytes, zero beyond the end of a short text."""
    at = start[:, None] + np.arange(WINDOW)
    inside = at < end[:, None]
    return np.where(inside, data[np.minimum(at, len(data) - 1)], 0).astype(np.uint8)


def classify(texts: pa.Array, net: Network) -> tuple[np.ndarray, np.ndarray]:
    """(mean probabilities of each text, whether it has a letter)."""
    data, offs = tb.text_bytes(texts)
    n = len(offs) - 1
    start, end, doc = window_starts(offs)
    sums = np.zeros((n, len(net.langs)))
    for i in range(0, len(start), WINDOWS_AT_ONCE):
        s = slice(i, i + WINDOWS_AT_ONCE)
        np.add.at(sums, doc[s], net.probabilities(window_matrix(data, start[s], end[s])))
    letter = np.array([t is not None and _LETTER.search(t) is not None for t in texts.to_pylist()], dtype=bool)
    return sums / np.maximum(1, np.bincount(doc, minlength=n))[:, None], letter


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          texts_per_lang: int = TRAIN_TEXTS, seed: int = 11) -> Network:
    """Fit on at most ``texts_per_lang`` texts of each language and
    ``TRAIN_WINDOWS`` windows of each; the driver receives those windows only.

    Takes the rows of ``docs`` that are given (the caller holds out others);
    rows with a null language or text, or without a letter, take no part.
    Without any row the network knows no language and predicts ``und``.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    src = src.filter(F.col("text").rlike(r"\p{L}"))
    chosen = sample.per_label(src, "id", "lang", texts_per_lang, seed)

    def cut(batches):
        for batch in batches:
            for part in tb.slices(batch, "text"):
                data, offs = tb.text_bytes(part.column(1))
                start, end, doc = window_starts(offs)
                first = np.searchsorted(doc, np.arange(len(offs) - 1))
                count = np.bincount(doc, minlength=len(offs) - 1)
                take = np.minimum(count, TRAIN_WINDOWS)
                k = tb.ragged(np.zeros(len(take), np.int64), take)
                pick = np.repeat(first, take) + k * np.repeat(count, take) // np.repeat(np.maximum(1, take), take)
                mat = window_matrix(data, start[pick], end[pick])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(doc[pick])), pa.array([r.tobytes() for r in mat], pa.binary())],
                    names=["lang", "window"])

    got = sorted((r["lang"], bytes(r["window"])) for r in
                 chosen.select("lang", "text").mapInArrow(cut, "lang string, window binary").collect())
    langs = sorted({g[0] for g in got})
    if not got:
        return Network([], *(np.zeros((1, 1), np.float32),) * 5)
    windows = np.frombuffer(b"".join(g[1] for g in got), np.uint8).reshape(-1, WINDOW)
    return fit(windows, np.array([langs.index(g[0]) for g in got]), langs)


def predict(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Language of every whole text: ``id_col``, lang_pred, score.

    A null text or one without a letter is ``und`` with score 0. Null and repeated
    ids are carried, each row for itself; ties go to the language first in the
    alphabet; an empty table gives no rows; no other column is read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)     # some thousand floats
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        model = shared.value
        for batch in batches:
            for part in tb.slices(batch, "text"):
                if model.langs:
                    p, letter = classify(part.column(1), model)
                    best = p.argmax(axis=1)
                    lang = np.where(letter, np.array(model.langs, dtype=object)[best], UNDETERMINED)
                    score = np.where(letter, np.minimum(p[np.arange(len(best)), best], 1.0), 0.0)
                else:
                    lang, score = [UNDETERMINED] * part.num_rows, np.zeros(part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(lang), pa.string()),
                                                  pa.array(score, pa.float64())], names=["id", "lang_pred", "score"])

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"id {id_type}, lang_pred string, score double").withColumnRenamed("id", id_col))


def filter_documents(docs: DataFrame, net: Network, text_col: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language with at least
    ``min_score``; null texts and texts without a letter go."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    at = docs.columns.index(text_col)

    def run(batches):
        model = shared.value
        for batch in batches:
            for part in tb.slices(batch, text_col):
                if model.langs:
                    p, letter = classify(part.column(at), model)
                    yield part.filter(pa.array(letter & (p.max(axis=1) >= min_score)))

    return docs.mapInArrow(run, docs.schema)


def held_out(id_col: str = "doc_id"):
    """Rows that no model learns from: crc32 of the id as text is 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
