"""Token counts of a unigram vocabulary by a count-only Viterbi pass (operator 2).

An Aho-Corasick automaton enumerates the vocabulary's matches; dynamic programming
carries the best score and the piece count of each position, for as many positions
back as the longest piece. Ties follow the ``tokenizers`` unigram model: a later
start must score strictly more, so the longest last piece wins; a character
without a piece of its own costs the lowest score less 10. A run of unknown
characters (and unknown pieces, the first of the vocabulary) counts as its bytes
(byte fallback) or, without byte pieces, as one token.

A piece holds the word mark only at its front, so no piece crosses the start of a
run of spaces and the best segmentation is that of its space-led chunks. Equal
chunks of a batch are counted once.
"""

from __future__ import annotations

import functools

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import textbatch as tb

MARK = "▁"
UNKNOWN_PENALTY = 10.0             # fixed value of the tokenizer
CACHE_CHUNKS = 1_000_000
SLICE_BYTES = 4 << 20


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file, by id."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())]


class Counter:
    def __init__(self, pieces: list[tuple[str, float]]):
        self.auto = ahocorasick.Automaton()
        self.unk_piece = pieces[0][0] if pieces else ""
        for piece, score in pieces:
            if piece:
                self.auto.add_word(piece, (len(piece), float(score), piece == self.unk_piece))
        self.auto.make_automaton()
        names = {p for p, _ in pieces}
        self.longest = max((len(p) for p in names), default=1)
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.byte_pieces = all(f"<0x{b:02X}>" in names for b in range(256))
        self.chunked = not any(MARK in p.lstrip(MARK) for p in names)
        self.cache: dict[bytes, int] = {}

    def count(self, text: str) -> int:
        """Pieces of the best segmentation of an already marked text."""
        ring = self.longest + 1
        best, pieces = [0.0] * ring, [0] * ring
        run, cost = [0] * ring, [0] * ring                     # bytes and tokens of the unknown run that ends here
        found = self.auto.iter(text)
        nxt = next(found, None)
        for end in range(1, len(text) + 1):
            top, back, unknown, single = None, 0, False, False
            while nxt is not None and nxt[0] == end - 1:       # the longest match first
                length, score, is_unk = nxt[1]
                value = best[(end - length) % ring] + score
                if top is None or value > top:
                    top, back, unknown = value, length, is_unk
                single = single or length == 1
                nxt = next(found, None)
            if not single:
                value = best[(end - 1) % ring] + self.unknown
                if top is None or value > top:
                    top, back, unknown = value, 1, True
            at, to = (end - back) % ring, end % ring
            if unknown:
                size = run[at] + len(text[end - back:end].encode())
                named = run[at] == 0 and text[end - back:end] == self.unk_piece
                n = 1 if named or not self.byte_pieces else size
                best[to], pieces[to], run[to], cost[to] = top, pieces[at] - cost[at] + n, size, n
            else:
                best[to], pieces[to], run[to], cost[to] = top, pieces[at] + 1, 0, 0
        return pieces[len(text) % ring]

    def count_batch(self, column: pa.Array) -> np.ndarray:
        """Number of tokens of every text of a batch."""
        col = column.cast(pa.large_binary())
        col = pc.fill_null(col, b"")
        lead = pc.if_else(pc.equal(pc.binary_length(col), 0), pa.scalar(b"", pa.large_binary()),
                          pa.scalar(b" ", pa.large_binary()))
        data, offs = tb.text_bytes(pc.binary_join_element_wise(lead, col, pa.scalar(b"", pa.large_binary())))
        n = len(offs) - 1
        if len(data) == 0:
            return np.zeros(max(n, 0), np.int64)
        start = np.zeros(len(data) + 1, dtype=bool)
        if self.chunked:
            start[1:-1] = (data[1:] == 0x20) & (data[:-1] != 0x20)
            # a literal mark before the space belongs to the same run
            mark = np.frombuffer(MARK.encode(), np.uint8)
            lit = np.flatnonzero((data[:-3] == mark[0]) & (data[1:-2] == mark[1]) & (data[2:-1] == mark[2])) if len(data) > 3 else []
            start[np.asarray(lit, dtype=np.int64) + 3] = False
        start[offs] = True
        bounds = np.flatnonzero(start)
        enc = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(bounds) - 1,
            [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        chunks = tb.byte_strings(enc.dictionary)
        if len(self.cache) > CACHE_CHUNKS:
            self.cache.clear()
        for c in chunks:
            if c not in self.cache:
                self.cache[c] = self.count(c.decode("utf-8", "replace").replace(" ", MARK))
        counts = np.fromiter(map(self.cache.__getitem__, chunks), np.int64, len(chunks))
        total = np.concatenate([[0], np.cumsum(counts[enc.indices.to_numpy(zero_copy_only=False)])])
        return np.diff(total[np.searchsorted(bounds, offs)])


@functools.lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(vocabulary(path))


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens of every whole text: ``id_col``, n_tokens, n_bytes.

    A null or empty text has none. Null and repeated ids are carried, each row for
    itself; an empty table gives no rows; other columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        c = counter(model_path)
        for batch in batches:
            for part in tb.slices(batch, "text", SLICE_BYTES):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(c.count_batch(part.column(1)), pa.int64()),
                     pa.array(np.diff(tb.text_bytes(part.column(1))[1]), pa.int64())], names=["id", "n_tokens", "n_bytes"])

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"id {id_type}, n_tokens bigint, n_bytes bigint").withColumnRenamed("id", id_col))
