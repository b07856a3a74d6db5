"""Best-fit packing of tokenized documents into fixed-length sequences (operator 4).

Bounded-space online best-fit: each task streams its pieces past a fixed number
of open bins. A bitset, an integer whose bit ``f`` says that some open bin has
``f`` free places, finds the fullest bin that still takes a piece with two bit
operations; when the bins run out, the fullest is closed first.

The task that tokenizes packs first. What is in the bins still open at its end,
a bounded number of pieces, is packed again together with that of other tasks:
in rounds over ever fewer tasks, until one task closes the last bins. These pieces
come in windows of about twice the open bins, chosen by hash, each longest first. So the number of sequences doesn't grow with the number of tasks, only
the pieces of open bins are shuffled, and memory is bounded by the open bins.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import bpe
from riskloom.llm import textbatch as tb
from riskloom.llm.store import written

CAPACITY = 2048
OPEN_BINS = 512
END_ID = 0
#: Pieces of open bins that one task packs again, on average; each round has at most
#: half the tasks of the one before.
MERGE_PIECES = 1 << 18
#: Sequence numbers: round, task and the task's own count.
_ROUND_BITS, _TASK_BITS = 58, 34


class BestFit:
    """Open bins of one task; ``put`` gives (sequence number, offset). ``closed`` has
    the numbers of the bins that take no more, until the caller empties it."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS):
        self.capacity, self.limit = capacity, open_bins
        self.free_bits = 0                                     # bit f: some open bin has f free places
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.n_open = self.n_bins = 0
        self.closed: list[int] = []

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        b = bins.pop()
        if not bins:
            self.free_bits &= ~(1 << free)
        self.n_open -= 1
        return b

    def put(self, length: int) -> tuple[int, int]:
        fits = self.free_bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1    # the fullest bin that takes it
            b = self._take(free)
        else:
            if self.n_open >= self.limit:
                self.closed.append(self._take((self.free_bits & -self.free_bits).bit_length() - 1))   # the fullest
            b, free = self.n_bins, self.capacity
            self.n_bins += 1
        left = free - length
        if left:
            self.by_free[left].append(b)
            self.free_bits |= 1 << left
            self.n_open += 1
        else:
            self.closed.append(b)
        return b, self.capacity - free


def cut(n_ids: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter."""
    first = n_ids % capacity or capacity
    return [(0, min(first, n_ids))] + [(s, capacity) for s in range(first, n_ids, capacity)]


def _placed(parts: Iterable[list[tuple]], bins: BestFit, base: int, last: bool) -> Iterator[tuple[list[tuple], bool]]:
    """Rows of ``parts``, lists of (id, piece, start, length, ids_crc32, ids), with
    sequence number and offset: those of closed bins as they close, at the end those
    of the bins still open, marked so unless ``last``."""
    held: dict[int, list[tuple]] = {}
    for rows in parts:
        out = []
        for row in rows:
            b, off = bins.put(row[3])
            held.setdefault(b, []).append((*row, base + b, off))
            for c in bins.closed:
                out += held.pop(c)
            bins.closed.clear()
        if out:
            yield out, False
    if held:
        yield [row for rows in held.values() for row in rows], not last


def _batch(rows: list[tuple], is_open: bool, id_type: pa.DataType, with_ids: bool) -> pa.RecordBatch:
    i, piece, start, length, crc, ids, seq, off = zip(*rows)
    arrays = [pa.array(i, id_type), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc, seq, off)),
              pa.array([is_open] * len(rows))]
    names = ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "open"]
    if with_ids:
        arrays.append(pa.array(ids, pa.list_(pa.int64())))
        names.append("ids")
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _packed_again(pieces: DataFrame, n: int, level: int, tasks: int, capacity: int, open_bins: int, with_ids: bool) -> DataFrame:
    """The ``n`` ``pieces`` of open bins packed by ``tasks`` tasks, window by window."""

    def run(batches):
        base = level << _ROUND_BITS | TaskContext.get().partitionId() << _TASK_BITS
        kind = []

        def parts():
            for batch in batches:
                kind[:] = [batch.column(0).type]
                cols = [c.to_pylist() for c in batch.columns]
                yield list(zip(*cols[:5], cols[8] if with_ids else [None] * batch.num_rows))

        for rows, is_open in _placed(parts(), BestFit(capacity, open_bins), base, tasks == 1):
            yield _batch(rows, is_open, kind[0], with_ids)

    place = ["sequence_id", "offset"]                          # one piece each: an order without ties
    window = F.pmod(F.xxhash64(*place, F.lit(level)), F.lit(max(1, n // (2 * tasks * open_bins))))
    return pieces.repartition(tasks, F.xxhash64(*place)).sortWithinPartitions(window, F.desc("length"), *place).mapInArrow(run, pieces.schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, open_bins: int = OPEN_BINS, end_id: int = END_ID,
                   with_ids: bool = False, merge_pieces: int = MERGE_PIECES) -> DataFrame:
    """Tokenize every whole text, append ``end_id``, cut documents longer than
    ``capacity`` and pack the pieces.

    Returns one row per piece: ``id_col``, piece, start, length, ids_crc32,
    sequence_id, offset and, with ``with_ids``, ids (array<long>). A null or empty
    text is one piece holding ``end_id`` alone; null and repeated ids are carried
    as they are, each row for itself; an empty table gives no rows; other columns
    are not read, and may have any names. A text of any length is tokenized whole and
    cut. ``sequence_id`` is unique over the table: it counts rounds, tasks and a
    task's bins. Each round is written as a table, and a recomputed task packs the
    same rows in the same order, so a lost executor changes nothing.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (f"id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, "
              "`offset` bigint, open boolean" + ", ids array<bigint>" * with_ids)

    def run(batches):
        c, base = bpe.codec(tokenizer_path), TaskContext.get().partitionId() << _TASK_BITS
        kind = []

        def parts():
            for batch in batches:
                kind[:] = [batch.column(0).type]
                for part in tb.slices(batch, "text", bpe.ENCODE_BYTES):
                    ids, lens = c.encode_batch(part.column(1))
                    ids = np.insert(ids, np.cumsum(lens), end_id).astype("<u4")    # the end id after each document
                    rows, at = [], 0
                    for i, n in zip(part.column(0).to_pylist(), (lens + 1).tolist()):
                        for k, (start, length) in enumerate(cut(n, capacity)):
                            piece = ids[at + start:at + start + length]
                            rows.append((i, k, start, length, zlib.crc32(piece), piece.astype(np.int64) if with_ids else None))
                        at += n
                    yield rows

        for rows, is_open in _placed(parts(), BestFit(capacity, open_bins), base, False):
            yield _batch(rows, is_open, kind[0], with_ids)

    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    packed = written(src.mapInArrow(run, schema), "packed")
    done, level, tasks = packed.filter("not open"), 0, None
    while tasks != 1:
        left = packed.filter("open")
        n = left.count()
        if n == 0:
            break
        tasks = min(-(-n // merge_pieces), max(1, tasks // 2) if tasks else n)
        level += 1
        packed = written(_packed_again(left, n, level, tasks, capacity, open_bins, with_ids), "packed-again")
        done = done.unionByName(packed.filter("not open"))
    return done.drop("open").withColumnRenamed("id", id_col)
