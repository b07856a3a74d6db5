"""Arrow and numpy helpers shared by the text operators.

Every operator sees a document as UTF-8 bytes inside an Arrow batch. Batches
are cut into slices of a bounded number of text bytes, so the numpy arrays of a
task stay small whatever the number of rows Spark puts into a batch (a single
longer text is a slice of its own).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Text bytes handled at once by the numpy code of a task.
SLICE_BYTES = 1 << 20

#: ASCII white space of the word rule ``[^\x20\x09-\x0D]+``.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Byte map that lower-cases A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row ranges of ``batch`` with at most ``max_bytes`` of text
    each (or one row)."""
    if batch.num_rows == 0:
        return
    offs = text_bytes(batch.column(batch.schema.get_field_index(column)))[1]
    start, n = 0, batch.num_rows
    while start < n:
        end = int(np.searchsorted(offs, offs[start] + max_bytes, side="right")) - 1
        end = min(max(end, start + 1), n)
        yield batch.slice(start, end - start)
        start = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column: document ``i`` is
    ``data[offs[i]:offs[i + 1]]``; a null is empty."""
    arr = column.cast(pa.large_binary())
    if arr.null_count:
        arr = arr.fill_null(b"")
    bufs = arr.buffers()
    offs = np.frombuffer(bufs[1], dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = (np.frombuffer(bufs[2], dtype=np.uint8)[offs[0]:offs[-1]] if bufs[2] is not None and len(arr)
            else np.zeros(0, np.uint8))
    return data, offs - (offs[0] if len(offs) else 0)


def spans_to_ids(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Exact dictionary codes of the byte spans ``data[starts[i]:ends[i]]``
    (ordered, not overlapping): (code of each span, distinct spans)."""
    bounds = np.empty(2 * len(starts) + 1, dtype=np.int64)
    bounds[0:-1:2], bounds[1::2] = starts, ends
    bounds[-1] = ends[-1] if len(ends) else 0
    # spans and the gaps between them alternate; the last gap is empty
    arr = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), 2 * len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
    enc = arr.dictionary_encode()
    return enc.indices.to_numpy(zero_copy_only=False)[::2].astype(np.int64), enc.dictionary


def byte_strings(arr: pa.Array) -> list[bytes]:
    """Python bytes of a large_binary array without nulls."""
    data, offs = text_bytes(arr)
    raw, at = data.tobytes(), offs.tolist()
    return [raw[a:b] for a, b in zip(at, at[1:])]


def mask_spans(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document index) of every maximal run of ``inside`` bytes;
    runs end at document ends."""
    if len(inside) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    first = np.zeros(len(inside) + 1, dtype=bool)
    first[offs] = True                                     # a document starts here
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:-1]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return s, e, np.searchsorted(offs, s, side="right") - 1


def word_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document index) of every word; words end at document ends."""
    return mask_spans(~IS_SPACE[data], offs)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word; each distinct word is hashed once."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    codes, words = spans_to_ids(data, starts, ends)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, byte_strings(words)), dtype=np.uint64, count=len(words))
    return h[codes]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (wrapping arithmetic)."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def shingle_hashes(h: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash, position of its first word) of each run of ``k`` words
    inside one document."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    acc = h[:n].copy()
    for j in range(1, k):
        acc = mix(acc) + h[j:n + j]
    pos = np.flatnonzero(doc[:n] == doc[k - 1:k - 1 + n])
    return mix(acc[pos]), pos


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges ``starts[i] .. starts[i] + lens[i]``."""
    total = int(lens.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lens)
    return np.repeat(starts - (ends - lens), lens) + np.arange(total)


def per_doc(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Sum of ``values`` by document index, as long."""
    return np.bincount(doc, weights=values, minlength=n).astype(np.int64) if len(doc) else np.zeros(n, np.int64)
