"""Byte-level BPE: batch encoding, decoding and tree concatenation (operator 7).

Ids are those of the ``tokenizers`` library for the same vocabulary file. Three
facts about the split pattern and about BPE make the fast paths exact:

* A position before an ASCII space that a visible character follows is always a
  split point, whatever stands around it. Texts are cut there into chunks, and
  equal chunks of a batch are encoded once.
* Matching the split pattern from a true split point gives true split points,
  so two scans that meet once agree from there on.
* A token sequence is the encoding of its bytes if each adjacent pair of tokens
  is the encoding of the pair's bytes. So two encoded halves of a long unsplit
  run may be joined by any re-encoded window whose first and last token are the
  tokens that the halves have there.

``encode_decode`` cuts texts above ``leaf_bytes`` into leaves, spreads the leaves
over the cluster, encodes them in parallel and joins neighbours pairwise.
"""

from __future__ import annotations

import functools
import hashlib
import json

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import textbatch as tb

# The split pattern of the byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Texts of more bytes are encoded as leaves of this size.
LEAF_BYTES = 16 << 10
#: Distinct chunks a Python worker remembers before it starts afresh.
CACHE_CHUNKS = 250_000
#: Text bytes encoded at once.
ENCODE_BYTES = 2 << 20
#: A chunk of more bytes is encoded as a tree of halves.
LONG_CHUNK = 4096
#: Tokens on either side of a join in the first window.
FIRST_WINDOW = 8

# A byte after a space that proves a split before the space: visible ASCII (not
# "<", which may open a special token) or a lead byte of no white space.
_PROVES = np.zeros(256, dtype=bool)
_PROVES[0x21:0x7F] = True
_PROVES[ord("<")] = False
_PROVES[0xC3:0xF5] = True
_PROVES[[0xE1, 0xE2, 0xE3]] = False
_PROVEN = regex.compile("[ ](?=[!-;=-~À-࿿䀀-\U0010FFFF])")


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in character of each byte, as a rule."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one vocabulary file, one per Python worker."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        alphabet = _byte_alphabet()
        vocab = {t: i for t, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        raw = {bytes(alphabet[c] for c in t): i for t, i in vocab.items() if t not in self.special}
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in spec["model"]["merges"]]
        ids = [vocab[m] for m in merged]
        if any(a >= b for a, b in zip(ids, ids[1:])):
            raise ValueError("merge order and id order differ; ranks can't be taken from ids")
        self.tk = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=raw, special_tokens={})
        # the scan's white space is the Unicode property, without the separators U+001C to U+001F
        self.pattern = regex.compile(PATTERN.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s+", r"\p{White_Space}+")
                                     .replace(r"(?!\S)", r"(?!\P{White_Space})"))
        self.special_re = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        size = max([*raw.values(), *self.special.values()]) + 1
        table = [b""] * size
        for b, i in raw.items():
            table[i] = b
        for t, i in self.special.items():
            table[i] = t.encode()
        self.token_bytes = table
        self.token_len = np.array([len(b) for b in table], dtype=np.int64)
        self.token_start = np.cumsum(self.token_len) - self.token_len
        self.flat = np.frombuffer(b"".join(table), dtype=np.uint8)
        self._reset()

    def _reset(self):
        self.slot: dict[bytes, int] = {}
        self.start: list[np.ndarray] = []
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.starts = np.zeros(1 << 14, np.int64)
        self.lens = np.zeros(1 << 14, np.int64)

    # -- one text ---------------------------------------------------------
    def encode_section(self, text: str) -> np.ndarray:
        """Ids of a text without special tokens; long unsplit runs by a tree of halves."""
        if len(text) <= LONG_CHUNK:
            return np.array(self.tk.encode_ordinary(text), dtype=np.uint32)
        leaves = [text[i:i + LONG_CHUNK] for i in range(0, len(text), LONG_CHUNK)]
        return self.join_all([(t, np.array(self.tk.encode_ordinary(t), dtype=np.uint32)) for t in leaves])

    def sections(self, text: str) -> list[str]:
        """Ordinary text at even places, special tokens at odd ones."""
        return self.special_re.split(text) if self.special_re and "<" in text else [text]

    def encode(self, text: str) -> np.ndarray:
        parts = self.sections(text)
        out = [self.encode_section(p) if k % 2 == 0 else np.array([self.special[p]], np.uint32)
               for k, p in enumerate(parts)]
        return np.concatenate(out) if len(out) != 1 else out[0]

    # -- joins ------------------------------------------------------------
    def join_all(self, parts: list[tuple[str, np.ndarray]]) -> np.ndarray:
        """Join encoded neighbours pairwise, level by level."""
        while len(parts) > 1:
            parts = [self.join(*parts[i], *parts[i + 1]) if i + 1 < len(parts) else parts[i]
                     for i in range(0, len(parts), 2)]
        return parts[0][1]

    def _tokens_before(self, ids: np.ndarray, n_bytes: int) -> int:
        """Number of tokens that make up the last ``n_bytes`` bytes."""
        k, got = 0, 0
        while got < n_bytes:
            step = min(max(16, n_bytes - got), len(ids) - k)
            lens = np.cumsum(self.token_len[ids[len(ids) - k - step:len(ids) - k][::-1]])
            hit = int(np.searchsorted(lens, n_bytes - got))
            if hit < step:
                if lens[hit] != n_bytes - got:
                    raise ValueError("no token starts there")
                return k + hit + 1
            k, got = k + step, got + int(lens[-1])
        return k

    def _tokens_after(self, ids: np.ndarray, n_bytes: int) -> int:
        return self._tokens_before(ids[::-1], n_bytes)

    def join(self, lt: str, li: np.ndarray, rt: str, ri: np.ndarray) -> tuple[str, np.ndarray]:
        """Encoding of ``lt + rt`` from those of its halves."""
        text, cut = lt + rt, len(lt)
        if not lt or not rt:
            return text, np.concatenate([li, ri])
        # s: the last proven split of the left half, some way before the cut
        s = 0
        back = 64
        while back < 2 * cut:
            found = [m.start() for m in _PROVEN.finditer(lt, max(0, cut - back), cut)]
            if found:
                s = found[0]
                break
            back *= 2
        # walk both halves' splits until they meet
        true_pos, right_pos = s, cut
        true_it, right_it = self.pattern.finditer(text, s), self.pattern.finditer(text, cut)
        longest, spans = (0, 0), []
        while true_pos != right_pos or true_pos < cut:
            if true_pos <= right_pos:
                m = next(true_it)
                true_pos = m.end()
                spans.append(m)
                if m.start() < cut < m.end():
                    longest = m.span()
            else:
                right_pos = next(right_it).end()
        b = true_pos
        q0, q1 = longest
        if q1 - q0 > LONG_CHUNK // 4 and b == q1:
            joined = self._join_run(text, q0, cut, q1, li, ri)
            if joined is not None:
                return text, joined
        keep_l = len(li) - self._tokens_before(li, len(text[s:cut].encode()))
        keep_r = self._tokens_after(ri, len(text[cut:b].encode()))
        # split by split: cut off at b, the pattern could match other white space
        new = np.array([i for m in spans for i in self.tk._encode_single_piece(m.group().encode())], dtype=np.uint32)
        return text, np.concatenate([li[:keep_l], new, ri[keep_r:]])

    def _join_run(self, text: str, q0: int, cut: int, q1: int, li: np.ndarray, ri: np.ndarray):
        """Join inside one unsplit run ``text[q0:q1]`` by growing windows; None
        if the halves don't hold the run's parts as runs of their own."""
        left = self.pattern.match(text, q0, cut)
        right = self.pattern.match(text, cut)
        if left is None or left.end() != cut or right is None or right.end() != q1:
            return None
        try:
            nl = self._tokens_before(li, len(text[q0:cut].encode()))
            nr = self._tokens_after(ri, len(text[cut:q1].encode()))
        except ValueError:
            return None
        w = FIRST_WINDOW
        while True:
            a, b = min(w, nl), min(w, nr)
            window = np.concatenate([li[len(li) - a:], ri[:b]])
            new = np.array(self.tk._encode_single_piece(b"".join(self.token_bytes[i] for i in window)), np.uint32)
            agree_l = a == nl or new[0] == window[0]
            agree_r = b == nr or new[-1] == window[-1]
            if agree_l and agree_r:
                return np.concatenate([li[:len(li) - a], new, ri[b:]])
            w *= 2

    # -- batches ----------------------------------------------------------
    def _learn(self, chunks: list[bytes]) -> None:
        """Encode chunks not seen before and remember them."""
        plain, lens, todo = [], [], []
        for c in chunks:
            if len(c) > 1 and c[0] == 0x20 and _PROVES[c[1]] and len(c) <= LONG_CHUNK and b"<|" not in c:
                plain.append(c)
            else:
                todo.append(c)
        try:
            joined = b"".join(plain).decode()
        except UnicodeDecodeError:
            plain, todo, joined = [], chunks, ""
        if plain:
            ids = np.array(self.tk.encode_ordinary(joined), dtype=np.uint32)
            at = np.cumsum(self.token_len[ids])
            ends = np.searchsorted(at, np.cumsum([len(c) for c in plain]), side="left") + 1
            self._store(plain, ids, np.diff(ends, prepend=0))
        if todo:
            each = [self.encode(c.decode("utf-8", "replace")) for c in todo]
            self._store(todo, np.concatenate(each), np.array([len(x) for x in each], dtype=np.int64))

    def _store(self, chunks: list[bytes], ids: np.ndarray, lens: np.ndarray) -> None:
        n0, n1 = len(self.slot), len(self.slot) + len(chunks)
        while n1 > len(self.starts):
            self.starts, self.lens = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lens))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used:self.used + len(ids)] = ids
        self.starts[n0:n1] = self.used + np.cumsum(lens) - lens
        self.lens[n0:n1] = lens
        self.used += len(ids)
        self.slot.update(zip(chunks, range(n0, n1)))

    def encode_batch(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each text)."""
        data, offs = tb.text_bytes(column)
        n = len(offs) - 1
        if len(data) == 0:
            return np.zeros(0, np.uint32), np.zeros(max(n, 0), np.int64)
        mark = np.zeros(len(data) + 1, dtype=bool)
        mark[:-2] = (data[:-1] == 0x20) & _PROVES[data[1:]]
        mark[offs] = True
        bounds = np.flatnonzero(mark)
        chunks = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(bounds) - 1,
            [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        distinct = tb.byte_strings(chunks.dictionary)
        if len(self.slot) > CACHE_CHUNKS:
            self._reset()
        new = [c for c in distinct if c not in self.slot]
        if new:
            self._learn(new)
        slots = np.fromiter(map(self.slot.__getitem__, distinct), dtype=np.int64, count=len(distinct))
        at = slots[chunks.indices.to_numpy(zero_copy_only=False)]
        lens = self.lens[at]
        ids = self.ids[tb.ragged(self.starts[at], lens)]
        total = np.concatenate([[0], np.cumsum(lens)])
        return ids, np.diff(total[np.searchsorted(bounds, offs)])

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the decoded text; bytes that are no UTF-8 become U+FFFD."""
        raw = self.flat[tb.ragged(self.token_start[ids], self.token_len[ids])].tobytes()
        try:
            raw.decode()
            return raw
        except UnicodeDecodeError:
            return raw.decode("utf-8", "replace").encode()


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _digest(c: Codec, ids: np.ndarray) -> tuple[int, str, str]:
    return (len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
            hashlib.sha256(c.decode(ids)).hexdigest())


def leaf_texts(text: str, c: Codec, leaf_bytes: int) -> list[tuple[int, int, str]]:
    """(section, leaf, text): ordinary text between special tokens in leaves of
    at most ``leaf_bytes`` bytes, special tokens as sections of their own."""
    out = []
    for k, part in enumerate(c.sections(text)):
        if k % 2 == 1:
            out.append((k, 0, part))
            continue
        raw = part.encode()
        i, leaf = 0, 0
        while i < len(raw) or leaf == 0:
            j = min(i + leaf_bytes, len(raw))
            while j < len(raw) and (raw[j] & 0xC0) == 0x80:
                j -= 1
            out.append((k, leaf, raw[i:j].decode()))
            i, leaf = j, leaf + 1
    return out


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                  leaf_bytes: int = LEAF_BYTES, with_ids: bool = False) -> DataFrame:
    """Encode every whole text and decode it again.

    Returns one row per row of ``docs``: ``id_col``, n_tokens, ids_sha256,
    decoded_sha256 and, with ``with_ids``, ids (array<long>) and decoded.
    A null text is an empty one (no ids, digests of no bytes); a null or repeated
    id is carried as it is, each row for itself; an empty table gives no rows;
    other columns of ``docs`` are not read.

    Texts up to ``leaf_bytes`` bytes are encoded in the scan's tasks. Longer ones
    become leaves that are spread over the cluster by (row, leaf) and encoded
    there; a group then holds the ids of one text, whose leaves are joined
    pairwise, level by level.
    """
    extra = "ids array<bigint>, decoded string" if with_ids else ""
    id_type = docs.schema[id_col].dataType.simpleString()
    out_schema = f"id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", " + extra) * with_ids
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def rows(ids_col, parts, c):
        dig = [_digest(c, p) for p in parts]
        cols = [ids_col, pa.array([d[0] for d in dig], pa.int64()), pa.array([d[1] for d in dig], pa.string()),
                pa.array([d[2] for d in dig], pa.string())]
        names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if with_ids:
            cols += [pa.array([p.astype(np.int64) for p in parts], pa.list_(pa.int64())),
                     pa.array([c.decode(p).decode() for p in parts], pa.string())]
            names += ["ids", "decoded"]
        return pa.RecordBatch.from_arrays(cols, names=names)

    def direct(batches):
        c = codec(tokenizer_path)
        for batch in batches:
            for part in tb.slices(batch, "text", ENCODE_BYTES):
                ids, lens = c.encode_batch(part.column(1))
                yield rows(part.column(0), np.split(ids, np.cumsum(lens)[:-1]), c)

    def to_leaves(batches):
        c = codec(tokenizer_path)
        for batch in batches:
            for part in tb.slices(batch, "text", ENCODE_BYTES):
                out = []
                for key, ident, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(),
                                            part.column(2).to_pylist()):
                    out += [(key, ident if k == 0 and leaf == 0 else None, k, leaf, t)
                            for k, leaf, t in leaf_texts(text, c, leaf_bytes)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], part.schema.field(1).type),
                     pa.array([r[2] for r in out], pa.int32()), pa.array([r[3] for r in out], pa.int32()),
                     pa.array([r[4] for r in out], pa.string())], names=["key", "id", "section", "leaf", "text"])

    def encode_leaves(batches):
        c = codec(tokenizer_path)
        for batch in batches:
            for part in tb.slices(batch, "text", ENCODE_BYTES):
                texts = part.column(4)
                special = np.array([s % 2 == 1 for s in part.column(2).to_pylist()])
                if special.any():
                    each = [np.array([c.special[t]], np.uint32) if sp else c.encode_section(t)
                            for t, sp in zip(texts.to_pylist(), special)]
                else:
                    ids, lens = c.encode_batch(texts)
                    each = np.split(ids, np.cumsum(lens)[:-1])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([x.astype("<u4").tobytes() for x in each], pa.binary())],
                    names=["key", "id", "section", "leaf", "text", "ids"])

    def join_leaves(table: pa.Table) -> pa.Table:
        c = codec(tokenizer_path)
        table = table.sort_by([("section", "ascending"), ("leaf", "ascending")])
        sect = table.column("section").to_pylist()
        leaves = list(zip(table.column("text").to_pylist(),
                          [np.frombuffer(x, "<u4") for x in table.column("ids").to_pylist()]))
        done, i = [], 0
        while i < len(leaves):
            j = i
            while j < len(leaves) and sect[j] == sect[i]:
                j += 1
            done.append(c.join_all(leaves[i:j]))
            i = j
        ident = table.column("id").slice(0, 1).combine_chunks()
        return pa.Table.from_batches([rows(ident, [np.concatenate(done)], c)])

    size = F.octet_length("text")
    short = src.filter(size <= leaf_bytes).mapInArrow(direct, out_schema)
    long = (src.filter(size > leaf_bytes).select(F.monotonically_increasing_id().alias("key"), "id", "text")
            .mapInArrow(to_leaves, f"key bigint, id {id_type}, section int, leaf int, text string")
            .repartition("key", "leaf")
            .mapInArrow(encode_leaves, f"key bigint, id {id_type}, section int, leaf int, text string, ids binary")
            .groupBy("key").applyInArrow(join_leaves, out_schema))
    return short.unionByName(long).withColumnRenamed("id", id_col)
