"""Spelling variants of a corpus' vocabulary (operator 12).

Two words are near if one inserted, deleted or replaced code point makes one of the
other. Words that may be near are brought together by what an edit leaves alone: a
word of ``l`` code points is cut into windows, and words that agree before and behind
a window form a group (words of ``l`` and ``l + 1`` code points together). An edit lies
in one window, so each near pair shares the group of exactly that window. Windows
start as the two halves of a word; those of a group above ``MAX_GROUP`` words are cut
in two again, so no task meets a group that grows with the vocabulary.

A group is a sorted list. Each of its words scans the list by dynamic programming
on a band of three cells a row: the rows of the prefix that a word shares with the
one before (their LCP) are kept, and once every cell of a row exceeds one edit the
whole range of words with that prefix is skipped. The scans of a task run in step,
one numpy operation for all of them.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import textbatch as tb
from riskloom.llm.store import drop, written

MIN_POINTS = 5
MIN_COUNT = 3
#: One in so many runs (by the checksum of document and run) loses a code point.
TYPO_MODULUS = 97
#: A form is at least so many times as frequent.
MIN_RATIO = 2
#: Words of a group above which its window is cut in two.
MAX_GROUP = 500
#: Rows of a task's lists, on average.
BUCKET_ROWS = 20_000
#: Cells of the edit rows that scans in step hold at once.
MAX_CELLS = 4 << 20

_ASCII = np.zeros(256, dtype=bool)
_ASCII[0x41:0x5B] = _ASCII[0x61:0x7B] = True


def letter_runs(data: np.ndarray, offs: np.ndarray):
    """(start, end, document, code points) of the maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``.

    In UTF-8 those of the second range, and no others, begin with the byte C3.
    """
    lead = data == 0xC3
    inside = _ASCII[data] | lead
    inside[1:] |= lead[:-1]
    s, e, doc = tb.mask_spans(inside, offs)
    before = np.concatenate([np.zeros(1, np.int64), np.cumsum(lead)])
    return s, e, doc, (e - s) - (before[e] - before[s])


def word_counts(docs: DataFrame, min_points: int = MIN_POINTS, modulus: int = TYPO_MODULUS) -> DataFrame:
    """(word, n) of ``docs`` (id, text): partial counts of the words of at least
    ``min_points`` code points. A run whose unsigned crc32 of ``<id>:<run>`` (a null
    id is empty) is divisible by ``modulus`` counts without its code point
    ``crc32 % length``."""

    def run(batches):
        for batch in batches:
            for part in tb.slices(batch, "text"):
                yield from _counts(part, min_points, modulus)

    return docs.mapInArrow(run, "word string, n bigint")


def _counts(part: pa.RecordBatch, min_points: int, modulus: int):
    data, offs = tb.text_bytes(part.column(1))
    data = tb.LOWER[data]
    s, e, doc, points = letter_runs(data, offs)
    long = points >= min_points
    if not long.any():
        return
    codes, distinct = tb.spans_to_ids(data, s[long], e[long])
    words = tb.byte_strings(distinct)
    both, n = np.unique(doc[long] * len(words) + codes, return_counts=True)
    rows, codes = np.divmod(both, len(words))
    seeds = [zlib.crc32(("" if i is None else str(i)).encode() + b":") for i in part.column(0).to_pylist()]
    crc = np.fromiter(map(zlib.crc32, map(words.__getitem__, codes.tolist()), map(seeds.__getitem__, rows.tolist())),
                      dtype=np.int64, count=len(rows))
    cut = crc % modulus == 0
    plain = np.bincount(codes[~cut], weights=n[~cut], minlength=len(words)).astype(np.int64)
    some = np.flatnonzero(plain)
    names = ["word", "n"]
    yield pa.RecordBatch.from_arrays([distinct.take(pa.array(some)).cast(pa.string()), pa.array(plain[some])], names=names)
    less, times = [], []
    for k in np.flatnonzero(cut).tolist():
        w = words[codes[k]].decode()
        at = int(crc[k]) % len(w)
        if len(w) > min_points:
            less.append(w[:at] + w[at + 1:])
            times.append(int(n[k]))
    yield pa.RecordBatch.from_arrays([pa.array(less, pa.string()), pa.array(times, pa.int64())], names=names)


def _keyed(rows: DataFrame) -> DataFrame:
    """Adds ``key``: what the words of a group agree in, before and behind the window."""
    return rows.withColumn("key", F.xxhash64(F.substring("word", F.lit(1), F.col("i")), F.right("word", F.col("l") - F.col("j"))))


def windows(words: DataFrame, min_points: int = MIN_POINTS) -> DataFrame:
    """(word, n, l, i, j): the halves [i, j) of each word, as one of ``l`` code points
    and, for pairs with a shorter word, as one of ``l + 1``."""
    size = F.char_length("word")
    rows = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("l")).filter(F.col("l") >= min_points)
    half = F.floor(F.col("l") / 2).cast("int")
    ends = F.explode(F.array(F.struct(F.lit(0).alias("i"), half.alias("j")), F.struct(half.alias("i"), F.col("l").alias("j"))))
    return rows.select("word", "n", "l", ends.alias("e")).select("word", "n", "l", "e.i", "e.j")


def near_words(words: DataFrame, min_points: int = MIN_POINTS, max_group: int = MAX_GROUP) -> DataFrame:
    """(word, n_near, best) of the words (word, n) that have a near word: their
    number, and the most frequent one as a struct (-n, word) (ties: the smallest)."""
    buckets = max(1, 4 * words.count() // BUCKET_ROWS)
    group = ["l", "i", "j", "key"]
    rows, ready = _keyed(windows(words, min_points)), None
    while True:
        rows = written(rows, "spelling-windows")
        large = written(rows.filter("j - i > 1").groupBy(*group).agg(F.count(F.lit(1)).alias("c"))
                        .filter(F.col("c") > max_group).select(*group), "spelling-large")
        last = large.isEmpty()
        small = rows if last else rows.join(large, group, "left_anti")
        found = (small.select(*[c for c in rows.columns], F.pmod("key", F.lit(buckets)).alias("bucket"))
                 .groupBy("bucket").applyInArrow(_compare, "word string, near bigint, least bigint, form string"))
        found = written(found.groupBy("word").agg(F.sum("near").alias("near"), F.min(F.struct("least", "form")).alias("best")),
                        "spelling-near")
        ready = found if ready is None else ready.unionByName(found)
        if last:
            break
        middle = F.floor((F.col("i") + F.col("j")) / 2).cast("int")
        ends = F.explode(F.array(F.struct(F.col("i"), middle.alias("j")), F.struct(middle.alias("i"), F.col("j"))))
        rows = _keyed(rows.join(large, group, "left_semi").select("word", "n", "l", ends.alias("e"))
                      .select("word", "n", "l", "e.i", "e.j"))
    return ready.groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def _compare(table: pa.Table) -> pa.Table:
    """Near words of the rows (word, n, l, i, j, key) of whole groups."""
    table = table.sort_by([(c, "ascending") for c in ("l", "i", "j", "key", "word")])
    words = table.column("word").to_pylist()
    l, i, j, key, n = (table.column(c).to_numpy().astype(np.int64) for c in ("l", "i", "j", "key", "n"))
    size = np.array([len(w) for w in words], dtype=np.int64)
    begin = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])[:-1]
    points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    new = np.ones(len(words) + 1, dtype=bool)                     # a group starts here
    new[1:-1] = (l[1:] != l[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]) | (key[1:] != key[:-1])
    first = np.flatnonzero(new)
    of = np.cumsum(new[:-1]) - 1
    start, end = first[of], first[of + 1]
    rows = np.arange(1, len(words))
    lcp = np.full(len(words) + 1, -1, dtype=np.int64)
    lcp[1:-1] = _common(points, begin[rows - 1], begin[rows], np.minimum(size[rows - 1], size[rows]))
    lcp[first] = -1
    lanes = np.flatnonzero((size == l) & (end - start > 1))       # the shorter word of a pair, or one of two
    us, vs = [], []
    at = 0
    while at < len(lanes):                                        # ordered by l: rows of one depth, about
        many = max(1, MAX_CELLS // (3 * (int(l[lanes[min(at + MAX_CELLS // 64, len(lanes) - 1)]]) + 3)))
        u, v = _scan(lanes[at:at + many], points, begin, size, lcp, _next_lower(lcp), i, start, end)
        us.append(u)
        vs.append(v)
        at += many
    u, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (us, vs))
    # of two words of one length the later finds the pair; the edit lies in this window
    ok = (size[v] > size[u]) | (u < v)
    u, v = u[ok], v[ok]
    p = _common(points, begin[u], begin[v], size[u])
    ok = (p >= i[u]) & ((p < j[u]) | (j[u] == l[u]))
    u, v = u[ok], v[ok]
    x, y = np.concatenate([u, v]), np.concatenate([v, u])
    order = np.lexsort((y, -n[y], x))                             # lists are sorted: a smaller row is a smaller word
    x, y = x[order], y[order]
    lead = np.ones(len(x), dtype=bool)
    lead[1:] = x[1:] != x[:-1]
    firsts = np.flatnonzero(lead)
    many = np.diff(np.append(firsts, len(x)))
    x, y = x[firsts], y[firsts]
    word = table.column("word").combine_chunks()
    word = word.chunk(0) if isinstance(word, pa.ChunkedArray) else word
    return pa.table({"word": word.take(pa.array(x)), "near": pa.array(many, pa.int64()), "least": pa.array(-n[y], pa.int64()),
                     "form": word.take(pa.array(y))})


def _common(points: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the code points from ``a`` and from ``b``, at most ``most``."""
    out = np.zeros(len(a), dtype=np.int64)
    on = np.flatnonzero(most > 0)
    while len(on):
        on = on[points[a[on] + out[on]] == points[b[on] + out[on]]]
        out[on] += 1
        on = on[out[on] < most[on]]
    return out


def _next_lower(lcp: np.ndarray) -> np.ndarray:
    """For each row the next one with a smaller LCP (group starts have -1)."""
    out = np.full(len(lcp), len(lcp) - 1, dtype=np.int64)
    stack: list[int] = []
    for k, x in enumerate(lcp.tolist()):
        while stack and lcp[stack[-1]] > x:
            out[stack.pop()] = k
        stack.append(k)
    return out


def _scan(lanes, points, begin, size, lcp, lower, shared, start, end) -> tuple[np.ndarray, np.ndarray]:
    """(row of ``lanes``, row of its list at one edit) of each hit.

    A lane holds the rows of the edit matrix between its word and the prefix of the
    list's current word: row ``d`` as the distances of the word's first d-1, d and
    d+1 code points, capped at 2.
    """
    m, l = len(lanes), size[lanes]
    q = begin[lanes]
    depth = shared[lanes].copy()                                  # what the whole group shares costs no row
    stack = np.full((m, int(l.max(initial=0)) + 2, 3), 2, dtype=np.int8)
    every = np.arange(m)
    stack[every, depth, 1] = 0
    stack[every, depth, 2] = 1
    stack[every[depth > 0], depth[depth > 0], 0] = 1
    base = depth.copy()
    at, stop = start[lanes].copy(), end[lanes]
    found_u, found_v = [], []
    top = len(points) - 1
    on = every
    while len(on):
        d, v = depth[on], at[on]
        whole = d == size[v]
        # a whole word: its distance is in the cell of the lane's length
        k = on[whole]
        off = l[k] - d[whole]
        near = (np.abs(off) <= 1) & (stack[k, d[whole], np.clip(off + 1, 0, 2)] == 1)
        found_u.append(lanes[k[near]])
        found_v.append(v[whole][near])
        # the others get one more row
        k, e = on[~whole], d[~whole]
        c = points[begin[v[~whole]] + e]
        row, ql, q0 = stack[k, e], l[k], q[k]
        a = np.minimum(row[:, 0] + (points[np.clip(q0 + e - 1, 0, top)] != c), row[:, 1] + 1)
        a[e > ql] = 2
        b = np.minimum(np.minimum(row[:, 1] + (points[np.clip(q0 + e, 0, top)] != c), row[:, 2] + 1), a + 1)
        b[e + 1 > ql] = 2
        g = np.minimum(row[:, 2] + (points[np.clip(q0 + e + 1, 0, top)] != c), b + 1)
        g[e + 2 > ql] = 2
        dead = (a > 1) & (b > 1) & (g > 1)
        live = ~dead
        kl = k[live]
        stack[kl, e[live] + 1] = np.minimum(np.stack([a, b, g], axis=1)[live], 2)
        depth[kl] = e[live] + 1
        # on to the next word that does not share the prefix that exceeds one edit
        go = np.concatenate([on[whole], k[dead]])
        past = np.concatenate([np.full(int(whole.sum()), len(points) + 2), e[dead] + 1])
        nxt = at[go] + 1
        jump = np.flatnonzero(lcp[nxt] >= past)
        while len(jump):
            nxt[jump] = lower[nxt[jump]]
            jump = jump[lcp[nxt[jump]] >= past[jump]]
        at[go] = nxt
        depth[go] = np.maximum(np.minimum(depth[go], lcp[nxt]), base[go])
        on = on[at[on] < stop[on]]
    return (np.concatenate(found_u) if found_u else np.zeros(0, np.int64),
            np.concatenate(found_v) if found_v else np.zeros(0, np.int64))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word reached from each by forms (word, form). Forms are
    at least twice as frequent, so a chain is short; each round doubles the steps taken."""
    cur = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        up = cur.select(F.col("word").alias("root"), F.col("root").alias("higher"))
        new = written(cur.join(up, "root", "left").select("word", F.coalesce("higher", "root").alias("root"),
                                                           F.col("higher").isNotNull().alias("moved")), "spelling-roots")
        drop(cur)
        cur = new.select("word", "root")
        cur._stage_path = new._stage_path
        if new.filter("moved").isEmpty():
            return cur


def spelling_forms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_points: int = MIN_POINTS,
                   min_count: int = MIN_COUNT, modulus: int = TYPO_MODULUS, min_ratio: int = MIN_RATIO,
                   max_group: int = MAX_GROUP) -> DataFrame:
    """One row per word of ``docs``: word, form, root, n, n_near, form_n.

    Words are the distinct runs of ``[A-Za-z\\u00C0-\\u00FF]`` (A-Z lower-cased) of at
    least ``min_points`` code points and ``min_count`` occurrences ``n``; see
    ``word_counts`` for the runs that lose a code point. ``n_near`` counts the words
    one edit away; ``form`` is the most frequent of them (ties: the smallest in
    code-point order) if it is at least ``min_ratio`` times as frequent, else null;
    ``root`` is the last word that forms lead to, the word itself if it has none.

    Null and empty texts have no words, long ones are read whole, repeated rows each
    count, a null id enters the checksum as an empty text, an empty table gives no
    rows, and other columns are not read.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    words = written(word_counts(src, min_points, modulus).groupBy("word").agg(F.sum("n").alias("n"))
                    .filter(F.col("n") >= min_count), "spelling-words")
    near = near_words(words, min_points, max_group)
    form_n = -F.col("best.least")
    out = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        *[F.when(form_n >= min_ratio * F.col("n"), x).alias(c) for c, x in (("form", F.col("best.form")), ("form_n", form_n))]),
        "spelling-forms")
    roots = _roots(out.filter("form is not null"))
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
