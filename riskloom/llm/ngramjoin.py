"""N-gram Jaccard join of documents by multiple global orders (operator 13).

A document is the set of its shingles. Under any global order of the shingles, two
sets of n and m elements with a Jaccard similarity of t share one of the first
n - ceil(t * n) + 1 and m - ceil(t * m) + 1 elements: their prefixes meet. Three orders
are used, each over all documents:

* by the rarest word of a shingle (counts of hashed words), then by hash;
* by the counts of hashed shingles, then by hash;
* by hash alone.

Prefixes longer by k elements share k + 1 elements; with sets of two sizes, those of the
smaller one.

Equal sets form one class. A class stays in only if, under each order in turn, as many
elements of its lengthened prefix are in those of other classes as a similar set would
share, and one of its prefix is in another class of a size that allows a link: a passage
that many texts share does not bring them together. What is left meets in
the buckets of the first order; a pair is verified on the full sets only if its sizes
allow the similarity and its prefixes meet under the other orders as well. In each
bucket the classes are verified against the bucket's centre first; those that are
still in another component are then compared with each other, by size band and in
blocks of a bounded number of shingles. Prefixes meet first; full sets go only to the
classes that have a partner whose prefixes they meet under all orders. Components of
the confirmed links are the result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import bloom
from riskloom.llm import textbatch as tb
from riskloom.llm.components import components
from riskloom.llm.store import drop, if_small, written

WORDS = 3
MIN_PERCENT = 90
#: Slots of the hashed counts that two of the orders rest on (a power of two).
SLOTS = 1 << 15
_SHIFT = np.uint64(64 - 15)
#: Keeps the keys of neighbouring size bands apart; times any band it fits a bigint.
BAND_STEP = 0x5851F42D4D
#: Shingles on either side of a block, and in the groups that a task compares.
BLOCK_SHINGLES = 1 << 22
BUCKET_SHINGLES = 1 << 20


def token_sets(column: pa.Array, words: int):
    """(offsets, shingles, words of each): the distinct shingle hashes of each text in
    ascending order, and the slot of every word of a shingle. Words are runs of
    ``[^\\x20\\x09-\\x0D]``, A-Z lower-cased; a text with fewer words than a shingle is
    one shingle of all its words."""
    data, offs = tb.text_bytes(column)
    data = tb.LOWER[data]
    s, e, doc = tb.word_spans(data, offs)
    h = tb.word_hashes(data, s, e)
    n = len(offs) - 1
    first = np.searchsorted(doc, np.arange(n + 1))
    sh, pos = tb.shingle_hashes(h, doc, words)
    slot = (h >> _SHIFT).astype(np.int64)
    of = slot[pos[:, None] + np.arange(words)] if len(pos) else np.zeros((0, words), np.int64)
    owner = doc[pos]
    few = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < words))
    if len(few):
        short, slots = [], []
        for i in few:
            acc = np.uint64(first[i + 1] - first[i])
            with np.errstate(over="ignore"):
                for x in h[first[i]:first[i + 1]]:
                    acc = tb.mix(np.array([acc]))[0] + x
            short.append(acc)
            slots.append(np.resize(slot[first[i]:first[i + 1]], words))
        sh, of, owner = np.append(sh, np.array(short, dtype=np.uint64)), np.concatenate([of, slots]), np.append(owner, few)
    sh = sh.view(np.int64)
    order = np.argsort(sh, kind="stable")
    order = order[np.argsort(owner[order], kind="stable")]
    sh, of, owner = sh[order], of[order], owner[order]
    new = np.ones(len(sh), dtype=bool)
    new[1:] = (sh[1:] != sh[:-1]) | (owner[1:] != owner[:-1])
    sh, of, owner = sh[new], of[new], owner[new]
    return np.searchsorted(owner, np.arange(n + 1)), sh, of


def _shingle_slots(sh: np.ndarray) -> np.ndarray:
    return (tb.mix(sh.view(np.uint64)) >> _SHIFT).astype(np.int64)


def slot_classes(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequency classes (quarters of a power of two) of hashed words and of hashed
    shingles, from the counts of all documents: ``SLOTS`` small numbers each."""

    def run(batches):
        total = np.zeros((2, SLOTS), dtype=np.int64)
        for batch in batches:
            for part in tb.slices(batch, "text"):
                data, offs = tb.text_bytes(part.column(1))
                data = tb.LOWER[data]
                start, end, doc = tb.word_spans(data, offs)
                h = tb.word_hashes(data, start, end)
                total[0] += np.bincount((h >> _SHIFT).astype(np.int64), minlength=SLOTS)
                total[1] += np.bincount(_shingle_slots(tb.shingle_hashes(h, doc, words)[0].view(np.int64)), minlength=SLOTS)
        kind, slot = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(kind.astype(np.int32)), pa.array(slot.astype(np.int32)),
                                          pa.array(total[kind, slot])], names=["kind", "slot", "n"])

    counts = docs.mapInArrow(run, "kind int, slot int, n bigint").groupBy("kind", "slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((2, SLOTS))
    out[counts.column("kind").to_numpy(), counts.column("slot").to_numpy()] = counts.column("n").to_numpy()
    classes = np.minimum(4 * np.log2(out + 1), 255).astype(np.uint8)
    return classes[0], classes[1]


def prefix_length(n, percent: int):
    """Elements of a set of ``n`` of which one is shared by every set similar enough."""
    return n - (percent * n + 99) // 100 + 1


def extra_length(n, percent: int):
    """Elements by which the prefix of a set of ``n`` is lengthened: each of them is one
    more that a similar set's lengthened prefix shares."""
    return n * (100 - percent) // 100


def least_shared(n, percent: int):
    """Elements that the lengthened prefix of a set of ``n`` shares with that of every
    similar set: one, and the extra ones of the smaller set, which has at least
    ``percent`` of the ``n`` elements."""
    return 1 + extra_length((percent * n + 99) // 100, percent)


def prefix(offs: np.ndarray, sh: np.ndarray, rank: np.ndarray, percent: int, extra: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, shingles): the first elements of each set by (rank, hash), with
    ``extra`` those of the lengthened prefix; the sets are sorted by hash, a stable
    sort keeps ties in that order."""
    n = np.diff(offs)
    owner = np.repeat(np.arange(len(n)), n)
    order = np.argsort((owner.astype(np.uint32) << np.uint32(8)) | rank, kind="stable") if len(sh) else np.zeros(0, np.int64)
    length = np.where(n > 0, prefix_length(n, percent) + extra * extra_length(n, percent), 0)
    take = order[tb.ragged(offs[:-1], length)]
    return np.concatenate([[0], np.cumsum(length)]), sh[take]


def _lists(offs: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(values))


def _class_ids(offs: np.ndarray, sh: np.ndarray) -> pa.Array:
    """128-bit fingerprints of the sets; null for empty ones."""
    out = np.zeros((len(offs) - 1, 2), dtype=np.uint64)
    some = np.flatnonzero(np.diff(offs) > 0)
    if len(some):
        x = sh.view(np.uint64)
        out[some, 0] = np.add.reduceat(tb.mix(x), offs[some])
        out[some, 1] = np.add.reduceat(tb.mix(x ^ tb.MIX_A), offs[some])
    ids = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(out), [None, pa.py_buffer(out)]).cast(pa.binary())
    return pc.if_else(pa.array(np.diff(offs) > 0), ids, pa.scalar(None, pa.binary()))


def marks(docs: DataFrame, words: int, percent: int, classes) -> DataFrame:
    """(id, cid, n, p1) of each row of ``docs`` (id, text): fingerprint and size of
    its set, and its lengthened prefix under the first order."""
    p1 = _first_prefix(classes, percent, extra=True)
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in tb.slices(batch, "text"):
                offs, sh, of = token_sets(part.column(1), words)
                yield pa.RecordBatch.from_arrays([part.column(0), _class_ids(offs, sh), pa.array(np.diff(offs)), p1(offs, sh, of)],
                                                 names=["id", "cid", "n", "p1"])

    return docs.mapInArrow(run, f"id {kind}, cid binary, n bigint, p1 array<bigint>")


def _of_classes(docs: DataFrame, wanted: DataFrame, words: int, schema: str, columns) -> DataFrame:
    """Columns that ``columns`` makes of (offsets, shingles, word slots), for the classes
    ``wanted`` (cid, id). Tasks leave out other documents by a Bloom filter of the ids;
    the join on the class then is exact."""
    keys = bloom.build(wanted.select(F.xxhash64("id").alias("h")))
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        for batch in batches:
            batch = batch.filter(pa.array(bloom.test(keys, batch.column(0).to_numpy())))
            for part in tb.slices(batch, "text"):
                offs, sh, of = token_sets(part.column(1), words)
                yield pa.RecordBatch.from_arrays([_class_ids(offs, sh), *columns(offs, sh, of)], names=names)

    found = docs.select(F.xxhash64("id").alias("h"), "text").mapInArrow(run, schema)
    return found.join(if_small(wanted), "cid", "left_semi")


def _first_prefix(classes, percent: int, extra: bool = False):
    rare = classes[0]
    return lambda offs, sh, of: _lists(*prefix(offs, sh, rare[of].min(axis=1) if len(of) else np.zeros(0, np.uint8), percent, extra))


def _second_prefix(classes, percent: int, extra: bool = False):
    often = classes[1]
    return lambda offs, sh: _lists(*prefix(offs, sh, often[_shingle_slots(sh)], percent, extra))


def other_prefixes(docs: DataFrame, wanted: DataFrame, words: int, percent: int, classes) -> DataFrame:
    """(cid, n, p2, p3): lengthened prefixes of the classes ``wanted`` under the other orders."""
    p2 = _second_prefix(classes, percent, extra=True)

    def columns(offs, sh, of):
        p3 = prefix(offs, sh, np.zeros(len(sh), np.uint8), percent, extra=True)
        return pa.array(np.diff(offs)), p2(offs, sh), _lists(*p3)

    return _of_classes(docs, wanted, words, "cid binary, n bigint, p2 array<bigint>, p3 array<bigint>", columns)


def _short(lists: pa.Array) -> pa.Array:
    """The upper halves of the elements, for filters that may only err by letting pass."""
    return pa.ListArray.from_arrays(lists.offsets, pa.array((lists.values.to_numpy() >> 32).astype(np.int32)))


def full_sets(docs: DataFrame, wanted: DataFrame, words: int, percent: int, classes) -> DataFrame:
    """(cid, n, s, p1, p2, p3): whole sets of the classes ``wanted`` (cid, id), and
    the upper halves of their prefixes under the three orders."""
    p1, p2 = _first_prefix(classes, percent), _second_prefix(classes, percent)

    def columns(offs, sh, of):
        p3 = _lists(*prefix(offs, sh, np.zeros(len(sh), np.uint8), percent))
        return pa.array(np.diff(offs)), _lists(offs, sh), _short(p1(offs, sh, of)), _short(p2(offs, sh)), _short(p3)

    return _of_classes(docs, wanted, words, "cid binary, n bigint, s array<bigint>, p1 array<int>, p2 array<int>, p3 array<int>",
                       columns)


class _Sets:
    """Inverted list of some sets: how many elements each shares with another set."""

    def __init__(self, sets: list[np.ndarray]):
        self.n = len(sets)
        flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(self.n), [len(x) for x in sets])
        order = np.argsort(flat, kind="stable")
        self.flat, self.owner = flat[order], owner[order]

    def shared(self, values: np.ndarray) -> np.ndarray:
        lo, hi = np.searchsorted(self.flat, values, "left"), np.searchsorted(self.flat, values, "right")
        return np.bincount(self.owner[tb.ragged(lo, hi - lo)], minlength=self.n)

    def below(self, value: int) -> np.ndarray:
        return np.bincount(self.owner[:np.searchsorted(self.flat, value, "left")], minlength=self.n)


def _sized(size: np.ndarray, n: int, percent: int) -> np.ndarray:
    return 100 * np.minimum(size, n) >= percent * np.maximum(size, n)


def _groups(table: pa.Table):
    """Table sorted by group (centre, blk) and class, (probes, base) rows of each group
    that has both, and a number for each row's component."""
    table = table.sort_by([(c, "ascending") for c in ("centre", "blk", "cid")])
    group = list(zip(table.column("centre").to_pylist(), table.column("blk").to_pylist()))
    probe, base = (np.array(table.column(c).to_pylist(), dtype=bool) for c in ("probe", "base"))
    starts = [k for k in range(len(group)) if k == 0 or group[k] != group[k - 1]] + [len(group)]
    sides = [(at + np.flatnonzero(probe[at:end]), at + np.flatnonzero(base[at:end])) for at, end in zip(starts, starts[1:])]
    part = pc.dictionary_encode(table.column("part").combine_chunks()).indices.to_numpy().copy()
    return table, [(p, b) for p, b in sides if len(p) and len(b)], part


def _arrays(table: pa.Table, column: str) -> list[np.ndarray]:
    return [np.asarray(x, dtype=np.int64) for x in table.column(column).to_numpy()]


def _thin(table: pa.Table, percent: int) -> pa.Table:
    """The rows of ``table`` with a partner of another component in their group whose size
    allows a link and whose prefixes theirs meet under every order; ``probe`` and ``base``
    say on which side.

    Under the third order, where prefixes ascend, elements below the smaller of both last
    ones are in both prefixes or not shared: the intersection is at most what the prefixes
    share and the fewer of the other elements, which has to be enough for a link. Halved
    elements keep the order; equal halves of different elements only raise the bound."""
    table, groups, part = _groups(table)
    size = table.column("n").to_numpy()
    prefixes = [_arrays(table, c) for c in ("p1", "p2", "p3")]
    last = np.array([p[-1] for p in prefixes[2]], dtype=np.int64)
    asks, asked = np.zeros(len(size), bool), np.zeros(len(size), bool)
    for probe, base in groups:
        orders = [_Sets([p[b] for b in base]) for p in prefixes]
        for k in probe:
            can = _sized(size[base], size[k], percent) & (part[base] != part[k])
            for p, order in zip(prefixes, orders):
                if not can.any():
                    break
                common = order.shared(p[k])
                can &= common > 0
            if can.any():
                mine = np.searchsorted(prefixes[2][k], last[base], "left")
                beyond = np.minimum(size[k] - mine, size[base] - orders[2].below(last[k]))
                can &= (100 + percent) * (common + beyond) >= percent * (size[k] + size[base])
            asks[k] = can.any()
            asked[base] |= can
    out = table.select(["centre", "blk", "cid", "n", "part"]).append_column("probe", pa.array(asks)).append_column("base", pa.array(asked))
    return out.filter(pa.array(asks | asked))


def _compare(table: pa.Table, percent: int) -> pa.Table:
    """Links (u, v) of the groups in ``table``: probes against the rest, by full sets.
    Classes linked on the way are one component from then on."""
    table, groups, part = _groups(table)
    cid, sets = table.column("cid").to_pylist(), _arrays(table, "s")
    size = np.array([len(x) for x in sets])
    found = []
    for probe, base in groups:
        whole = None
        for k in probe:
            can = _sized(size[base], size[k], percent) & (part[base] != part[k])
            if not can.any():
                continue
            whole = whole or _Sets([sets[b] for b in base])
            inter = whole.shared(sets[k])
            for b in base[can & (100 * inter >= percent * (size[base] + size[k] - inter))]:
                if part[b] != part[k]:
                    found.append((cid[k], cid[b]))
                    part[part == part[b]] = part[k]
    return pa.table({"u": pa.array([x[0] for x in found], pa.binary()), "v": pa.array([x[1] for x in found], pa.binary())})


def _dealt(rows: DataFrame, sets: DataFrame, shingles: int):
    """``rows`` with columns of their classes; groups are dealt into buckets of some
    ``BUCKET_SHINGLES``, each group whole."""
    buckets = max(1, shingles // BUCKET_SHINGLES)
    both = sets.join(if_small(rows), "cid").withColumn("bucket", F.pmod(F.xxhash64("centre", "blk"), F.lit(buckets)))
    return both.groupBy("bucket")


def _compared(rows: DataFrame, sets: DataFrame, shingles: int, percent: int) -> DataFrame:
    """Links of ``rows`` (centre, blk, cid, part, probe, base), whose classes have
    ``shingles`` in all: by prefixes first, then by the full sets of what is left."""
    near = _dealt(rows, sets.select("cid", "n", "p1", "p2", "p3"), 2 * shingles * (100 - percent) // 100).applyInArrow(
        lambda table: _thin(table, percent),
        "centre binary, blk string, cid binary, n bigint, part binary, probe boolean, base boolean")
    near = written(near, "join-near")
    left = int(near.agg(F.sum("n")).first()[0] or 0)
    return _dealt(near, sets.select("cid", "s"), left).applyInArrow(
        lambda table: _compare(table, percent), "u binary, v binary")


def _bucket_keys(percent: int) -> tuple:
    """Columns of the two bucket keys of a prefix element ``token`` of a set of ``n``:
    the element with the set's size band, and with the next one. Sets whose sizes
    allow a link have one of them in common."""
    band = _band(F.col("n"), percent)
    return tuple(F.col("token").bitwiseXOR((band + k) * F.lit(BAND_STEP)) for k in (0, 1))


def _band(n, percent: int):
    """Size band: each ends where sizes exceed its beginning by the most a link allows."""
    return F.floor(F.log(n.cast("double")) / math.log(100 / min(percent, 99.9)) + 1e-9).cast("bigint")


def shared_prefixes(classes: DataFrame, elements: str, percent: int) -> DataFrame:
    """(key, cid, n): bucket keys of ``classes`` (cid, n, a lengthened prefix) that have two
    classes and more whose sizes allow a link. Elements are counted first; those of one
    class are left out by a Bloom filter, and so is a class with fewer others than it
    would share with a similar one, before keys are made of the prefix and counted."""
    token = classes.select(F.explode(elements).alias("token"))
    repeated = written(token.groupBy("token").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("token"), "join-tokens")
    filled = bloom.build(repeated, "token")

    def run(batches):
        for batch in batches:
            lists, n = batch.column(2), batch.column(1).to_numpy()
            token, length = lists.flatten().to_numpy(), pc.list_value_length(lists).to_numpy()
            owner = np.repeat(np.arange(batch.num_rows), length)
            place = np.arange(len(token)) - np.repeat(np.cumsum(length) - length, length)
            hit = bloom.test(filled, token)
            enough = np.bincount(owner[hit], minlength=batch.num_rows) >= least_shared(n, percent)
            some = np.flatnonzero(hit & enough[owner] & (place < prefix_length(n, percent)[owner]))
            of = pa.array(owner[some])
            yield pa.RecordBatch.from_arrays([pa.array(token[some]), batch.column(0).take(of), batch.column(1).take(of)],
                                             names=["token", "cid", "n"])

    found = classes.select("cid", "n", elements).mapInArrow(run, "token bigint, cid binary, n bigint")
    found = found.select("cid", "n", F.explode(F.array(*_bucket_keys(percent))).alias("key"))
    found = written(found, "join-keys")
    drop(repeated)
    counts = found.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("n").alias("low"), F.max("n").alias("high"))
    # a key of two classes is one pair, and its sizes may rule it out at once
    can = (F.col("c") > 1) & ((F.col("c") > 2) | (100 * F.col("low") >= percent * F.col("high")))
    return found.join(counts.filter(can).select("key"), "key", "left_semi")


def _star_links(close: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) of classes with their centre (cid, n, centre), which comes along once
    for each block of its classes."""
    yes, no = F.lit(True), F.lit(False)
    close = written(close.select("cid", "n", "centre"), "join-close")
    total = close.groupBy("centre").agg(F.sum("n").alias("total"))
    blocks = F.ceil(F.col("total") / BLOCK_SHINGLES)
    star = close.join(total, "centre").select(
        "centre", F.pmod(F.xxhash64("cid"), blocks).cast("string").alias("blk"), "cid", F.col("cid").alias("part"),
        no.alias("probe"), yes.alias("base"))
    heads = total.select("centre", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int")).cast("array<string>")).alias("blk"),
                         F.col("centre").alias("cid"), F.col("centre").alias("part"), yes.alias("probe"), no.alias("base"))
    volume = int(close.agg(F.sum("n")).first()[0] or 0)
    return _compared(written(star.unionByName(heads), "join-stars"), sets, volume, percent)


def bucket_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) that give the components of all linked classes among those that
    ``members`` (centre, cid, n, near) brings together: of any two classes of a centre
    that link, both end up in one component."""
    close = members.filter("near")
    first = close.groupBy("cid").agg(F.min("centre").alias("centre"))
    links = written(_star_links(close.join(first, ["cid", "centre"], "left_semi"), sets, percent), "join-links")
    parts = written(components(links), "join-parts")
    drop(links)
    # the other centres of a class, unless they are in its component already
    of = parts.select(F.col("node").alias("cid"), F.col("component").alias("part"))
    main = parts.select(F.col("node").alias("centre"), F.col("component").alias("main"))
    open_ = close.join(first, ["cid", "centre"], "left_anti").join(of, "cid", "left").join(main, "centre", "left").filter(
        F.coalesce("part", "cid") != F.coalesce("main", "centre")).select("cid", "centre", "n")
    tree = parts.select(F.col("node").alias("u"), F.col("component").alias("v"))
    links = written(tree.unionByName(_star_links(open_, sets, percent)), "join-links")
    parts = written(components(links), "join-parts")

    yes, no = F.lit(True), F.lit(False)
    # what the centre leaves apart, by size bands: sizes of a link differ by one band at most
    part = parts.withColumnRenamed("node", "cid")
    main = parts.select(F.col("node").alias("centre"), F.col("component").alias("main"))
    band = _band(F.col("n"), percent)
    around = members.select("centre", "cid", "n").join(part, "cid", "left").join(main, "centre", "left").select(
        "centre", "cid", "n", F.coalesce("component", "cid").alias("part"), band.alias("band"),
        (F.coalesce("component", "cid") != F.coalesce("main", "centre")).alias("out"))
    around = written(around, "join-around")
    few = around.groupBy("centre").agg(F.count(F.lit(1)).alias("c"), F.count_if("out").alias("o")).filter("o > 0 and c > 1")
    around = around.join(few.select("centre"), "centre", "left_semi")
    some = around.groupBy("centre", "band").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("bb"))
    out = around.filter("out").select("centre", "cid", "n", "part", F.explode(F.array(*[F.col("band") + k for k in (-1, 0, 1)])).alias("band"))
    asked = out.groupBy("centre", "band").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("pb"))
    plan = some.join(asked, ["centre", "band"])                   # bands with classes and with probes
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    mine = lambda n: F.pmod(F.xxhash64("cid"), F.col(n)).cast("int")
    cols = ["centre", "band", "cid", "n", "part"]
    base = around.join(plan, ["centre", "band"]).select(*cols, mine("bb").alias("x"), every("pb").alias("y"), no.alias("probe"), yes.alias("base"))
    probe = out.join(plan, ["centre", "band"]).select(*cols, mine("pb").alias("y"), every("bb").alias("x"), yes.alias("probe"), no.alias("base"))
    rows = written(base.unionByName(probe).withColumn("blk", F.concat_ws("/", "band", "x", "y")).drop("band", "x", "y").withColumnRenamed("n", "weight"), "join-blocks")
    volume = int(rows.agg(F.sum("weight")).first()[0] or 0)
    more = written(_compared(rows, sets, volume, percent), "join-links")
    tree = parts.select(F.col("node").alias("u"), F.col("component").alias("v"))
    for df in (links, around, rows):
        drop(df)
    return tree.unionByName(more)


def similarity_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    min_percent: int = MIN_PERCENT) -> DataFrame:
    """Component of every document of ``docs``: ``id_col``, n_shingles, component_id.

    Two documents link if 100 * |intersection| >= ``min_percent`` * |union| of their sets
    of distinct ``words``-word shingles; ``component_id`` is the smallest id reachable by
    links, the document's own included. A text with fewer words is one shingle; a text
    without words, or null, has an empty set and links with nothing. Rows with one id
    are one node, linked by any of their texts; a row with a null id links with nothing
    and has a null component. Long texts enter whole, an empty table gives no rows, and
    other columns are not read.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    classes = slot_classes(src, words)
    rows = written(marks(src, words, min_percent, classes), "join-marks")
    known = rows.filter("cid is not null and id is not null")
    one = written(known.groupBy("cid").agg(F.min(F.struct("id", "n", "p1")).alias("m")).select("cid", "m.id", "m.n", "m.p1"),
                  "join-classes")
    # a class stays in if it shares a prefix element under each of the orders
    first = written(shared_prefixes(one, "p1", min_percent), "join-prefixes")
    # prefixes are read no more: keep the narrow columns, free the rest
    marked, led = rows, one
    rows, one = written(marked.select("id", "cid", "n"), "join-ids"), written(led.select("cid", "id"), "join-leads")
    known = rows.filter("cid is not null and id is not null")
    drop(marked)
    drop(led)
    asked = written(one.select("cid", "id").join(first.select("cid").distinct(), "cid", "left_semi"), "join-asked")
    again = not known.groupBy("id", "cid").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").isEmpty()
    others = other_prefixes(src, asked, words, min_percent, classes)
    others = written(others.dropDuplicates(["cid"]) if again else others, "join-others")   # rows equal in id and text
    second = written(shared_prefixes(others, "p2", min_percent).select("cid").distinct(), "join-second")
    third = shared_prefixes(others.join(second, "cid", "left_semi"), "p3", min_percent).select("cid").distinct()
    alive = written(asked.join(third, "cid", "left_semi"), "join-alive")
    spread = written(first.join(if_small(alive), "cid", "left_semi"), "join-spread")
    centres = spread.groupBy("key").agg(F.min(F.struct("cid", "n")).alias("c"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    near = 100 * F.least("n", "c.n") >= min_percent * F.greatest("n", "c.n")
    for df in (first, others, second):
        drop(df)
    members = written(spread.join(centres, "key").filter(F.col("cid") != F.col("c.cid")).filter((F.col("k") > 2) | near)
                      .select(F.col("c.cid").alias("centre"), "cid", "n", near.alias("near")).distinct(), "join-members")
    met = members.select("cid").unionByName(members.select(F.col("centre").alias("cid"))).distinct()
    met = written(alive.join(met, "cid", "left_semi"), "join-met")
    for df in (asked, alive, spread):
        drop(df)
    sets = full_sets(src, met, words, min_percent, classes)
    sets = written(sets.dropDuplicates(["cid"]) if again else sets, "join-sets")
    links = bucket_links(members, sets, min_percent)
    # an id with several texts links their classes
    twice = known.groupBy("id").agg(F.min("cid").alias("u"), F.max("cid").alias("w")).filter("u != w").select("id", "u")
    same = known.select("id", F.col("cid").alias("v")).join(twice, "id").select("u", "v")
    parts = written(components(links.unionByName(same)), "join-parts").withColumnRenamed("node", "cid")
    drop(sets)

    part = F.coalesce("component", "cid")
    named = one.select("cid", "id").join(parts, "cid", "left").select("cid", "id", part.alias("part"))
    least = named.groupBy("part").agg(F.min("id").alias("least"))
    named = written(named.join(least, "part").select("cid", "least"), "join-named")
    own = F.when(F.col("id").isNotNull(), F.coalesce("least", "id"))
    # of an id with several rows, an empty one follows the others
    solo = written(rows.join(named, "cid", "left").select("id", "n", own.alias("least")), "join-rows")
    mixed = solo.filter("id is not null").groupBy("id").agg(F.min("least").alias("lead"), F.max("least").alias("l")).filter("lead != l")
    return solo.join(mixed.select("id", "lead"), "id", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("lead", "least").alias("component_id"))
