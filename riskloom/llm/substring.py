"""Repeated passages across documents (operator 6).

Two kinds of paragraph go through the same steps: fingerprint, first occurrence,
removal of the others.

* Lines of ``MIN_LINE_WORDS`` words and more: MinHash signatures are banded, with
  as many bands as the wanted recall takes, colliding lines are joined to their
  bucket's centre (and, where the triangle inequality leaves it open, to each
  other), the exact Jaccard similarity of their shingle sets is verified, and the
  components of the confirmed links are the groups of which one line stays.
* Passages inside lines or across them: paragraphs of ``UNIT_WORDS`` words that
  start at anchors chosen by content, the least shingle hash of every
  ``WINNOW`` consecutive ones. A passage of 50 words or more holds the same
  anchor in every text, so each repeated one shares a whole paragraph. These have
  to be equal word for word.
"""

from __future__ import annotations

import math
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import bloom
from riskloom.llm import textbatch as tb
from riskloom.llm.components import components
from riskloom.llm.neardup import _as_links, band_keys, open_links, verified
from riskloom.llm.store import drop, if_small, written

SHINGLE_WORDS = 5
MIN_PERCENT = 80
MIN_LINE_WORDS = 20
UNIT_WORDS = 30
WINNOW = 21                        # 50 words: 46 shingles, 26 of a paragraph and 20 before it at most
ROWS = 3
RECALL = 0.999
UNIT, LINE = 0, 1                  # kinds of paragraph


def bands_for(similarity: float, rows: int, recall: float) -> int:
    """Least number of bands that joins a pair at ``similarity`` with probability ``recall``."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity ** rows)))


def _sliding(x: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` over ``x[i:i + width]`` for every i, by doubling."""
    done, out = 1, x
    while done * 2 <= width:
        out = op(out[:-done], out[done:])
        done *= 2
    return op(out[:len(out) - (width - done)], out[width - done:]) if done < width else out


def anchors(h: np.ndarray, doc: np.ndarray, winnow: int) -> np.ndarray:
    """Positions whose hash is least among some ``winnow`` consecutive ones of its document."""
    n = len(h) - winnow + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    h = np.maximum(h, np.uint64(1))
    least = _sliding(h, winnow, np.minimum)
    least[doc[:n] != doc[winnow - 1:]] = 0                     # not within one document
    pad = np.zeros(winnow - 1, np.uint64)
    most = _sliding(np.concatenate([pad, least, pad]), winnow, np.maximum)   # windows that hold position i
    return np.flatnonzero(h == most)


def _tile_prints(sh: np.ndarray, at: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """128-bit fingerprint of the ``words`` words from each shingle index of
    ``at``, made of the shingles that tile them."""
    hi = np.full(len(at), tb.MIX_A)
    lo = np.full(len(at), tb.MIX_B)
    for j in [*range(0, words - SHINGLE_WORDS, SHINGLE_WORDS), words - SHINGLE_WORDS]:
        x = sh[at + j]
        hi = tb.mix(hi ^ x) + x
        lo = tb.mix(lo + x)
    return hi.view(np.int64), lo.view(np.int64)


def _words(column: pa.Array):
    data, offs = tb.text_bytes(column)
    s, e, doc = tb.word_spans(tb.LOWER[data], offs)
    return data, offs, s, e, doc, tb.word_hashes(tb.LOWER[data], s, e)


def _line_groups(data, offs, s, doc) -> tuple[np.ndarray, np.ndarray]:
    """(first word, number of words) of every line with words."""
    if len(s) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    line = np.searchsorted(np.flatnonzero(data == 0x0A), s)
    new = np.ones(len(s), dtype=bool)
    new[1:] = (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, len(s)))


def _unit_table(part: pa.RecordBatch, words, unit_words: int, winnow: int) -> pa.RecordBatch:
    _, offs, s, e, doc, h = words
    sh, pos = tb.shingle_hashes(h, doc, SHINGLE_WORDS)
    at = anchors(sh, doc[pos], winnow)
    span = unit_words - SHINGLE_WORDS                          # shingles of a document follow each other
    at = at[at + span < len(sh)]
    at = at[doc[pos[at]] == doc[pos[at + span]]]
    hi, lo = _tile_prints(sh, at, unit_words)
    first = pos[at]
    return _occurrence(part, UNIT, hi, lo, doc[first], s[first] - offs[doc[first]],
                       e[first + unit_words - 1] - offs[doc[first]])


def repeated_units(docs: DataFrame, unit_words: int, winnow: int) -> DataFrame:
    """(kind, hi, lo) of the anchored paragraphs that occur twice and more in ``docs`` (id, key, text)."""

    def run(batches):
        for batch in batches:
            for part in tb.slices(batch, "text"):
                yield _unit_table(part, _words(part.column(2)), unit_words, winnow).select(["hi", "lo"])

    prints = docs.mapInArrow(run, "hi bigint, lo bigint").groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("c"))
    return prints.filter("c > 1").select(F.lit(UNIT).alias("kind"), "hi", "lo")


def _occurrence(part, kind, hi, lo, doc, first, last) -> pa.RecordBatch:
    d = pa.array(doc)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(hi), kind, np.int32)), pa.array(hi), pa.array(lo), part.column(0).take(d),
         part.column(1).take(d), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))],
        names=["kind", "hi", "lo", "id", "key", "first", "last"])


def _line_table(part: pa.RecordBatch, words, min_words: int):
    """(occurrences, shingles of all lines, first shingle of each line) of the longer
    lines. A line's fingerprint sums over its shingles, repeated ones included; lines
    equal as sets only have other fingerprints, but the same band keys."""
    data, offs, s, e, doc, h = words
    first, count = _line_groups(data, offs, s, doc)
    long = count >= max(min_words, SHINGLE_WORDS)
    first, count = first[long], count[long]
    line = np.full(len(s), -1)
    line[tb.ragged(first, count)] = np.repeat(np.arange(len(first)), count)
    sh, pos = tb.shingle_hashes(h, line, SHINGLE_WORDS)
    inside = line[pos] >= 0
    sh, owner = sh[inside], line[pos[inside]]
    begin = np.searchsorted(owner, np.arange(len(first)))
    if len(first):
        hi = np.add.reduceat(tb.mix(sh), begin).view(np.int64)
        lo = np.add.reduceat(tb.mix(sh ^ tb.MIX_A), begin).view(np.int64)
    else:
        hi = lo = np.zeros(0, np.int64)
    d = doc[first]
    return _occurrence(part, LINE, hi, lo, d, s[first] - offs[d], e[first + count - 1] - offs[d]), sh, begin


_OCCURRENCE = "kind int, hi bigint, lo bigint, id {t}, key bigint, first int, last int"


def occurrences(docs: DataFrame, unit_words: int, winnow: int, min_words: int, kinds: tuple = (),
                only: np.ndarray | None = None) -> DataFrame:
    """(kind, hi, lo, id, key, first, last): anchored paragraphs and lines of
    ``docs`` (id, key, text) by fingerprint; first and last are byte offsets. With
    ``only``, a Bloom filter of wanted ``hi``, tasks leave others out."""
    kinds = kinds or (UNIT, LINE)

    def some(rows: pa.RecordBatch) -> pa.RecordBatch:
        return rows if only is None else rows.filter(pa.array(bloom.test(only, rows.column(1).to_numpy())))

    def run(batches):
        for batch in batches:
            for part in tb.slices(batch, "text"):
                words = _words(part.column(2))
                if UNIT in kinds:
                    yield some(_unit_table(part, words, unit_words, winnow))
                if LINE in kinds:
                    yield some(_line_table(part, words, min_words)[0])

    return docs.mapInArrow(run, _OCCURRENCE.format(t=docs.schema["id"].dataType.simpleString()))


def lines(docs: DataFrame, min_words: int, bands: int, rows: int) -> DataFrame:
    """Lines as ``occurrences`` gives them, with their MinHash band ``keys``.

    The shingles are hashes already; a hash function of the signature is a xor
    with a seed of its own and a multiplication by an odd number, in 32 bits.
    """
    seeds = tb.mix(np.arange(1, bands * rows + 1, dtype=np.uint64))
    seeds = list(zip(seeds.astype(np.uint32), (seeds >> np.uint64(32)).astype(np.uint32) | np.uint32(1)))

    def run(batches):
        for batch in batches:
            for part in tb.slices(batch, "text"):
                table, sh, begin = _line_table(part, _words(part.column(2)), min_words)
                if table.num_rows == 0:
                    continue
                low = (sh >> np.uint64(32)).astype(np.uint32)
                sig = np.stack([np.minimum.reduceat((low ^ seed) * odd, begin) for seed, odd in seeds], axis=1).astype(np.uint64)
                keys = [band_keys(x, bands, rows).view(np.int64) for x in sig]
                yield pa.RecordBatch.from_arrays([*table.columns, pa.array(keys, pa.list_(pa.int64()))],
                                                 names=[*table.schema.names, "keys"])

    return docs.mapInArrow(run, _OCCURRENCE.format(t=docs.schema["id"].dataType.simpleString()) + ", keys array<bigint>")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, s): shingle sets of the lines ``wanted`` (cid, key, first, last)."""
    per_doc = written(wanted.groupBy(F.col("id").alias("of"), F.col("key").alias("text_key")).agg(
        F.collect_list(F.struct("cid", "first", "last")).alias("spans")), "line-places")

    def run(batches):
        for batch in batches:
            for text, spans in zip(batch.column(0), batch.column(1).to_pylist()):
                raw = text.as_py().encode()
                col = pa.array([raw[x["first"]:x["last"]] for x in spans], pa.binary())
                _, offs, s, e, doc, h = _words(col)
                sh, pos = tb.shingle_hashes(h, doc, SHINGLE_WORDS)
                at = np.searchsorted(doc[pos], np.arange(len(spans) + 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x["cid"] for x in spans], pa.string()),
                     pa.array([np.unique(sh[at[i]:at[i + 1]]).view(np.int64) for i in range(len(spans))],
                              pa.list_(pa.int64()))], names=["id", "s"])

    same = F.col("id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("text_key"))
    return (docs.join(if_small(per_doc), same).select("text", "spans")
            .mapInArrow(run, "id string, s array<bigint>").dropDuplicates(["id"]))


def _similar_lines(docs: DataFrame, min_words: int, min_percent: int, bands: int, rows: int) -> DataFrame:
    """(kind, hi, lo, stay) of the lines that have a similar one; ``stay`` is the group's first."""
    found = lines(docs, min_words, bands, rows)
    mark = written(found.groupBy("hi", "lo").agg(F.min(F.struct("id", "key", "first", "last")).alias("m"),
                                                 F.count(F.lit(1)).alias("c"), F.min("keys").alias("keys")),
                   "line-classes")
    classes = mark.select(F.concat_ws("/", F.hex("hi"), F.hex("lo")).alias("id"), "keys", "m", "hi", "lo", "c")
    spread = classes.select("id", F.explode("keys").alias("key"))
    centres = written(spread.groupBy("key").agg(F.min("id").alias("centre"), F.count(F.lit(1)).alias("c"))
                      .filter("c > 1").select("key", "centre"), "line-centres")
    members = written(spread.join(centres, "key"), "line-members")
    wanted = classes.join(members.select("id").distinct(), "id", "left_semi").select(
        F.col("id").alias("cid"), "m.id", "m.key", "m.first", "m.last")
    sets = written(_sets(docs, wanted), "line-sets")
    star = written(verified(members.filter("id != centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct(),
                            sets), "line-stars")
    linked = 100 * F.col("inter") >= F.lit(min_percent) * F.col("total")
    links = star.filter(linked).select(F.col("a").alias("u"), F.col("b").alias("v"))
    parts = written(components(links), "line-parts")
    rest = open_links(star, parts, sets, min_percent)
    final = components(_as_links(parts).unionByName(rest)).withColumnRenamed("node", "id")
    group = classes.join(final, "id", "left").select("hi", "lo", "m", "c", F.coalesce("component", "id").alias("part"))
    stays = group.groupBy("part").agg(F.min("m").alias("stay"), F.sum("c").alias("total")).filter("total > 1")
    repeated = written(group.join(stays, "part").select(
        F.lit(LINE).alias("kind"), "hi", "lo", F.struct("stay.id", "stay.key", "stay.first").alias("stay")), "line-groups")
    for df in (centres, members, sets, star, parts):
        drop(df)
    return repeated


def _resolved(found: DataFrame, groups: DataFrame) -> DataFrame:
    """(id, key, first, last, kept_id, stays) of the occurrences in ``found`` that
    go, and of the units that stay (``stays``), by their groups (kind, hi, lo, and
    ``stay`` of lines).

    Lines go first: of a unit, the first occurrence outside the lines that go
    stays, and where there is none, the first one.
    """
    occ = written(found.join(if_small(groups), ["kind", "hi", "lo"]), "repeated-occurrences")
    staying = F.col("id").eqNullSafe(F.col("stay.id")) & (F.col("key") == F.col("stay.key")) & (F.col("first") == F.col("stay.first"))
    # lines of a document don't overlap: the last one to begin before a unit's end reaches furthest
    w = Window.partitionBy("id", "key").orderBy(F.when(F.col("kind") == LINE, F.col("first")).otherwise(F.col("last") - 1))
    reach = F.max(F.when((F.col("kind") == LINE) & ~staying, F.col("last"))).over(w)
    units = written(
        occ.withColumn("cut", F.coalesce(reach > F.col("first"), F.lit(False))).filter(F.col("kind") == UNIT)
        .groupBy("kind", "hi", "lo").agg(F.min(F.struct("cut", "id", "key", "first")).alias("m"))
        .select("kind", "hi", "lo", F.struct("m.id", "m.key", "m.first").alias("unit")), "unit-stays")
    occ = occ.join(if_small(units), ["kind", "hi", "lo"], "left").withColumn("stay", F.coalesce("unit", "stay"))
    return occ.filter(~staying | (F.col("kind") == UNIT)).select(
        "id", "key", "first", "last", F.col("stay.id").alias("kept_id"), staying.alias("stays"))


def _outside(spans: list, kept: list[tuple[int, int]]):
    """The parts of ``spans`` outside ``kept`` (merged, ascending), by their beginning."""
    ends = [b for _, b in kept]
    out = []
    for x in spans:
        at = x["first"]
        for a, b in kept[bisect_right(ends, at):]:
            if a >= x["last"]:
                break
            if a > at:
                out.append((at, a, x["kept_id"]))
            at = b
        if at < x["last"]:
            out.append((at, x["last"], x["kept_id"]))
    return sorted(out, key=lambda p: p[:2])


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_line_words: int = MIN_LINE_WORDS,
                   unit_words: int = UNIT_WORDS, winnow: int = WINNOW, min_percent: int = MIN_PERCENT,
                   rows: int = ROWS, recall: float = RECALL) -> DataFrame:
    """Passages to remove: ``id_col``, text_key, start, stop, n_bytes, kept_ids.

    One row per maximal run of overlapping repeated paragraphs of a document, in
    UTF-8 byte offsets of its text; ``kept_ids`` lists the documents whose
    occurrences stay (possibly the document itself). Of equal or similar paragraphs the one in the
    smallest id stays (ties: by a hash of id and text, then by position; a null id
    ranks first), but of equal paragraphs the first outside the lines that go, if
    there is one; the one that stays is never cut. Rows equal in id and text count as one document. Null, empty and
    short texts have no paragraphs; an empty table gives no rows; other columns are
    not read. ``text_key`` identifies the row: xxhash64 of id and text.
    """
    src = _keyed(docs, id_col, text_col)
    groups = written(repeated_units(src, unit_words, winnow), "unit-groups")
    near = _similar_lines(src, min_line_words, min_percent, bands_for(min_percent / 100, rows, recall), rows)
    # one more pass over the texts finds the occurrences of both kinds; few of all paragraphs are repeated
    both = written(groups.unionByName(near, allowMissingColumns=True), "repeated-groups")
    only = bloom.build(both, "hi")
    again = _resolved(occurrences(src, unit_words, winnow, min_line_words, only=only), both)
    for df in (groups, near):
        drop(df)
    spans = again.groupBy("id", "key").agg(
        F.sort_array(F.collect_set(F.struct("first", "last", "kept_id", "stays"))).alias("spans")).filter(
        F.exists("spans", lambda x: ~x["stays"]))
    id_type = docs.schema[id_col].dataType

    def merge(batches):
        for batch in batches:
            out = []
            for i, k, ss in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                kept: list[tuple[int, int]] = []
                for x in ss:
                    if x["stays"]:
                        if kept and x["first"] <= kept[-1][1]:
                            kept[-1] = (kept[-1][0], max(kept[-1][1], x["last"]))
                        else:
                            kept.append((x["first"], x["last"]))
                runs: list[list] = []
                for first, last, kept_id in _outside([x for x in ss if not x["stays"]], kept):
                    if runs and first <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], last)
                        runs[-1][2].add(kept_id)
                    else:
                        runs.append([first, last, {kept_id}])
                out += [(i, k, a, b, sorted(ids, key=lambda v: (v is not None, v))) for a, b, ids in runs]
            cols = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], batch.schema.field(0).type), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()),
                 pa.array(cols[3], pa.int32()), pa.array([b - a for a, b in zip(cols[2], cols[3])], pa.int32()),
                 pa.array(cols[4], pa.list_(batch.schema.field(0).type))],
                names=["id", "text_key", "start", "stop", "n_bytes", "kept_ids"])

    t = id_type.simpleString()
    return spans.mapInArrow(merge, f"id {t}, text_key bigint, start int, stop int, n_bytes int, kept_ids array<{t}>"
                            ).withColumnRenamed("id", id_col)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), text).alias("key"), text.alias("text"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the passages of ``repeated_spans``: all columns, the text
    cut; a document left without a word goes. Documents without such a passage
    are returned as they are, null texts included."""
    per_doc = written(repeated_spans(docs, id_col, text_col, **options).groupBy(F.col(id_col).alias("of"), "text_key").agg(
        F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans")), "repeated-spans")
    text = F.col("row").getField(text_col)
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).withColumn("id", F.col("row").getField(id_col)).withColumn("key", F.xxhash64("id", F.coalesce(text, F.lit(""))))
    both = keyed.join(if_small(per_doc), F.col("id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("text_key")), "left")
    # what lies before, between and behind the cut passages, by bytes
    raw = F.encode(text, "UTF-8")
    starts = F.concat(F.array(F.lit(0)), F.transform("spans", lambda x: x["stop"]))
    stops = F.concat(F.transform("spans", lambda x: x["start"]), F.array(F.octet_length(text)))
    parts = F.zip_with(starts, stops, lambda a, b: F.decode(F.substring(raw, a + 1, b - a), "UTF-8"))
    cut = F.when(F.col("spans").isNull(), text).otherwise(F.array_join(parts, ""))
    out = both.withColumn("cut", cut).filter(F.col("spans").isNull() | F.col("cut").rlike(r"[^\x20\x09-\x0D]"))
    return out.select(*[F.col("cut").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])
