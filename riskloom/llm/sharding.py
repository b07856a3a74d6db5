"""Sharding of a corpus by minimax contiguous partition (operator 5).

Equal texts form an atomic group. Groups are ordered by the SHA-256 of their
text; the shards are contiguous runs of that order. The smallest feasible shard
capacity is found by binary search, a capacity being checked greedily, and the
order is cut there. Only sums of a bounded number of key ranges reach the
driver; then, for every capacity tried, the groups of the one range each cut
falls into, ``MAX_FETCHED`` groups in all at most. A row finds its shard by
comparing its key with the cuts, so nothing is joined and a group of any size is
handled by its rows' own tasks.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.store import drop, written

LAW = "bytes"
#: Groups in a key range, on average, at most; and the longest range prefix.
GROUPS_PER_RANGE = 2048
MAX_PREFIX = 5                     # hex digits: at most 16^5 range sums on the driver
#: Groups fetched to place the cuts, at most; more is an error.
MAX_FETCHED = 1_000_000
#: Rows that one task numbers, on average.
ROWS_PER_SLOT_BLOCK = 100_000


def cuts_for(prefix: np.ndarray, capacity: int, n_shards: int) -> np.ndarray | None:
    """Ends of the greedy shards among the known prefix sums (ascending, from 0
    to the total), or None if ``n_shards`` of that capacity don't suffice."""
    at, ends = 0, []
    for _ in range(n_shards):
        k = int(np.searchsorted(prefix, at + capacity, side="right")) - 1
        if prefix[k] == at and at < prefix[-1]:
            return None
        at = int(prefix[k])
        ends.append(at)
    return np.array(ends) if at == prefix[-1] else None


def smallest_capacity(prefix: np.ndarray, low: int, high: int, n_shards: int) -> int:
    """Binary search of the least feasible capacity in [low, high]; ``high`` is feasible."""
    while low < high:
        mid = (low + high) // 2
        if cuts_for(prefix, mid, n_shards) is None:
            low = mid + 1
        else:
            high = mid
    return low


def shard_documents(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shard of every row: ``id_col``, size, text_crc32, law, shard, slot, grown_shard.

    A null text counts as an empty one: size 1, checksum 0, one group with empty
    texts. Null and repeated ids are carried, each row with a slot of its own; an
    empty table gives no rows; with fewer groups than shards the last shards stay
    empty; other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    raw = F.encode(text, "UTF-8")
    rows = written(docs.select(F.col(id_col).alias("id"), F.sha2(raw, 256).alias("key"),
                               (F.octet_length(text) + 1).cast("bigint").alias("size"),
                               F.crc32(raw).alias("text_crc32")), "shard-rows")
    groups = written(rows.groupBy("key").agg(F.sum("size").alias("size")), "shard-groups")
    cut_keys = _cut_keys(groups, n_shards)
    drop(groups)

    shard = F.lit(0)
    for key in cut_keys:
        shard = shard + (F.col("key") > F.lit(key)).cast("int")
    rows = rows.withColumn("shard", shard)
    n_rows = rows.count()
    blocks = max(1, -(-n_rows // (n_shards * ROWS_PER_SLOT_BLOCK)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id", "key"), F.lit(blocks)).cast("int"))
    # rows of each (shard, block), summed up to offsets within the shard; repeated
    # (id, text) rows fall into one block, so blocks are counted, not assumed even
    counts = sorted((r["shard"], r["block"], r["count"]) for r in rows.groupBy("shard", "block").count().collect())
    offsets, base, last = [], 0, None
    for s, b, n in counts:
        base = base if s == last else 0
        offsets.append((s, b, base))
        base, last = base + n, s
    table = docs.sparkSession.createDataFrame(offsets, "shard int, block int, base bigint")
    w = Window.partitionBy("shard", "block").orderBy("id", "key")
    return (rows.withColumn("n", F.row_number().over(w)).join(F.broadcast(table), ["shard", "block"])
            .select(F.col("id").alias(id_col), "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
                    (F.col("base") + F.col("n") - 1).cast("bigint").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))


def _cut_keys(groups: DataFrame, n_shards: int) -> list[str]:
    """Keys of the last group of every shard but the last one."""
    n = groups.count()
    if n == 0:
        return []
    digits = next(d for d in range(MAX_PREFIX + 1) if d == MAX_PREFIX or 16 ** d * GROUPS_PER_RANGE >= n)
    ranged = groups.withColumn("range", F.substring("key", 1, digits) if digits else F.lit(""))
    sums = sorted((r["range"], r["size"], r["most"], r["n"]) for r in ranged.groupBy("range").agg(
        F.sum("size").alias("size"), F.max("size").alias("most"), F.count(F.lit(1)).alias("n")).collect())
    names = [s[0] for s in sums]
    bounds = np.concatenate([[0], np.cumsum([s[1] for s in sums], dtype=np.int64)])
    total = int(bounds[-1])
    low = max(-(-total // n_shards), max(s[2] for s in sums))
    # ranges taken as groups: their least capacity is feasible for the groups too
    high = smallest_capacity(bounds, max(low, int(np.diff(bounds).max())), total, n_shards)
    inside: dict[int, tuple[np.ndarray, np.ndarray]] = {}      # ends and keys of the groups of a range

    def fetch(first: int, guesses: list[int]) -> None:
        held = sum(sums[i][3] for i in inside) + sums[first][3]
        if held > MAX_FETCHED:
            raise ValueError(f"the cuts need the sizes of {held} groups on the driver, more than {MAX_FETCHED}")
        new = [first]
        for i in guesses:                                      # later cuts' ranges, as far as there is room
            if i < len(names) and i not in inside and i not in new and held + sums[i][3] <= MAX_FETCHED // 2:
                new.append(i)
                held += sums[i][3]
        got: dict[str, list] = {names[i]: [] for i in new}
        for r in ranged.filter(F.col("range").isin(list(got))).select("range", "key", "size").collect():
            got[r["range"]].append((r["key"], r["size"]))
        for i in new:
            rows = sorted(got[names[i]])
            inside[i] = (bounds[i] + np.cumsum([x[1] for x in rows], dtype=np.int64), np.array([x[0] for x in rows], "S64"))

    def greedy(capacity: int) -> list[tuple[int, str]] | None:
        """(end, key) of the greedy shards, or None if ``n_shards`` don't suffice."""
        at, ends = 0, []
        for left in range(n_shards, 0, -1):
            if total - at > left * capacity:
                return None
            ahead = [int(np.searchsorted(bounds, at + capacity * j, side="right")) - 1 for j in range(1, left + 1)]
            i = ahead[0]
            if i == len(names):
                return ends
            end, key = int(bounds[i]), names[i - 1] + "g"      # the end of a whole range: past all keys in it
            if end < at + capacity:
                if i not in inside:
                    fetch(i, ahead[1:])
                k = int(np.searchsorted(inside[i][0], at + capacity, side="right")) - 1
                if k >= 0:
                    end, key = int(inside[i][0][k]), inside[i][1][k].decode()
            at = end
            ends.append((end, key))
        return None

    while low < high:
        mid = (low + high) // 2
        if greedy(mid) is None:
            low = mid + 1
        else:
            high = mid
    return [key for _, key in greedy(low)]
