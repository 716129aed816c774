"""Sharding by minimax contiguous partition: equal texts stay together, the largest shard is as small as it can be.

Groups of equal texts stand in the order of a hash.  The smallest feasible capacity is found by binary
search, each capacity checked greedily: fill a shard until the next group doesn't fit, then cut.  Groups
above the mean of what is left get a shard of their own first, so that one huge group doesn't leave
other shards empty.

The driver never holds all groups.  It sees sums over cells of the hash; where a cut may fall into a cell,
that cell is divided by Spark into finer ones, until every cut lies between two groups.  A level divides only
the cells at the cuts, so what is collected is bounded by the number of shards, not by the data.

Defined results: a NULL text has size 1 and checksum 0 and forms a group with other NULL texts; the empty text is
another group.  Repeated rows get slots of their own.  An empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import any_of, numbered, stored, table

SHARDS = 16
KEY_BITS, FIRST_BITS, MORE_BITS = 60, 12, 6


def with_group(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32`` and ``key``: 60 bits of the text's MD5, -1 for NULL.  Texts equal in key are one group."""
    text = F.col("text").cast("binary")
    return docs.select("doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
                       F.coalesce(F.crc32(text), F.lit(0)).cast("bigint").alias("text_crc32"),
                       F.coalesce(F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("bigint"), F.lit(-1)).alias("key"))


class Cells:
    """Sums of group sizes over ordered, disjoint ranges of the key."""

    def __init__(self, cells: list[tuple[int, int, int]]):
        """Cells ``(first key, bytes, groups)`` in order of the key."""
        self.cells = sorted(cells)
        self.ends, total = [0], 0
        for _, size, _ in self.cells:
            total += size
            self.ends.append(total)
        self.total = total

    def step(self, start: int, capacity: int, hopeful: bool) -> int:
        """Where the greedy shard from ``start`` ends at the earliest, or, ``hopeful``, at the latest."""
        reach = start + capacity
        k = bisect_right(self.ends, reach) - 1
        if hopeful and k < len(self.cells) and self.cells[k][2] > 1:
            return reach  # a boundary inside the cell may lie there
        return max(self.ends[k], start)

    def cuts(self, capacity: int, shards: int, hopeful: bool) -> list[int]:
        out = [0]
        for _ in range(shards):
            out.append(min(self.total, self.step(out[-1], capacity, hopeful)))
        return out

    def least(self, shards: int, hopeful: bool) -> int:
        """Smallest capacity, by binary search, with which the greedy cuts reach the end."""
        low, high = -(-self.total // shards), self.total
        while low < high:
            middle = (low + high) // 2
            if self.cuts(middle, shards, hopeful)[-1] >= self.total:
                high = middle
            else:
                low = middle + 1
        return low

    def open_ranges(self, shards: int) -> list[tuple[int, int]]:
        """Ranges of cells, one for each cut at most, from the first to the last cell of several groups into which that
        cut may fall for some capacity that may be the smallest."""
        low, high = self.least(shards, True), self.least(shards, False)
        early, late = self.cuts(low, shards, False), self.cuts(high, shards, True)
        found: list[tuple[int, int]] = []
        for k in range(shards):
            first = max(0, bisect_right(self.ends, early[k] + low) - 1)
            last = bisect_left(self.ends, min(late[k] + high, self.total - 1) + 1)
            several = [c for c in range(first, min(last, len(self.cells))) if self.cells[c][2] > 1]
            if several:
                begin, end = several[0], several[-1] + 1
                if found and begin <= found[-1][1]:
                    begin, end = found[-1][0], max(end, found.pop()[1])
                found.append((begin, end))
        return found


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """Smallest capacity and the first keys of the second to last shard, for ``groups`` (``key``, ``bytes``)."""

    def cells(bits: int, where) -> list[tuple[int, int, int]]:
        shift = KEY_BITS - bits
        return [(r["cell"] << shift, r["b"], r["n"]) for r in groups.filter(where).groupBy(
            F.shiftright("key", shift).alias("cell")).agg(F.sum("bytes").alias("b"), F.count(F.lit(1)).alias("n")).collect()]

    bits, state = FIRST_BITS, Cells(cells(FIRST_BITS, F.lit(True)))
    while opened := state.open_ranges(shards):
        first = [c[0] for c in state.cells] + [1 << KEY_BITS]
        bits = min(KEY_BITS, bits + MORE_BITS)
        finer = cells(bits, any_of([(F.col("key") >= first[a]) & (F.col("key") < first[b]) for a, b in opened]))
        kept = [c for k, c in enumerate(state.cells) if not any(a <= k < b for a, b in opened)]
        state = Cells(kept + finer)
    capacity = state.least(shards, False)
    first_key = {end: cell[0] for end, cell in zip(state.ends, state.cells)}
    cuts = state.cuts(capacity, shards, False)[1:shards]
    return capacity, [first_key[c] for c in cuts if c < state.total]


def assign_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every document."""
    rows = with_group(docs)
    groups = stored(rows.groupBy("key").agg(F.sum("size").alias("bytes")))
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    own: list[int] = []
    for r in groups.orderBy(F.desc("bytes"), "key").limit(shards).collect():
        if len(own) + 1 < shards and r["bytes"] * (shards - len(own)) > total:
            own.append(r["key"])
            total -= r["bytes"]
        else:
            break
    rest = groups.filter(~F.col("key").isin(own)) if own else groups
    _, cuts = minimax_cuts(rest.withColumn("key", F.greatest("key", F.lit(0))), shards - len(own)) if total else (0, [])
    shard = F.lit(len(own))
    for c in cuts:
        shard = shard + (F.col("key") >= c).cast("int")
    for k, key in enumerate(own):
        shard = F.when(F.col("key") == key, k).otherwise(shard)
    return numbered(rows.withColumn("shard", shard.cast("int")), ["shard"], ["doc_id", "text_crc32", "size"], "slot").drop("key")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents")).withColumns(
        {"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})
