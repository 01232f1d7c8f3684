"""Shards of nearly equal bytes: the minimax contiguous partition of ordered atomic groups.

Documents of equal text are never parted: they are ordered by the leading bits
of their text's hash, and every value of those bits is one atomic group. The
smallest capacity that lets the ordered groups fit into the shards is found by
binary search, where a greedy pass from cut to cut tells if a capacity is
enough; the groups are then cut where that pass cuts.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfmark.operators.settle import settle

#: Leading bits of the hash: the driver holds one size for each of their values at most.
GROUP_BITS = 17
#: Documents numbered by one task at a time.
CELL_ROWS = 8192


def greedy_cuts(ends: list[int], capacity: int, shards: int) -> list[int] | None:
    """How many groups lie before each cut if every shard is filled up to ``capacity``; None if they don't fit."""
    cuts, at = [], 0
    for _ in range(shards):
        at = bisect_right(ends, (ends[at - 1] if at else 0) + capacity)
        cuts.append(at)
    return cuts if at == len(ends) else None


def minimax_cuts(sizes: list[int], shards: int) -> list[int]:
    """The greedy cuts at the smallest feasible capacity."""
    ends = list(accumulate(sizes))
    if not ends:
        return [0] * shards
    low, high = max(max(sizes), -(-ends[-1] // shards)), ends[-1]
    while low < high:
        middle = (low + high) // 2
        if greedy_cuts(ends, middle, shards) is None:
            low = middle + 1
        else:
            high = middle
    return greedy_cuts(ends, low, shards)


def _shard_of(group: Column, bounds: list[int]) -> Column:
    """The shard whose groups end at the first bound that isn't smaller."""
    shard = F.lit(len(bounds) - 1)
    for i in reversed(range(len(bounds) - 1)):
        shard = F.when(group <= bounds[i], F.lit(i)).otherwise(shard)
    return shard.cast("int")


def shards_by_bytes(documents: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, size, text_crc32, law, shard, slot, grown_shard) for every row.

    ``size`` is the text's UTF-8 bytes plus 1; a null text is read as empty.
    Rows of equal text share a shard. Slots count each shard's rows from 0
    without gaps, in an order fixed by id, checksum and size; equal rows are
    interchangeable. The law is ``bytes``, so ``grown_shard`` is null. Null ids
    are numbered like others; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    group = F.shiftrightunsigned(F.xxhash64(text), 64 - GROUP_BITS).cast("int")
    rows = settle(documents.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                                   F.crc32(text.cast("binary")).alias("crc"), group.alias("group")), "sizes")
    groups = rows.groupBy("group").agg(F.sum("size").alias("size"), F.count("*").alias("n")).orderBy("group").collect()
    cuts = minimax_cuts([g["size"] for g in groups], shards)
    bounds = [groups[c - 1]["group"] if c else -1 for c in cuts]
    cells = max(1, -(-sum(g["n"] for g in groups) // (shards * CELL_ROWS)))
    placed = rows.withColumn("shard", _shard_of(F.col("group"), bounds)).withColumn(
        "cell", F.pmod(F.xxhash64("id", "crc", "size"), F.lit(cells)).cast("int"))
    counts = placed.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "cell").orderBy("id", "crc", "size")
    numbered = placed.withColumn("row", F.row_number().over(within) - 1).join(starts, ["shard", "cell"])
    return numbered.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
                           "shard", (F.col("start") + F.col("row")).cast("long").alias("slot"),
                           F.lit(None).cast("int").alias("grown_shard"))
