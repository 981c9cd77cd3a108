"""Shards of near equal bytes as a minimax contiguous partition.

Texts are laid out along their hash. The hash space is cut into a fixed number of cells, so
equal texts always share a cell; the bytes of the cells, in order, are the atomic sizes. Binary
search finds the smallest capacity at which a greedy fill needs no more shards than there
are, and the cuts go where that fill puts them. Only the cells' totals reach the driver: a fixed
number of integers, whatever the input. A shard exceeds the mean by less than its largest cell. A cell above
the mean has a shard of its own where that raises no other above it, and the rest is cut in the same way around it.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CELL_BITS = 16
LANES = 256


def _fill(ends: list[int], capacity: int, shards: int) -> list[int] | None:
    """First cells of the shards after the first, or None when `shards` do not suffice.

    `ends` are running totals of the atomic sizes.
    """
    cuts, start = [], 0
    for _ in range(shards):
        cell = bisect_right(ends, start + capacity)
        if cell == len(ends):
            return cuts
        cuts.append(cell)
        start = ends[cell - 1] if cell else 0
    return None


def minimax_cuts(sizes: list[int], shards: int) -> list[int]:
    """Cut ordered sizes into at most `shards` runs whose largest sum is the smallest possible.

    Returns the index at which each run after the first starts.
    """
    ends = list(accumulate(sizes))
    if not ends or shards < 1:
        return []
    low, high = max(max(sizes), -(-ends[-1] // shards)), ends[-1]
    while low < high:
        middle = (low + high) // 2
        if _fill(ends, middle, shards) is None:
            low = middle + 1
        else:
            high = middle
    return _fill(ends, low, shards) or []


def _largest(sizes: list[int], cuts: list[int]) -> int:
    """The largest sum of the runs between cuts."""
    ends = [0, *accumulate(sizes)]
    edges = [0, *cuts, len(sizes)]
    return max((ends[b] - ends[a] for a, b in zip(edges, edges[1:])), default=0)


def even_cuts(sizes: list[int], shards: int) -> list[int]:
    """Cuts as by `minimax_cuts`, with no larger sum, that also share out evenly what lies around an oversized cell.

    A cell above the mean sets the capacity by itself. It gets a run of its own, and the runs before and after
    it are cut in the same way into as many parts as keep the larger capacity of both smallest.
    """
    plain = minimax_cuts(sizes, shards)
    if not sizes or shards < 2 or max(sizes) * shards <= sum(sizes):
        return plain
    at = sizes.index(max(sizes))
    before, after = sizes[:at], sizes[at + 1:]
    most = shards - 1 - bool(after)
    if not before and not after or most < bool(before):
        return plain
    options = []
    for parts in range(1, most + 1) if before else [0]:
        rest = shards - 1 - parts if after else 0
        load = max(_largest(before, minimax_cuts(before, parts)), _largest(after, minimax_cuts(after, rest)))
        options.append((load, parts, rest))
    load, parts, rest = min(options)
    if load > _largest(sizes, plain):
        return plain
    cuts = even_cuts(before, parts) + [at] * bool(before)
    if after:
        cuts += [at + 1, *(at + 1 + c for c in even_cuts(after, rest))]
    return cuts


def _shard_of(cell: Column, starts: list[int]) -> Column:
    """How many of the starts are at or before `cell`."""
    shard = F.lit(0)
    for start in starts:
        shard = shard + (cell >= start).cast("int")
    return shard


def assign(
    docs: DataFrame,
    shards: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    cell_bits: int = CELL_BITS,
    lanes: int = LANES,
) -> DataFrame:
    """Every row's id, size (UTF-8 bytes of the text plus 1; null text: 1), text_crc32, shard and slot.

    Equal texts share a shard (null and empty are equal). Slots count the rows of a shard from 0
    without gaps. A cell's rows are numbered in `lanes` parts, so that a text with very many copies
    is numbered in many tasks. Null ids come first; repeated rows get slots of their own. Fewer
    cells than shards, or an empty table, leave shards empty.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    cell = F.shiftright(F.xxhash64(text), 64 - cell_bits) + (1 << (cell_bits - 1))
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("crc"),
        cell.cast("int").alias("cell"),
        F.pmod(F.xxhash64(F.col(id_col), F.lit(1)), F.lit(lanes)).cast("int").alias("lane"),
    )
    totals = sorted((r["cell"], r["bytes"]) for r in rows.groupBy("cell").agg(F.sum("size").alias("bytes")).collect())
    starts = [totals[i][0] for i in even_cuts([t[1] for t in totals], shards)]

    in_lanes = rows.groupBy("cell", "lane").agg(F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("cell").orderBy("lane").rowsBetween(W.unboundedPreceding, -1)
    lane_starts = in_lanes.select("cell", "lane", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("lane_start"))
    by_cell = in_lanes.groupBy("cell").agg(F.sum("n").alias("n")).withColumn("shard", _shard_of(F.col("cell"), starts))
    earlier = W.partitionBy("shard").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    cell_starts = by_cell.select("cell", "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("cell_start"))

    place = F.row_number().over(W.partitionBy("cell", "lane").orderBy("id", "size"))
    return (
        rows.withColumn("place", place - 1)
        .join(lane_starts, ["cell", "lane"])
        .join(cell_starts, "cell")
        .select(
            F.col("id").alias(id_col),
            "size",
            F.col("crc").alias("text_crc32"),
            "shard",
            (F.col("cell_start") + F.col("lane_start") + F.col("place")).cast("bigint").alias("slot"),
        )
    )
