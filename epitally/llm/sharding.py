"""Minimax contiguous sharding of atomic groups.

Groups (here: documents with equal text) may not be torn apart. They are put in
order of their first document, and n contiguous runs of them become the shards.
A binary search finds the smallest capacity with which a greedy pass fits all
groups into n shards. The cuts are then placed as evenly as this capacity allows:
a plain greedy pass would fill the first shards and leave the last ones short.

The greedy pass never walks over the groups. With the groups numbered in order,
and the sizes of blocks of about sqrt(N) groups added up on the driver, the end
of a shard is a lookup: the block in which the capacity runs out, then the place
inside that block, whose group sizes are fetched when first needed. The search
looks into a few hundred blocks at most, whatever the number of groups.

Slots are positions inside a shard, in document order. They come from one sort by
range over all tasks, so neither a shard nor a group of copies of any size has to
fit in one task.

Defined results: a NULL text has no bytes and forms a group of its own, as does
the empty text; rows with equal order keys get their slots in any order; with
fewer groups than shards some shards stay empty; an empty table gives an empty
result; other columns are kept.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epitally.llm.common import fresh, with_position
from epitally.staging import stage

#: Blocks whose group sizes the driver keeps at once.
_BLOCKS_KEPT = 256


class _Sizes:
    """Prefix sums of the group sizes in order, by blocks and, where asked, by group."""

    def __init__(self, groups: DataFrame, position: str, size: str):
        self._groups = groups.select(F.col(position).alias("at"), F.col(size).alias("size"))
        facts = self._groups.agg(F.count("*").alias("n"), F.max("size").alias("largest")).first()
        self.count, self.largest = facts.n, facts.largest or 0
        self.step = max(1, math.isqrt(self.count))
        sums = self._groups.groupBy((F.col("at") / self.step).cast("long").alias("block")).agg(F.sum("size").alias("size")).collect()
        by_block = {r.block: r.size for r in sums}
        blocks = range(-(-self.count // self.step))
        self._before = [0, *accumulate(by_block.get(b, 0) for b in blocks)]
        self.total = self._before[-1]
        self._inside: OrderedDict[int, list[int]] = OrderedDict()

    def _block(self, b: int) -> list[int]:
        """Prefix sums inside block b. Its neighbours come along, as the search often goes there next."""
        if b not in self._inside:
            lo, hi = (b - 1) * self.step, (b + 2) * self.step
            rows = self._groups.filter((F.col("at") >= lo) & (F.col("at") < hi)).collect()
            sizes = {r.at: r.size for r in rows}
            for k in range(max(0, b - 1), min(b + 2, len(self._before) - 1)):
                ats = range(k * self.step, min((k + 1) * self.step, self.count))
                self._inside[k] = [0, *accumulate(sizes[at] for at in ats)]
            while len(self._inside) > _BLOCKS_KEPT:
                self._inside.popitem(last=False)
        return self._inside[b]

    def boundary(self, bound: float, above: bool = False) -> tuple[int, int]:
        """The last boundary (groups before it, their size) at or below ``bound``, or the first at or above it."""
        if above and bound <= 0:
            return 0, 0
        if bound >= self.total:
            return self.count, self.total
        b = (bisect_left(self._before, bound) if above else bisect_right(self._before, bound)) - 1
        inside, start = self._block(b), self._before[b]
        i = bisect_left(inside, bound - start) if above else bisect_right(inside, bound - start) - 1
        return b * self.step + i, start + inside[i]


def _fits(sizes: _Sizes, capacity: int, shards: int) -> bool:
    """Whether greedy filling gets all groups into the shards."""
    filled = 0
    for _ in range(shards):
        _, filled = sizes.boundary(filled + capacity)
        if filled == sizes.total:
            return True
    return False


def smallest_capacity(sizes: _Sizes, shards: int) -> int:
    """Of all capacities with which the greedy pass succeeds. Average plus largest always suffices."""
    average = -(-sizes.total // shards)
    low, high = max(sizes.largest, average), average + sizes.largest
    while low < high:
        middle = (low + high) // 2
        if _fits(sizes, middle, shards):
            high = middle
        else:
            low = middle + 1
    return low


def minimax_cuts(sizes: _Sizes, shards: int) -> list[int]:
    """The number of groups before each cut between shards."""
    capacity = smallest_capacity(sizes, shards)
    latest = [sizes.total]  # at least so much has to lie before the last 0, 1, 2, … shards
    for _ in range(shards - 1):
        latest.append(sizes.boundary(latest[-1] - capacity, above=True)[1])
    cuts, filled = [], 0
    for left in range(shards - 1, 0, -1):
        even = filled + (sizes.total - filled) / (left + 1)
        below, over = sizes.boundary(even), sizes.boundary(even, above=True)
        best = below if even - below[1] <= over[1] - even else over
        if best[1] > filled + capacity:
            best = sizes.boundary(filled + capacity)
        if best[1] < latest[left]:
            best = sizes.boundary(latest[left], above=True)
        cuts.append(best[0])
        filled = best[1]
    return cuts


def shard_documents(docs: DataFrame, group: Column, size: Column, order: Column, shards: int = 16) -> DataFrame:
    """``docs`` with shard (from 0) and slot (gapless from 0 inside a shard), as int and long.

    ``group`` must not be NULL. Columns of ``docs`` named shard or slot give way.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("shard", "slot")])
    key, bytes_, first, at, other, row = fresh(docs, "_group", "_bytes", "_first", "_at", "_other", "_row")
    keyed = docs.withColumns({key: group, bytes_: size, first: order})
    groups = keyed.groupBy(key).agg(F.sum(bytes_).alias(bytes_), F.min(first).alias(first))
    # Written again with the position as a column, so that fetching a block reads little more than the block.
    groups = stage(with_position(groups, [F.col(first), F.col(key)], at, "shard-groups"), "shard-numbered")
    cuts = minimax_cuts(_Sizes(groups, at, bytes_), shards)
    number = sum((F.col(at) >= c).cast("int") for c in cuts) if cuts else F.lit(0)
    placed = groups.select(F.col(key).alias(other), number.alias("shard"))
    placed = keyed.join(placed, F.col(key) == F.col(other)).drop(key, other, bytes_)
    placed = with_position(placed, [F.col("shard"), F.col(first)], row, "shard-rows")
    counts = {r.shard: r.n for r in placed.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    starts = [0, *accumulate(counts.get(s, 0) for s in range(shards))]
    start = F.element_at(F.array(*(F.lit(s).cast("long") for s in starts)), F.col("shard") + 1)
    return placed.select(*docs.columns, "shard", (F.col(row) - start).alias("slot"))


def text_size(text: Column) -> Column:
    """UTF-8 bytes and one more, as for a line break; none for NULL."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def text_group(text: Column) -> Column:
    """The same for equal texts only."""
    return F.coalesce(F.sha2(text, 256), F.lit(""))


def write_shards(sharded: DataFrame, folder: str) -> None:
    """One folder for each shard, its rows in slot order."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
