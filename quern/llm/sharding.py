"""Sharding: the minimax contiguous partition of the corpus into shards of nearly equal bytes.

Equal texts form an atomic group. Groups are ordered by the XXH64 of their text, but for those larger than an even
share (fewer than shards), which come first; so a group's shard follows from 39 cut keys, and no row has to be sorted. The smallest feasible capacity is found by binary search; a capacity is feasible
if filling shards greedily in order needs no more than the number of shards. Cuts are then made at that capacity, each
as near to an even share of what is left as the capacity allows.

The driver never holds all group sizes. It holds sums over blocks of consecutive keys: BLOCKS of them at first. Each
step of the search knows bounds of where it stands; a block that lies between them and holds more than one group is
split into FAN blocks by one more histogram, the heaviest REFINED of a round at most, until every step stands at the end of a
group. So the driver gets BLOCKS + FAN x REFINED sums a round at most, whatever the number of groups and however large the largest
is, and as a round makes blocks FAN times smaller, there are few rounds.

Slots run from 0 in each shard without gaps, in the order of the staged rows: counts of each (part, shard) give each
part its first slot, and rows are numbered within their part.

Null texts have no bytes and count as equal to the empty text. Repeated rows each have a slot of their own. The empty
table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import rows, staged, text_of

SHARDS, OVERHEAD, BLOCKS, LEAST = 40, 16, 1 << 16, -(1 << 63)
FAN, REFINED = 64, 2048
BLOCK = pa.schema([("block", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("size", pa.int64()), ("n", pa.int64())])
SCHEMA = pa.schema([("doc_id", pa.int64()), ("size", pa.int64()), ("text_crc32", pa.int64()), ("shard", pa.int32()), ("part", pa.int32()), ("rank", pa.int64())])


class Line:
    """The groups in order of their keys as blocks in a row: the first key of each, its size and how many groups it holds."""

    def __init__(self, keys: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> None:
        self.keys, self.sizes, self.counts = (np.asarray(x, np.int64) for x in (keys, sizes, counts))
        self._sum()

    def _sum(self) -> None:
        self.before = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        self.total = int(self.before[-1])
        self.split: set[int] = set()

    def replace(self, blocks: list[int], keys: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> None:
        """Put finer blocks in the place of some."""
        left = np.ones(len(self.keys), bool)
        left[blocks] = False
        merged = [np.concatenate([a[left], b]) for a, b in zip((self.keys, self.sizes, self.counts), (keys, sizes, counts), strict=True)]
        order = np.argsort(merged[0], kind="stable")
        self.keys, self.sizes, self.counts = (x[order] for x in merged)
        self._sum()

    def block(self, position: int) -> int:
        """The block that holds the byte at this position."""
        return int(np.searchsorted(self.before, position, side="right")) - 1

    def _want(self, low: int, high: int) -> None:
        """Note the blocks of several groups that have a border inside (low - 1, high + 1)."""
        if low < self.total:
            a, b = self.block(max(low, 0)), self.block(min(high, self.total - 1))
            self.split.update((np.flatnonzero(self.counts[a : b + 1] > 1) + a).tolist())

    def down(self, low: int, high: int, note: bool = True) -> tuple[int, int]:
        """Bounds of the last end of a group at or before a position of which low and high are bounds."""
        if note and not (low == high and self._is_end(low)):
            self._want(low, high)
        return self._down(low)[0], self._down(high)[1]

    def up(self, low: int, high: int, note: bool = True) -> tuple[int, int]:
        """Bounds of the first end of a group at or after a position."""
        if note and not (low == high and self._is_end(low)):
            self._want(low, high)
        return self._up(low)[0], self._up(high)[1]

    def _is_end(self, position: int) -> bool:
        return position <= 0 or position >= self.total or int(self.before[self.block(position)]) == position

    def _down(self, position: int) -> tuple[int, int]:
        if position >= self.total:
            return self.total, self.total
        b = self.block(position)
        start = int(self.before[b])
        return start, start if self.counts[b] == 1 else position

    def _up(self, position: int) -> tuple[int, int]:
        if self._is_end(position):
            return (min(max(position, 0), self.total),) * 2
        b = self.block(position)
        end = int(self.before[b + 1])
        return end if self.counts[b] == 1 else position, end

    def key_at(self, end: int) -> int | None:
        """The key of the first group after this end."""
        return None if end >= self.total else int(self.keys[self.block(end)])


def _places(line: Line, capacity_low: int, capacity_high: int, shards: int) -> bool | None:
    """Whether filling shards in order to a capacity between these succeeds, as far as the blocks tell."""
    low = high = 0
    for _ in range(shards):
        low, high = line.down(low + capacity_low, high + capacity_high)
    return True if low >= line.total else False if high < line.total else None


def _feasible(line: Line, capacity: int, shards: int) -> bool | None:
    low = high = 0
    for _ in range(shards):
        low, high = line.down(low + capacity, high + capacity, note=False)
    return True if low >= line.total else False if high < line.total else None


def _bisected(low: int, high: int, is_right) -> int:
    """The least number from low to high that is right, if all above it are; high is taken to be."""
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if is_right(middle) else (middle + 1, high)
    return low


def _even_cuts(line: Line, capacity: int, shards: int) -> list[tuple[int, int]]:
    """Bounds of the ends of the shards but the last: each as near to an even share of what is left as the capacity allows."""
    floor = [(line.total, line.total)]  # the last places that still leave room for the rest, from the end
    for _ in range(shards - 1):
        floor.append(line.up(floor[-1][0] - capacity, floor[-1][1] - capacity))
    floor = floor[::-1]
    at, ends = (0, 0), []
    for k in range(1, shards):
        share = lambda x: x + (line.total - x) // (shards - k + 1)  # noqa: B023, E731
        target = share(at[0]), share(at[1])
        below, above = line.down(*target), line.up(*target)
        if target[0] == target[1] and below[0] == below[1] and above[0] == above[1] and at[0] == at[1]:
            even = above if below[0] <= at[0] or above[0] - target[0] < target[0] - below[0] else below
        else:
            even = below[0], above[1]
        most = line.down(at[0] + capacity, at[1] + capacity)
        at = tuple(max(at[i], min(most[i], max(even[i], floor[k - 1][i]))) for i in (0, 1))
        ends.append(at)
    return ends


def minimax_cuts(line: Line, largest: int, refine, shards: int = SHARDS) -> tuple[int, list[int]]:
    """The smallest capacity, and the ends of the shards. refine(blocks) puts finer blocks in their place."""
    if not line.total:
        return 0, [0] * shards
    even = max(largest, -(-line.total // shards))
    low, high = even, even + largest  # a shard that is closed holds more than the capacity less the largest group

    def finer() -> None:
        heavy = sorted(line.split, key=lambda b: (-int(line.sizes[b]), b))[:REFINED]
        refine(heavy)

    while True:
        low = _bisected(low, high, lambda c: _feasible(line, c, shards) is not False)
        high = _bisected(low, high, lambda c: _feasible(line, c, shards) is True)
        line.split = set()
        if low == high and _feasible(line, low, shards) is True:
            break
        _places(line, low, high, shards)
        finer()
    while True:
        line.split = set()
        ends = _even_cuts(line, low, shards)
        if all(a == b for a, b in ends):
            return low, [*(a for a, _ in ends), line.total]
        finer()


def group_sizes(rows_of: DataFrame) -> DataFrame:
    return rows_of.groupBy("key").agg(F.sum("size").alias("size"))


def cut_keys(rows_of: DataFrame, shards: int = SHARDS, blocks: int = BLOCKS) -> tuple[int, list[int], list[int]]:
    """The capacity, the first key of each shard but the first, and the keys that stand ahead of all others (the first is
    taken for the least integer, and so on); rows_of has key and size."""
    spark = rows_of.sparkSession
    groups = staged(group_sizes(rows_of), "groups")
    n, total, largest = groups.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("size"), F.lit(0))).collect()[0]
    if not n:
        return 0, [], []
    ahead = [r.key for r in groups.where(F.col("size") * shards > total).orderBy(F.desc("size"), "key").collect()]  # fewer than shards
    moved = functools.reduce(lambda c, x: c.when(F.col("key") == x[1], F.lit(LEAST + x[0])), enumerate(ahead), F.when(F.lit(False), F.col("key")))
    groups = groups.select(moved.otherwise(F.col("key")).alias("key"), "size")
    groups = staged(groups, "moved") if ahead else groups

    last_of: dict[int, int] = {}  # the last key of the block that has this first one

    def sums(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First key, size and number of groups of each block that isn't empty; bounds has each block's span of keys, in order."""

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                key, size = batch.column("key").to_numpy(), batch.column("size").to_numpy()
                at = np.searchsorted(bounds[:, 0], key, side="right") - 1
                inside = (at >= 0) & (key <= bounds[np.maximum(at, 0), 1])
                at, key, size = at[inside], key[inside], size[inside]
                if len(at):
                    order = np.lexsort((key, at))
                    at, key, size = at[order], key[order], size[order]
                    starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
                    ends = np.append(starts[1:], len(at)) - 1
                    yield rows(BLOCK, block=pa.array(at[starts]), first=pa.array(key[starts]), last=pa.array(key[ends]), size=pa.array(np.add.reduceat(size, starts)), n=pa.array(ends - starts + 1))

        partial = groups.select("key", "size").mapInArrow(add, "block bigint, first bigint, last bigint, size bigint, n bigint")
        found = partial.groupBy("block").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("size").alias("size"), F.sum("n").alias("n")).toPandas().sort_values("first")
        last_of.update(zip(found["first"].tolist(), found["last"].tolist(), strict=True))
        return found["first"].to_numpy(), found["size"].to_numpy(), found["n"].to_numpy()

    def spans(first: int, last: int, parts: int) -> list[tuple[int, int]]:
        """The keys from first to last, both included, in that many spans, or fewer if there are fewer keys."""
        parts = min(parts, last - first + 1)
        cuts = [first + (last - first + 1) * k // parts for k in range(parts)]
        return list(zip(cuts, [*(c - 1 for c in cuts[1:]), last], strict=True))

    line = Line(*sums(np.array(spans(LEAST, 2**63 - 1, blocks), np.int64)))

    def refine(wanted: list[int]) -> None:
        own = sorted((int(line.keys[b]), last_of[int(line.keys[b])]) for b in wanted)  # of two keys or more, so each gets smaller
        line.replace(wanted, *sums(np.array([s for a, z in own for s in spans(a, z, FAN)], np.int64)))

    capacity, ends = minimax_cuts(line, int(largest), refine, shards)
    return capacity, [k if (k := line.key_at(end)) is not None else 2**63 - 1 for end in ends[:-1]], ahead


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, blocks: int = BLOCKS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard, a row for each document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    own = text_of(docs, "doc_id", "text").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), (F.octet_length(text) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("key"),
    )
    own = staged(own, "sizes")
    _, cuts, ahead = cut_keys(own.select("key", "size"), shards, blocks)
    starts = np.array(cuts, np.int64)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), np.zeros(shards, np.int64)
        for batch in batches:
            key = batch.column("key").to_numpy()
            for i, k in enumerate(ahead):
                key = np.where(key == k, LEAST + i, key)
            shard = np.searchsorted(starts, key, side="right")
            order = np.argsort(shard, kind="stable")
            here = np.bincount(shard, minlength=shards)
            rank = np.empty(len(shard), np.int64)
            rank[order] = np.arange(len(shard)) - np.repeat(np.cumsum(here) - here, here) + np.repeat(seen, here)
            seen += here
            yield rows(SCHEMA, doc_id=batch.column("doc_id"), size=batch.column("size"), text_crc32=batch.column("text_crc32"), shard=pa.array(shard.astype(np.int32)), part=pa.array(np.full(len(shard), part, np.int32)), rank=pa.array(rank))

    numbered = staged(own.mapInArrow(number, "doc_id bigint, size bigint, text_crc32 bigint, shard int, part int, rank bigint"), "numbered")
    from pyspark.sql import Window

    firsts = numbered.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = firsts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return numbered.join(firsts, ["shard", "part"]).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first") + F.col("rank")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
