"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints: lower-case A-Z, words, four-word shingles with repeats (fewer words: the whole sequence; none: zero),
XXH64 with seed 42 of each; a bit is 1 if over half of the hashes have it. Texts link at RADIUS differing bits or
fewer; a component is what links reach.

Search, over the distinct fingerprints:

1. The 64 x 64 table of bits that are set together, over all fingerprints, gives the bits' correlations. Correlated
   bits go into one partition, for several numbers of partitions.
2. The exact histograms of pieces of the partitions (16 bits at most) give, for each threshold, how many pairs a probe
   with it would compare; a partition of two pieces (m is 2 or 3) adds up what each piece has at each distance, as if they
   were independent. Dynamic programming picks thresholds t_i with sum(t_i) = RADIUS - m + 1 (-1: no probe in that
   partition) of the least cost, and the least of all m is taken: the more fingerprints, the wider the partitions. By
   the general pigeonhole principle, any pair within RADIUS is within t_i in one partition at least.
3. Each fingerprint is stored under its value of a partition and probes the values within t_i. A value with more
   than CHUNK fingerprints is cut into chunks, and each pair of chunks is a group of its own: no cap, and no task
   holds more than two chunks and their probes.
4. A group compares fingerprints bit by bit and gives back a spanning forest of its links, not all pairs.
5. Alternating large and small stars join the forests into components; each round ends in a table of the shared
   folder. Joins by a hub, a root or a fingerprint that very many rows share broadcast what is known of that key.

Copies share a fingerprint, so they count once until the last join. Null texts count as empty (fingerprint zero).
Rows with a null doc_id keep their row; a component of such rows only has a null id. Repeated rows each stay. The
empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import byte_texts, counted, hot_join, partitions, rows, slices, staged, text_of, unused

BITS, RADIUS, SHINGLE, SEED = 64, 4, 4, 42
#: Numbers of partitions that are weighed against each other, and the most bits of which a histogram is kept.
CHOICES, DENSE = (2, 3, 4, 5), 16
#: Edges from which on hubs are looked for.
MANY_EDGES = 100_000
#: Fingerprints of one value that are compared in one group, the cost of a probe in comparisons, and the most probes of a
#: fingerprint in one partition.
CHUNK, PROBE_COST, MOST_PROBES = 4096, 16, 1024
PRINT = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("fp", pa.int64())])
VALUES = pa.schema([("part", pa.int32()), ("value", pa.int64())])
KEYED = pa.schema([("key", pa.int64()), ("stored", pa.bool_()), ("fp", pa.int64())])
LINK = pa.schema([("u", pa.int64()), ("v", pa.int64())])
COUNTED = pa.schema([("cell", pa.int64()), ("n", pa.int64())])


def shingle_hashes(text: bytes) -> np.ndarray:
    import xxhash

    words = text.lower().split()
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= SHINGLE:
        return np.array([digest(joined, SEED)] if words else [], np.uint64)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = itertools.chain([0], ends)
    return np.fromiter((digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :], strict=False)), np.uint64)


def fingerprint(text: bytes) -> int:
    """The fingerprint as a signed 64-bit integer."""
    hashes = shingle_hashes(text)
    if not len(hashes):
        return 0
    counts = np.zeros(BITS, np.int64)
    for a in range(0, len(hashes), 65_536):
        block = hashes[a : a + 65_536].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, row (a hash of doc_id and text) and fp, a row for each document."""

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield rows(PRINT, doc_id=batch.column("doc_id"), row=batch.column("row"), fp=[fingerprint(t) for t in byte_texts(batch.column("text"))])

    own = text_of(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("doc_id", "text").alias("row"), "text")
    return own.mapInArrow(prints, "doc_id bigint, row bigint, fp bigint")


def _prints_of(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def _bits_of(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _summed(df: DataFrame, count) -> dict[int, int]:
    """Sums, over all rows, of the table that count makes of an array of fingerprints."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for batch in batches:
            for cell, n in zip(*count(_prints_of(batch)), strict=True):
                total[cell] = total.get(cell, 0) + n
        yield rows(COUNTED, cell=list(total), n=list(total.values()))

    return {r[0]: r[1] for r in df.select("fp").mapInArrow(cells, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n")).collect()}


def correlations(df: DataFrame) -> tuple[np.ndarray, int]:
    """Absolute correlations of the bits over all fingerprints, and how many fingerprints there are."""

    def together(fps: np.ndarray) -> tuple[list[int], list[int]]:
        bits = _bits_of(fps).astype(np.float64)
        both = (bits.T @ bits).astype(np.int64)
        return [*range(BITS * BITS), BITS * BITS], [*both.ravel().tolist(), len(fps)]

    found = _summed(df, together)
    n = found.pop(BITS * BITS, 0)
    both = np.zeros(BITS * BITS)
    for cell, value in found.items():
        both[cell] = value
    both = both.reshape(BITS, BITS) / max(n, 1)
    share = np.diag(both)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    return np.abs((both - np.outer(share, share)) / np.outer(spread, spread)), n


def grouped_bits(correlation: np.ndarray, m: int) -> list[list[int]]:
    """m partitions of the bits of nearly equal width; each takes the bits that correlate most with those it has."""
    left, out = set(range(BITS)), []
    for k in range(m):
        width = len(left) // (m - k)
        own = [max(sorted(left), key=lambda b: sum(correlation[b, x] for x in left if x != b))]
        left.remove(own[0])
        while len(own) < width:
            best = max(sorted(left), key=lambda b: sum(correlation[b, x] for x in own))
            own.append(best)
            left.remove(best)
        out.append(sorted(own))
    return out


def paired(correlation: np.ndarray, groups: list[list[int]]) -> list[list[list[int]]]:
    """Four groups of bits as two of two, those together that correlate most."""
    tie = lambda a, b: float(correlation[np.ix_(groups[a], groups[b])].sum())
    best = max(([(0, 1), (2, 3)], [(0, 2), (1, 3)], [(0, 3), (1, 2)]), key=lambda two: sum(tie(a, b) for a, b in two))
    return [[groups[a], groups[b]] for a, b in best]


def values_of(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(fps), np.int64)
    for i, b in enumerate(bits):
        out |= ((fps >> np.int64(b)) & np.int64(1)) << np.int64(i)
    return out


def ball(width: int, t: int) -> np.ndarray:
    """What to xor a value of that width with to reach all values within t bits; itself first."""
    return np.array([sum(1 << b for b in bits) for d in range(t + 1) for bits in itertools.combinations(range(width), d)], np.int64)


def _walsh(x: np.ndarray) -> np.ndarray:
    x, h = x.astype(np.float64), 1
    while h < len(x):
        x = x.reshape(-1, 2, h)
        x = np.stack([x[:, 0] + x[:, 1], x[:, 0] - x[:, 1]], axis=1).reshape(-1)
        h *= 2
    return x


def compared(histogram: np.ndarray, t: int) -> float:
    """Pairs that probes within t bits of a value would compare: an xor convolution of the histogram with the ball."""
    width, reach = len(histogram).bit_length() - 1, np.zeros(len(histogram))
    reach[ball(width, t)] = 1
    near = _walsh(_walsh(histogram) * _walsh(reach)) / len(histogram)
    return float((histogram * near).sum())


def allocate(costs: list[dict[int, float]], radius: int = RADIUS) -> tuple[float, list[int]]:
    """Thresholds of the least total cost whose sum is radius - m + 1."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for total, (paid, chosen) in best.items():
            for t, c in cost.items():
                if total + t not in step or paid + c < step[total + t][0]:
                    step[total + t] = (paid + c, [*chosen, t])
        best = step
    return best[radius - len(costs) + 1]


def distances(histogram: np.ndarray, most: int) -> list[float]:
    """Pairs whose values are 0, 1 and so on up to most bits apart."""
    within = [compared(histogram, t) for t in range(min(most, len(histogram).bit_length() - 1) + 1)]
    return [*np.diff(within, prepend=0.0).tolist(), *[0.0] * (most + 1 - len(within))]


def estimated(pieces: list[np.ndarray], n: int, most: int) -> list[float]:
    """Pairs that probes within 0, 1 and so on up to most bits would compare, from the histograms of a partition's pieces."""
    found = distances(pieces[0], most)
    for piece in pieces[1:]:
        other = distances(piece, most)
        found = [sum(found[i] * other[d - i] for i in range(d + 1)) / max(n, 1) ** 2 for d in range(most + 1)]
    return np.cumsum(found).tolist()


class Part:
    """A partition that is probed: its bits, its threshold, and how many fingerprints a value has: of each value if the
    partition is narrow, of those with more than CHUNK if it is wide."""

    def __init__(self, bits: list[int], t: int, histogram: np.ndarray | None = None) -> None:
        self.bits, self.t, self.histogram = bits, t, histogram
        self.hot, self.n_hot = np.array([], np.int64), np.array([], np.int64)

    def counts(self, values: np.ndarray) -> np.ndarray:
        """Fingerprints of each value; where that isn't known, there may be CHUNK of them, and at least two."""
        if self.histogram is not None:
            return self.histogram[values]
        out = np.full(len(values), 2, np.int64)
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, values), len(self.hot) - 1)
            out = np.where(self.hot[at] == values, self.n_hot[at], out)
        return out


def plan(distinct: DataFrame) -> list[Part]:
    """The partitions that are probed."""
    correlation, n = correlations(distinct)
    # Pieces of at most DENSE bits: halves of the wide partitions.
    choices: dict[int, list[list[list[int]]]] = {}
    for m in CHOICES:
        groups = grouped_bits(correlation, m) if m > 2 else paired(correlation, grouped_bits(correlation, 4))
        choices[m] = [bits if isinstance(bits[0], list) else [bits] if len(bits) <= DENSE else [bits[: len(bits) // 2], bits[len(bits) // 2 :]] for bits in groups]
    flat = [list(x) for x in dict.fromkeys(tuple(piece) for groups in choices.values() for part in groups for piece in part)]

    def count(fps: np.ndarray) -> tuple[list[int], list[int]]:
        cells, ns = np.unique(np.concatenate([values_of(fps, bits) | (i << 32) for i, bits in enumerate(flat)]), return_counts=True)
        return cells.tolist(), ns.tolist()

    histograms = [np.zeros(1 << len(bits), np.int64) for bits in flat]
    for cell, value in _summed(distinct, count).items():
        histograms[cell >> 32][cell & 0xFFFFFFFF] = value
    of = {tuple(bits): h for bits, h in zip(flat, histograms, strict=True)}
    plans = []
    for m, groups in choices.items():
        costs, parts = [], []
        for pieces in groups:
            bits = [b for piece in pieces for b in piece]
            known = [of[tuple(piece)] for piece in pieces]
            pairs, probes = estimated(known, n, RADIUS), np.cumsum([math.comb(len(bits), t) for t in range(RADIUS + 1)]).tolist()
            costs.append({-1: 0.0} | {t: pairs[t] + PROBE_COST * n * probes[t] for t in range(RADIUS + 1) if probes[t] <= MOST_PROBES})
            parts.append((bits, known[0] if len(known) == 1 else None))
        cost, thresholds = allocate(costs)
        plans.append((cost, m, [Part(bits, t, h) for (bits, h), t in zip(parts, thresholds, strict=True) if t >= 0]))
    chosen = min(plans, key=lambda x: x[:2])[2]
    _find_hot(distinct, [p for p in chosen if p.histogram is None])
    return chosen


def _find_hot(distinct: DataFrame, wide: list[Part]) -> None:
    """The values of wide partitions that have more than CHUNK fingerprints: a 4096th of all fingerprints at most."""
    if not wide:
        return

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = _prints_of(batch)
            for k, part in enumerate(wide):
                yield rows(VALUES, part=pa.array(np.full(len(fps), k, np.int32)), value=pa.array(values_of(fps, part.bits)))

    found = distinct.select("fp").mapInArrow(values, "part int, value bigint").groupBy("part", "value").agg(F.count("*").alias("n")).where(F.col("n") > CHUNK).orderBy("part", "value").collect()
    for k, part in enumerate(wide):
        part.hot = np.array([r.value for r in found if r.part == k], np.int64)
        part.n_hot = np.array([r.n for r in found if r.part == k], np.int64)


def _spanning(fps: np.ndarray, stored: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links between stored fingerprints and any fingerprint of the group."""
    links, waiting, bits = [], np.ones(len(fps), bool), fps.view(np.uint64)  # bitwise_count() takes a signed number's absolute value
    for first in np.flatnonzero(stored).tolist():
        if not waiting[first]:
            continue
        waiting[first] = False
        frontier = [first]
        while frontier:
            x = frontier.pop()
            left = np.flatnonzero(waiting if stored[x] else waiting & stored)
            near = left[np.bitwise_count(bits[left] ^ bits[x]) <= RADIUS]
            waiting[near] = False
            frontier += near.tolist()
            links += [(int(fps[x]), int(fps[y])) for y in near if fps[x] != fps[y]]
    return links


def links(distinct: DataFrame) -> DataFrame:
    """u and v, different fingerprints within RADIUS: enough of them to connect whatever is connected."""
    probes, n = plan(distinct), partitions(distinct.sparkSession)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 8192):
                fps = _prints_of(batch.slice(a, 8192))
                for k, part in enumerate(probes):
                    own = values_of(fps, part.bits)
                    for i, reach in enumerate(ball(len(part.bits), part.t).tolist()):
                        values = own ^ reach
                        there = part.counts(values)
                        chunks = -(-np.maximum(there, 1) // CHUNK)
                        mine = (fps.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % chunks
                        # A stored fingerprint goes to the pair of its chunk with each chunk, a probe to each chunk.
                        at = np.repeat(np.arange(len(fps)), chunks)
                        other = np.arange(len(at)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
                        low, high = (np.minimum(mine[at], other), np.maximum(mine[at], other)) if i == 0 else (other, other)
                        # Two groups that share a key are compared with each other as well, which does no harm.
                        group = (np.int64(k) << 32 | values[at]).view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
                        key = (group + (low << 32 | high).view(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)).view(np.int64)
                        keep = there[at] > (1 if i == 0 and part.t == 0 else 0)
                        yield rows(KEYED, key=pa.array(key[keep]), stored=pa.array(np.full(int(keep.sum()), i == 0)), fp=pa.array(fps[at][keep]))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def out() -> Iterator[pa.RecordBatch]:
            if sum(len(x) for x, _ in held) > 1:
                found = _spanning(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))
                if found:
                    u, v = zip(*found, strict=True)
                    yield rows(LINK, u=list(u), v=list(v))
            held.clear()

        for batch in batches:
            keys, fps = batch.column("key").to_numpy(), _prints_of(batch)
            stored = batch.column("stored").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a < b:
                    if keys[a] != key:
                        yield from out()
                        key = keys[a]
                    held.append((fps[a:b], stored[a:b]))
        yield from out()

    dealt = distinct.select("fp").mapInArrow(deal, "key bigint, stored boolean, fp bigint")
    return dealt.repartition(n, "key").sortWithinPartitions("key").mapInArrow(compare, "u bigint, v bigint")


def components(edges: DataFrame) -> DataFrame:
    """v and root, the least of its component, for every end of an edge but the roots."""

    def nearest(e: DataFrame) -> DataFrame:
        return e.groupBy("u").agg(F.min("v").alias("m"))

    def with_least(e: DataFrame, total: int) -> DataFrame:
        """u, v and m, the least v of that u."""
        if total <= MANY_EDGES:
            return e.join(nearest(e), "u")
        least = staged(e.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "least")
        return hot_join(e, least, "u", F.col("n"), total).select("u", "v", "m")

    def large(e: DataFrame, total: int) -> DataFrame:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        return with_least(both, 2 * total).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()

    def small(e: DataFrame, total: int) -> DataFrame:
        moved = with_least(e, total).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return moved.union(nearest(e).select("u", F.col("m").alias("v"))).distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0])

    e = staged(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    was, now = None, mark(e)
    while was != now:
        grown = large(e, now[0])
        e = staged(small(staged(grown, "stars") if now[0] > MANY_EDGES else grown, now[0]), "edges")
        was, now = now, mark(e)
    return e.select(F.col("u").alias("v"), F.col("v").alias("root"))


def simhash_classes(docs: DataFrame) -> DataFrame:
    """doc_id, row (a hash of doc_id and text), fp, root (the component's least fingerprint) and component_id, a row for each document."""
    prints = staged(fingerprints(docs), "prints")
    distinct = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "distinct")
    total, n = distinct.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).collect()[0]
    roots = components(links(distinct))
    rooted = staged(distinct.join(roots, distinct.fp == roots.v, "left").select("fp", "first", "n", F.coalesce("root", "fp").alias("root")), "rooted")
    least = staged(rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("members")), "least")
    of = staged(hot_join(rooted, least, "root", F.col("members"), n).select("fp", "root", "component_id", "n"), "components")
    return hot_join(prints, of, "fp", F.col("n"), total).select("doc_id", "row", "fp", "root", "component_id")


def simhash_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint as 16 lower-case hex digits, and component_id."""
    return simhash_classes(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that stand for their component: one of each.

    That is a row of the component's least doc_id and, if that id has several texts in it, of the text of the least hash. Rows
    without a doc_id can't be told apart, so they all stay. Only rows that go or repeat are joined with the texts, by doc_id
    and a hash of both, so that texts are shuffled only where there are very many of those.
    """
    row, id_of, row_of = unused(docs, "row"), unused(docs, "listed_id"), unused(docs, "listed_row")
    named = docs.withColumn(row, F.xxhash64("doc_id", "text"))
    classes = staged(simhash_classes(docs).where("doc_id IS NOT NULL").select("doc_id", "row", "root", "component_id"), "classes")
    of_least = classes.where("doc_id = component_id").groupBy("root", "doc_id", "row").agg(F.count("*").alias("n"))
    first = of_least.groupBy("root").agg(F.min("row").alias("first"))
    judged = of_least.join(first, "root").select("doc_id", "row", F.col("row") != F.col("first"), F.col("n") > 1)
    others = classes.where("doc_id != component_id").select("doc_id", "row", F.lit(True), F.lit(False)).distinct()
    listed = judged.union(others).toDF(id_of, row_of, "goes", "again")
    gone = counted(listed.where("goes").select(id_of, row_of), "gone")
    again = counted(listed.where("NOT goes AND again").select(id_of, row_of), "again")
    same = (F.col(row) == F.col(row_of)) & (F.col("doc_id") == F.col(id_of))
    kept = named.join(gone, same, "left_anti")
    if again.isEmpty():
        return kept.select(docs.columns)
    once = kept.join(again, same, "left_semi").dropDuplicates(["doc_id", row])
    return kept.join(again, same, "left_anti").select(docs.columns).union(once.select(docs.columns))
