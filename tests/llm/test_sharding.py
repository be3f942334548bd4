import bisect
import random
import zlib

import numpy as np
import pytest

from quern.llm import sharding
from quern.llm.sharding import Line, cut_keys, minimax_cuts, shard_by_bytes


def greedy(sizes, capacity):
    shards, at = 1, 0
    for s in sizes:
        if at + s > capacity:
            shards, at = shards + 1, 0
        at += s
    return shards


@pytest.mark.parametrize("per_block", [1, 3, 25])
@pytest.mark.parametrize("seed", range(12))
def test_minimax_equals_brute_force(per_block, seed):
    rng = random.Random(seed)
    n, shards = rng.randrange(1, 300), rng.choice([1, 3, 40])
    sizes = np.array([rng.choice([16, 100, rng.randrange(1, 2000), 50_000 if rng.random() < 0.02 else 7]) for _ in range(n)])
    keys = np.sort(np.array(rng.sample(range(-(10**6), 10**6), n)))
    at = np.arange(0, n, per_block)
    line = Line(keys[at], np.add.reduceat(sizes, at), np.diff(np.append(at, n)))
    asked = []

    def refine(blocks):
        asked.append(len(blocks))
        finer = []
        for b in blocks:  # two of each
            after = line.keys[b + 1] if b + 1 < len(line.keys) else 10**7
            own = np.flatnonzero((keys >= line.keys[b]) & (keys < after))
            finer += np.array_split(own, 2)
        line.replace(blocks, *(np.array(x) for x in zip(*((keys[x[0]], sizes[x].sum(), len(x)) for x in finer), strict=True)))

    capacity, ends = minimax_cuts(line, int(sizes.max()), refine, shards)
    best = next(c for c in range(max(int(sizes.max()), -(-int(sizes.sum()) // shards)), int(sizes.sum()) + 1) if greedy(sizes, c) <= shards)
    sums = np.diff([0, *ends])
    assert capacity == best and len(ends) == shards and ends[-1] == sizes.sum()
    assert sums.max() <= best and sums.min() >= 0
    assert set(ends) <= {0, *np.cumsum(sizes).tolist()}
    assert len(asked) <= 12  # a round halves blocks here
    if n >= 4 * shards and sizes.max() * 4 * shards < sizes.sum():
        assert sums.min() > 0.6 * sizes.sum() / shards


def even_cuts(sizes, capacity, shards):
    """The cuts that are as even as the capacity allows, over all groups at once."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    down, up = (lambda x: int(ends[np.searchsorted(ends, x, side="right") - 1])), (lambda x: int(ends[np.searchsorted(ends, max(x, 0))]))
    total, floor = int(ends[-1]), [int(ends[-1])]
    for _ in range(shards - 1):
        floor.append(up(floor[-1] - capacity))
    out, at = [], 0
    for k in range(1, shards):
        target = at + (total - at) // (shards - k + 1)
        low, high = down(target), up(target)
        even = high if low <= at or high - target < target - low else low
        at = max(at, min(down(min(at + capacity, total)), max(even, floor[-k])))
        out.append(at)
    return out


@pytest.mark.parametrize("hot", [0, 1, 3])
def test_the_driver_gets_few_sums_whatever_the_largest_group(spark, monkeypatch, hot):
    """20,000 groups, of which some have a fiftieth of all bytes each; the keys are those that all groups at once give."""
    monkeypatch.setattr(sharding, "FAN", 8)
    monkeypatch.setattr(sharding, "REFINED", 1024)
    rng = random.Random(hot)
    keys, sizes = list({rng.getrandbits(64) - 2**63 for _ in range(20_000)}), [rng.randrange(16, 900) for _ in range(20_000)]
    for k in range(hot):
        sizes[k] = sum(sizes[hot:]) // (50 - hot)
    rows_of = spark.createDataFrame(list(zip(keys, sizes, strict=True)), "key bigint, size bigint")
    got, plain = [], Line.replace
    monkeypatch.setattr(Line, "replace", lambda self, blocks, k, s, n: (got.append(len(k)), plain(self, blocks, k, s, n)))
    capacity, cuts, ahead = cut_keys(rows_of, blocks=4096)
    order = np.argsort(np.array(keys, np.int64))
    keys, sizes = np.array(keys, np.int64)[order], np.array(sizes)[order]
    least = max(int(sizes.max()), -(-int(sizes.sum()) // 40))
    best = least + bisect.bisect_left(range(int(sizes.max()) + 1), True, key=lambda more: greedy(sizes.tolist(), least + more) <= 40)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    assert ahead == [] and capacity == best
    assert [int(ends[np.searchsorted(keys, k)]) for k in cuts] == even_cuts(sizes, best, 40)
    assert max(got) <= 8 * 1024 and len(got) < 12  # FAN x REFINED sums a round at most, and few rounds


@pytest.mark.parametrize("blocks", [4, 1 << 16])
def test_rows(spark, odd_docs, no_docs, blocks):
    more = spark.createDataFrame([(4000 + i, ["hot text " * 9, f"t{i} " * (i % 37)][i % 3 > 0]) for i in range(600)], "doc_id bigint, text string")
    docs = odd_docs.select("doc_id", "text").union(more)
    found = shard_by_bytes(docs, blocks=blocks).collect()
    size = lambda t: len((t or "").encode()) + 16
    given = sorted((repr(r.doc_id), size(r.text), zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert sorted((repr(r.doc_id), r.size, r.text_crc32) for r in found) == given
    of, shards = {}, {}
    for r in found:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 40
        assert of.setdefault(r.text_crc32, r.shard) == r.shard
        shards.setdefault(r.shard, []).append(r)
    for rows in shards.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
    groups = {}
    for r in found:
        groups[r.text_crc32] = groups.get(r.text_crc32, 0) + r.size
    largest, total = max(groups.values()), sum(groups.values())
    assert max(sum(r.size for r in rows) for rows in shards.values()) <= max(largest, total / 40 + largest)
    assert shard_by_bytes(no_docs, blocks=blocks).collect() == []
