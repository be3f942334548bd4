import itertools
import random

import numpy as np
import pytest
import xxhash

from quern.llm import simhash
from quern.llm.simhash import allocate, ball, compared, components, grouped_bits, keep_one, links, simhash_dedup, values_of
from tests.llm.conftest import words


def brute_fingerprint(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate({c: " " for c in range(9, 14)}).split(" ")
    w = [x for x in w if x]
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    """Smallest index reachable."""
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(range(len(fps)), 2):
            if (fps[a] ^ fps[b]).bit_count() <= 4 and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return label


def near_copies(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(12):
        t = words(rng, 300).split()
        for _ in range(rng.randrange(1, 9)):
            texts.append(" ".join(t))
            t[rng.randrange(len(t))] = "edited"
    return texts


def test_equals_brute_force(spark, odd_docs, no_docs):
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(near_copies(1), 3000)), "doc_id bigint, text string"))
    given = docs.collect()
    fps = [brute_fingerprint(r.text) for r in given]
    labels, expected = brute_components(fps), []
    for r, fp, label in zip(given, fps, labels, strict=True):
        ids = [x.doc_id for x, other in zip(given, labels, strict=True) if other == label and x.doc_id is not None]
        expected.append((r.doc_id, f"{fp:016x}", min(ids) if ids else None))
    assert sorted(map(tuple, simhash_dedup(docs).collect()), key=repr) == sorted(expected, key=repr)
    assert simhash_dedup(no_docs).collect() == []


@pytest.mark.parametrize("chunk", [2, 7, 4096])
def test_links_connect_as_all_pairs_do(spark, monkeypatch, chunk):
    """Also where each value is cut into many chunks."""
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    rng = random.Random(chunk)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for base in list(fps)[:8]:
        for _ in range(12):
            fps.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 5))))
    fps = [int(np.uint64(x).astype(np.int64)) for x in fps]
    distinct = spark.createDataFrame([(x,) for x in fps], "fp bigint")
    edges = links(distinct)
    found = edges.collect()
    assert all(0 < ((u ^ v) & (2**64 - 1)).bit_count() <= 4 for u, v in found)
    root = {r.v: r.root for r in components(edges).collect()}
    ours = [root.get(x, x) for x in fps]
    for (a, x), (b, y) in itertools.combinations(enumerate(brute_components([x & (2**64 - 1) for x in fps])), 2):
        assert (x == y) == (ours[a] == ours[b])


@pytest.mark.parametrize("choice", [2, 3, 4, 5])
@pytest.mark.parametrize("chunk", [3, 4096])
def test_every_number_of_partitions_links_the_same(spark, monkeypatch, choice, chunk):
    """Wide partitions too, whose values are counted only where they are hot."""
    monkeypatch.setattr(simhash, "CHOICES", (choice,))
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    rng = random.Random(choice)
    fps = {rng.getrandbits(64) for _ in range(40)}
    fps |= {base ^ sum(1 << b for b in rng.sample(range(64), 4)) for base in list(fps)[:10] for _ in range(8)}
    fps = [int(np.uint64(x).astype(np.int64)) for x in fps]
    distinct = spark.createDataFrame([(x,) for x in fps], "fp bigint")
    assert sum(p.t for p in simhash.plan(distinct)) >= 4 - choice + 1
    root = {r.v: r.root for r in components(links(distinct)).collect()}
    ours = [root.get(x, x) for x in fps]
    for (a, x), (b, y) in itertools.combinations(enumerate(brute_components([x & (2**64 - 1) for x in fps])), 2):
        assert (x == y) == (ours[a] == ours[b])


def test_more_fingerprints_take_wider_partitions():
    """By the estimates of even fingerprints; the estimate of two pieces is near the true count."""
    rng = np.random.default_rng(5)
    sample = rng.integers(0, 1 << 20, 30_000)
    whole = np.bincount(sample, minlength=1 << 20)
    pieces = [np.bincount(sample & 1023, minlength=1024), np.bincount(sample >> 10, minlength=1024)]
    assert simhash.estimated(pieces, 30_000, 3)[3] == pytest.approx(compared(whole, 3), rel=0.1)

    def width(n):
        cost = {}
        for m in (2, 3, 4):
            bits = 64 // m
            costs = [{-1: 0.0} | {t: n * n * len(ball(bits, t)) / 2.0**bits + 16 * n * len(ball(bits, t)) for t in range(3)}] * m
            cost[m] = allocate(costs)[0]
        return min(cost, key=cost.get)

    assert width(10**5) == 4 and width(10**7) == 3 and width(10**11) == 2


@pytest.mark.parametrize("many", [0, 100_000])
def test_hubs_and_hot_keys_are_broadcast(spark, monkeypatch, many):
    monkeypatch.setattr(simhash, "MANY_EDGES", many)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(500 - i, 500) for i in range(1, 60)]
    root = {r.v: r.root for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert root == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 60)} | {i: 441 for i in range(442, 501)}


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    root = {r.v: r.root for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert root == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 30)}


def test_plan_parts():
    rng = np.random.default_rng(1)
    correlation = np.abs(rng.standard_normal((64, 64)))
    groups = grouped_bits((correlation + correlation.T) / 2, 5)
    assert sorted(itertools.chain(*groups)) == list(range(64)) and {len(g) for g in groups} <= {12, 13}
    histogram = rng.integers(0, 5, 64)
    for t in range(3):
        brute = sum(histogram[a] * histogram[b] for a in range(64) for b in range(64) if (a ^ b).bit_count() <= t)
        assert compared(histogram, t) == pytest.approx(brute)
    costs = [{t: float(rng.integers(1, 100)) * (t + 1) for t in range(-1, 3)} for _ in range(4)]
    brute = min(sum(c[t] for c, t in zip(costs, ts, strict=True)) for ts in itertools.product(range(-1, 3), repeat=4) if sum(ts) == 1)
    assert allocate(costs)[0] == pytest.approx(brute)
    assert len(ball(16, 2)) == 1 + 16 + 120
    assert values_of(np.array([0b1010], np.int64), [1, 3]).tolist() == [3]


def test_keep_one_tells_texts_of_one_id_apart(spark):
    a, b, other = (words(random.Random(x), 60) for x in (1, 2, 3))
    docs = spark.createDataFrame([(5, a, 1), (5, b, 2), (3, b, 3), (7, other, 4), (7, other, 4), (7, a + " more", 5)], "doc_id bigint, text string, row int").selectExpr("*", "0 AS _id_", "1 AS link", "2 AS component_id", "3 AS listed_id")
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.row != 5) == [(3, b), (5, a), (7, other)]


def test_keep_one(spark, odd_docs):
    kept = keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    firsts = {r.component_id for r in simhash_dedup(odd_docs).collect() if r.doc_id is not None}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(firsts) and ids.count(None) == 2


def test_keep_one_without_repeats_and_by_shuffle(spark, monkeypatch):
    from quern.llm import common

    docs = spark.createDataFrame(list(enumerate(near_copies(5))), "doc_id bigint, text string")
    firsts = sorted({r.component_id for r in simhash_dedup(docs).collect()})
    assert sorted(r.doc_id for r in keep_one(docs).collect()) == firsts
    monkeypatch.setattr(common, "MOST_SENT", 0)
    assert sorted(r.doc_id for r in keep_one(docs.union(docs)).collect()) == firsts
