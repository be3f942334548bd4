import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quern.llm import decontaminate
from quern.llm.decontaminate import RADIUS, SIMILARITY, blocks, contaminated, fingerprint, items_of, keep_clean
from tests.llm.conftest import words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(w, k):
    return [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]


def brute(docs, items):
    """All windows that have a shared shingle in its place; similarity by counts."""
    out = {}
    for d, text in docs:
        w = WORD.findall((text or "").lower())
        for i, item in items:
            v = WORD.findall((item or "").lower())
            if not v:
                continue
            k, n = min(5, len(v)), len(v)
            theirs = Counter(shingles(v, k))
            starts = {max(0, min(p - o, len(w) - n)) for p, s in enumerate(shingles(w, k)) for o, x in enumerate(shingles(v, k)) if s == x}
            for first in sorted(starts):
                ours = Counter(shingles(w[first : first + n], k))
                both = sum((ours & theirs).values())
                similarity = both / (sum(ours.values()) + sum(theirs.values()) - both)
                if similarity >= SIMILARITY:
                    out.setdefault((d, i), []).append((-similarity, first))
    return sorted(((d, i, -min(x)[0], min(x)[1], len({f for _, f in x})) for (d, i), x in out.items()), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    items = [(i, words(rng, rng.randrange(15, 60))) for i in range(12)] + [(20, "one two three"), (21, "solo"), (22, None), (23, " "), (24, "a b c d e"), (25, "rep eat " * 12)]
    items += [(30, items[0][1])]
    docs = []
    for d in range(120):
        text = words(rng, rng.randrange(0, 120)).split()
        if d % 3 == 0:
            item = rng.choice(items[:12])[1].split()
            for _ in range(rng.randrange(0, 3)):
                item[rng.choice([0, 1, -2, -1, rng.randrange(len(item))])] = "changed"
            if d % 12 == 3:
                del item[rng.randrange(len(item))]
            at = rng.randrange(len(text) + 1)
            text[at:at] = item
        docs.append((d, rng.choice([" ", "\n", "  "]).join(text).title() if d % 5 == 0 else " ".join(text)))
    docs += [(200, "x one two three y"), (201, "solo"), (202, None), (203, ""), (204, " a b  c\td e "), (205, "rep eat " * 30), (206, items[3][1][: len(items[3][1]) * 9 // 10]), (None, items[4][1]), (200, "x one two three y"), (200, items[5][1])]
    return docs, items


@pytest.mark.parametrize(("rows", "slices"), [(2_000_000, 8), (200, 8), (200, 0)])
def test_equals_brute_force(spark, monkeypatch, rows, slices):
    """With all items at once, in slices, and by shuffling."""
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", rows)
    monkeypatch.setattr(decontaminate, "MOST_SLICES", slices)
    docs, items = corpus(3)
    ds = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 AS n", "'x' AS words", "2 AS first")
    bs = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "'y' AS h", "3 AS k")
    found = sorted(map(tuple, contaminated(ds, bs).collect()), key=repr)
    merged = {}
    for d, i, s, first, n in brute(docs, items):
        merged.setdefault((d, i), []).append((s, first, n))
    expected = brute(docs, items)
    assert len(found) == len(merged) and len(merged) > 25
    for a, b in zip(found, expected, strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2]) and a[3:] == b[3:]
    dirty = {(d, t) for d, t in docs if brute([(d, t)], items)}
    assert sorted(keep_clean(ds, bs).select("doc_id", "text").collect(), key=repr) == sorted(((d, t) for d, t in docs if (d, t) not in dirty), key=repr)


def test_empty_tables(spark, odd_docs, no_docs):
    _, items = corpus(1)
    bs = spark.createDataFrame(items, "item_id bigint, text string")
    assert contaminated(no_docs, bs).collect() == []
    assert contaminated(odd_docs, bs.limit(0)).collect() == []
    assert keep_clean(odd_docs, bs).columns == odd_docs.columns
    assert keep_clean(odd_docs, bs).count() == odd_docs.count() == keep_clean(odd_docs, bs.limit(0)).count()


def test_blocks_and_fingerprints(spark):
    rng = random.Random(2)
    data = [([rng.getrandbits(64) - 2**63 for _ in range(rng.randrange(1, 9))],) for _ in range(50)]
    df = spark.createDataFrame(data, "h array<bigint>").select("h", fingerprint(F.col("h")).alias("fp"))
    for r in df.select("h", "fp", blocks(F.col("fp")).alias("b")).collect():
        bits = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in r.h) > len(r.h))
        assert r.fp & (2**64 - 1) == bits and len(r.b) == RADIUS + 1
        cuts = [64 * k // (RADIUS + 1) for k in range(RADIUS + 2)]
        assert [x.value for x in r.b] == [(bits >> a) & ((1 << (b - a)) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]


def test_radius_is_above_what_similar_texts_show(spark):
    rng, rows = random.Random(9), []
    for i in range(400):
        a = words(rng, 40).split()
        b = list(a)
        b[rng.choice([0, 1, 38, 39])] = "changed"
        rows += [(2 * i, " ".join(a)), (2 * i + 1, " ".join(b))]
    fps = {r.item_id: r.fp & (2**64 - 1) for r in items_of(spark.createDataFrame(rows, "item_id bigint, text string")).collect()}
    assert max((fps[2 * i] ^ fps[2 * i + 1]).bit_count() for i in range(400)) <= RADIUS


def every_window(docs, items):
    """Pairs of document and item of which any window of the item's words reaches the similarity, and the greatest."""
    out = {}
    for d, text in docs:
        w = WORD.findall((text or "").lower())
        for i, item in items:
            v = WORD.findall((item or "").lower())
            k, n = min(5, len(v)), len(v)
            theirs = Counter(shingles(v, k)) if v else Counter()
            for first in range(max(0, len(w) - n) + 1) if v else ():
                ours = Counter(shingles(w[first : first + n], k))
                both = sum((ours & theirs).values())
                similarity = both / (sum(ours.values()) + sum(theirs.values()) - both)
                if similarity >= SIMILARITY:
                    out[d, i] = max(similarity, out.get((d, i), 0))
    return out


def test_pairs_are_those_of_every_window(spark):
    docs, items = corpus(7)
    items += [(40 + j, " ".join(f"w{j}x{x}" for x in range(n))) for j, n in enumerate((44, 50, 59))]
    pasted = []
    for i, item in items[-3:]:
        v = item.split()
        pasted.append((300 + i, " ".join(["before"] * 20 + v[len(v) // 2 :] + v[: len(v) // 2] + ["after"] * 20)))
        pasted.append((400 + i, " ".join(v[len(v) // 2 :] + v[: len(v) // 2])))
        pasted.append((500 + i, " ".join(v[len(v) // 3 :] + ["between"] * 9 + v[: len(v) // 3])))  # not similar enough
    docs = [*((d, t) for d, t in docs if d is not None and d != 200), *pasted]
    ds, bs = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    expected = every_window(docs, items)
    found = {(r.doc_id, r.item_id): r for r in contaminated(ds, bs).collect()}
    assert set(found) == set(expected) and {(d, i) for d, i in expected if d >= 300} == {(d + i, i) for d in (300, 400) for i in (40, 41, 42)}
    assert brute([x for x in pasted if x[0] < 400], items) == []  # no window in place shows them
    assert all(found[x].similarity == pytest.approx(expected[x]) for x in expected if x[0] >= 300)
    assert {r.doc_id for r in keep_clean(ds, bs).collect()} == {d for d, _ in docs} - {d for d, _ in expected}


def test_random_windows_are_no_candidates_and_similar_ones_are(spark):
    """Rare shingles and blocks of items of 6 to 200 words: what the index pairs, against all pairs of equal length."""
    rng, items, texts = random.Random(12), [], []
    for i in range(120):
        n = rng.choice([6, 9, 13, 20, 48, 90, 200])
        v = [f"x{rng.randrange(400)}" for _ in range(n)]
        items.append((i, " ".join(v)))
        w = list(v)
        if n > 12:
            for _ in range(rng.randrange(0, max(1, n // 45) + 1)):
                w[rng.choice([0, 1, 2, -1, -2, rng.randrange(n)])] = "other"
        texts.append((i, " ".join(w)))
        texts.append((1000 + i, " ".join(f"x{rng.randrange(400)}" for _ in range(n))))
    of = lambda rows: decontaminate.items_of(spark.createDataFrame(rows, "item_id bigint, text string"))
    bench, ours = of(items).cache(), of(texts).withColumnRenamed("item_id", "class").cache()
    held = bench.select(F.explode(F.array_distinct("shingles")).alias("h")).groupBy("h").agg(F.count("*").alias("held"))
    m = F.size("shingles")
    a = decontaminate.rare_shingles(ours, "class", held, F.ceil(m * 2 * (0.8 / 1.8) - 1e-9).cast("int"))
    b = decontaminate.rare_shingles(bench, "item_id", held, F.ceil(m * 0.8 - 1e-9).cast("int"))
    near = F.bit_count(a.fp.bitwiseXOR(b.fp)) <= RADIUS
    found = {(r["class"], r.item_id) for r in a.join(b, (a.rare == b.rare) & (a.n == b.n) & near).select("class", "item_id").distinct().collect()}
    true = {(d, i) for (d, i), s in every_window(texts, items).items() if len(dict(texts)[d].split()) == len(dict(items)[i].split())}
    same = sum(len(t.split()) == len(v.split()) for _, t in texts for _, v in items)
    assert true <= found and len(true) > 60
    assert len(found - true) < 0.01 * same
