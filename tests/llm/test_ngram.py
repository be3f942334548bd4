import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from quern.llm import ngram
from quern.llm.ngram import added, discounts, pack, score, score_held_out, train, unpack

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return [*WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")), None]


def brute(rows, modulus=10):
    rest = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % modulus
    training = [tokens(t) for i, t in rows if rest(i)]
    one = Counter(w for t in training for w in t)
    pair = Counter(p for t in training for p in zip([None, *t], t, strict=False))
    contexts = Counter(w for _, w in pair)
    after = {}
    for (v, _), c in pair.items():
        after.setdefault(v, Counter())[min(c, 3)] += 1
    total = Counter()
    for (v, _), c in pair.items():
        total[v] += c
    number = lambda counts: [sum(c == k for c in counts.values()) for k in range(1, 5)]
    high, low = discounts(number(pair)), discounts(number(contexts))
    n, distinct = sum(one.values()), len(one)
    left = sum(low[min(c, 3)] for c in contexts.values())

    def p(v, w):
        a = contexts[w]
        back = (max(a - low[min(a, 3)], 0) + left / (distinct + 1)) / len(pair) if pair else 1 / (distinct + 1)
        if not total[v] or (v is not None and v not in one):
            return back
        c = pair[v, w]
        return (max(c - high[min(c, 3)], 0) + sum(high[k] * m for k, m in after[v].items()) * back) / total[v]

    out = []
    for i, t in rows:
        t = tokens(t)
        base = sum(math.log10((one[w] + 0.1) / (n + 0.1 * (distinct + 1))) for w in t)
        out.append((i, rest(i) == 0, len(t), sum(one[w] > 0 for w in t), n, base, sum(math.log10(p(v, w)) for v, w in zip([None, *t], t, strict=False))))
    vocabulary = [*one, "never seen before"]
    for v in [None, *list(one)[:5], "never seen before"]:
        assert sum(p(v, w) for w in vocabulary) == pytest.approx(1)
    return out


def same(found, expected):
    found, expected = sorted(map(tuple, found), key=repr), sorted(expected, key=repr)
    assert len(found) == len(expected)
    for a, b in zip(found, expected, strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:])


def test_equals_brute_force(spark, odd_docs, no_docs):
    same(score_held_out(odd_docs).collect(), brute([(r.doc_id, r.text) for r in odd_docs.collect()]))
    assert score_held_out(no_docs).collect() == []


def test_small_gathers_and_no_training(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(ngram, "GATHERED", 50)
    same(score_held_out(odd_docs).collect(), brute([(r.doc_id, r.text) for r in odd_docs.collect()]))
    found = score(odd_docs, train(no_docs.select("text"))).collect()
    assert {(r.n_known, r.train_tokens) for r in found} == {(0, 0)} and all(r.score == 0 for r in found)


def test_packed_arrays():
    rng = np.random.default_rng(3)
    keys, counts = added(rng.integers(0, 2**63, 1000).astype(np.uint64) >> np.uint64(50), rng.integers(1, 9, 1000))
    back = unpack(pack(keys, counts))
    assert (back[0] == keys).all() and (back[1] == counts).all() and counts.sum() > 1000
    assert [len(x) for x in unpack(pack(keys[:0], counts[:0]))] == [0, 0]


def test_counts_and_words_beyond_32_bits(spark, monkeypatch, odd_docs):
    keys, counts = np.array([1, 2, 7], np.uint64), np.array([1, (1 << 32) + 5, 3])
    back = unpack(pack(keys, counts))
    assert back[1].tolist() == counts.tolist() and ngram.narrow(counts).tolist() == counts.tolist()
    assert ngram.narrow(counts[:1]).dtype == np.uint32
    monkeypatch.setattr(ngram, "MOST_WORDS", 3)
    with pytest.raises(OverflowError):
        train(odd_docs.select("text"))


def test_frequent_contexts_lie_in_many_parts(spark):
    rows = [(i, " ".join(f"the w{i * 7 % 50 + j}" for j in range(60))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    same(score_held_out(docs).collect(), brute(rows))
    model = train(docs.select("text"))
    [the] = model.hot.tolist()
    parts = model.pair_part((np.uint64(the) << np.uint64(32)) | np.arange(1, 200, dtype=np.uint64))
    assert set(parts.tolist()) == set(range(model.n)) and model.hot_stats[0, 0] == 40 * 60


def test_model_beats_the_base_on_held_out_prose(spark):
    import random

    rng = random.Random(4)
    follow = {w: rng.sample(range(200), 5) for w in range(200)}

    def text():
        w, out = 0, []
        for _ in range(120):
            w = rng.choice(follow[w])
            out.append(f"w{w}")
        return " ".join(out)

    docs = spark.createDataFrame([(i, text()) for i in range(300)], "doc_id bigint, text string")
    held = [r for r in score_held_out(docs).collect() if r.held_out]
    assert sum(r.score for r in held) > 0.5 * sum(r.base_score for r in held)
