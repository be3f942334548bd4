import random
import zlib

import numpy as np

from quern.llm import langid
from quern.llm.langid import HASHES, SIZES, Filters, grams, language_id, train

LANGS = {"aa": ["shan", "ther", "ing", "wo", "of", "the"], "bb": ["ção", "ñue", "ment", "de", "la", "os"], "cc": ["sch", "ung", "ber", "ich", "der", "zu"]}


def prose(rng, lang, n):
    return " ".join("".join(rng.choices(LANGS[lang], k=rng.randrange(1, 4))) for _ in range(n))


def corpus(spark):
    rng, data = random.Random(1), []
    for i in range(240):
        lang = rng.choice(list(LANGS))
        data.append((i, prose(rng, lang, rng.randrange(20, 90)), None if i % 11 == 0 else lang))
    return spark.createDataFrame(data, "doc_id bigint, text string, lang string")


def test_held_out_accuracy(spark):
    docs = corpus(spark)
    truth = {r.doc_id: r.lang for r in docs.collect()}
    found = language_id(docs).collect()
    assert len(found) == 240 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    held = [r for r in found if r.held_out and truth[r.doc_id]]
    assert len(held) > 20 and all(r.lang_pred == truth[r.doc_id] and 0 < r.score <= 1 for r in held)


def test_odd_rows(spark, odd_docs, no_docs):
    found = language_id(odd_docs).collect()
    assert len(found) == odd_docs.count()
    for r, d in zip(sorted(found, key=repr), sorted(odd_docs.selectExpr("doc_id", "pmod(crc32(cast(coalesce(cast(doc_id as string), '') as binary)), 5) = 0 AS held_out", "text").collect(), key=repr), strict=False):
        assert 0 <= r.score <= 1 and r.lang_pred in {"und", "en", "fr"}
    und = sorted(r.doc_id for r in found if r.lang_pred == "und" and r.doc_id is not None)
    assert und == sorted(r.doc_id for r in odd_docs.collect() if r.doc_id is not None and not any(map(str.isalpha, r.text or "")))
    assert language_id(no_docs).collect() == []
    nothing = odd_docs.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang")
    assert {r.lang_pred for r in language_id(nothing).collect()} == {"und"}


def test_filters_know_what_they_hold_and_correct_what_they_do_not():
    rng = np.random.default_rng(1)
    own = [rng.integers(0, 2**63, 3000).astype(np.uint64) for _ in range(70)]
    filters = Filters([f"l{i:02}" for i in range(70)], [1] * 70, own, slots=1 << 14)
    for i in (0, 63, 64, 69):
        assert ((filters.containing(own[i])[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).all()
    other = rng.integers(0, 2**63, 20_000).astype(np.uint64)
    masks = filters.containing(other)
    for i in (3, 66):
        wrong = float(((masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean())
        assert abs(wrong - filters.false[i]) < 0.02 and 0.05 < filters.false[i] < (1 - np.exp(-HASHES * 3000 / 2**14)) ** HASHES + 0.02


def test_grams():
    assert len(grams("Ab 12 c", 2)) == len(" ab c ") - 1
    assert (grams("AB--c", 3) == grams("ab c", 3)).all() and len(grams("12", 4)) == 0
    assert all(len(grams("", n)) == 0 for n in SIZES)


def test_the_sample_is_bounded_and_by_rank(spark):
    docs = corpus(spark)
    few = train(docs, sample=3)
    chosen = {}
    for r in sorted(docs.collect(), key=lambda r: (zlib.crc32(str(r.doc_id).encode()), r.doc_id)):
        if r.lang and zlib.crc32(str(r.doc_id).encode()) % 5 and len(chosen.setdefault(r.lang, [])) < 3:
            chosen[r.lang].append(r.text)
    for i, lang in enumerate(few.langs):
        mine = {g for t in chosen[lang] for n in SIZES for g in grams(t, n).tolist()}
        mask = few.containing(np.array(sorted(mine), np.uint64))[0]
        assert ((mask >> np.uint64(i)) & np.uint64(1)).mean() == 1 and len(mine) < langid.PER_SIZE


def test_only_the_languages_with_the_most_rows_are_learned(spark):
    from quern.llm.langid import train

    rows = [(i, f"words of tongue {i % 3} " * 5, ["aa", "bb", "cc"][min(i % 5, 2)]) for i in range(60)] + [(100 + i, "junk", f"dirty{i}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert train(docs, most_langs=2).langs == ["aa", "cc"] or train(docs, most_langs=2).langs == ["bb", "cc"]
    assert len(train(docs, per_size=5).langs) > 20
