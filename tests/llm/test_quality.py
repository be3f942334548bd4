import re
from collections import Counter
from pathlib import Path

import public_tokenizers as P
import pytest

from quern.llm.quality import BANDS, Fertility, keep_good, quality_rules, script_of, thin

PATH = P.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, dup, len(hit), len(words) < 50 or 100 * len(hit) > 50 * len(words)


def test_counts_equal_brute_force(spark, odd_docs, no_docs):
    more = spark.createDataFrame([(5000, "a b\n c d\na b\n\n a b\na b # c % d\n" * 20), (5001, "x y z w\n" * 3 + "x y z " * 40)], "doc_id bigint, text string")
    docs = odd_docs.select("doc_id", "text").union(more)
    expected = sorted(((r.doc_id, *brute(r.text)) for r in docs.collect()), key=repr)
    found = quality_rules(docs, PATH).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert sorted(map(tuple, found), key=repr) == expected
    assert quality_rules(no_docs, PATH).collect() == []


def test_words_alone_have_the_tokens_of_the_whole_text(odd_docs):
    fertility = Fertility(PATH)
    for r in odd_docs.collect():
        words = (r.text or "").encode().split()
        text = b" ".join(words).decode()
        if " " in text or " " in text or "\x1c" in text or "\x85" in text:
            continue  # the library takes these for spaces
        assert fertility.tokens(words).sum() == len(fertility.model.encode(text))


def test_verdicts(spark, odd_docs):
    prose = "The quick brown fox jumps over the lazy dog while seven wizards quietly mix a strange brew of herbs and water near old stones. " * 1
    clean = " ".join(f"{prose} Chapter {w} begins here." for w in ("one", "two"))[:400] + " " + " ".join(f"word{i} other{i * 7}" for i in range(40))
    junk = " ".join("\U000e0041" * 5 + chr(0xE0100 + i) for i in range(80))
    got = {r.doc_id: r for r in quality_rules(spark.createDataFrame([(1, clean), (2, junk), (3, "z " * 80)], "doc_id bigint, text string"), PATH).collect()}
    assert got[1].kept and not got[2].kept and not got[3].kept
    assert got[2].byte_share > BANDS["Latin"][2] and not got[2].base_failed
    kept = keep_good(odd_docs, PATH)
    assert kept.columns == odd_docs.columns
    assert sorted(map(tuple, kept.select("doc_id").collect())) == sorted((r.doc_id,) for r in quality_rules(odd_docs, PATH).collect() if r.kept)


def test_noise_that_passes_the_counts_goes_and_prose_stays(spark):
    import base64
    import random
    import string

    rng = random.Random(1)
    prose = "The old mill by the river was built by the miller and his family more than two hundred years ago, and it has ground the corn of many farms around since then. Its wheel still turns in spring, when the water is high, and visitors come on Sundays to see how the stones are set."
    german = "Die alte Mühle am Fluss wurde vor mehr als zweihundert Jahren vom Müller und seiner Familie gebaut, und seitdem hat sie das Korn vieler Höfe der Umgebung gemahlen. Ihr Rad dreht sich im Frühling noch immer, wenn das Wasser hoch steht, und sonntags kommen Besucher, um zu sehen, wie die Steine gesetzt werden."
    greek = "Ο παλιός μύλος δίπλα στο ποτάμι χτίστηκε από την οικογένεια του μυλωνά πριν από διακόσια χρόνια και αλέθει ακόμα το σιτάρι από τα γύρω χωριά κάθε άνοιξη όταν το νερό είναι ψηλά και οι επισκέπτες έρχονται τις Κυριακές για να δουν πώς δουλεύουν οι μεγάλες πέτρες του μύλου και πώς γίνεται το αλεύρι"
    go = {
        "base64": " ".join(base64.b64encode(rng.randbytes(57)).decode() for _ in range(60)), "hex": " ".join(rng.randbytes(8).hex() for _ in range(80)),
        "letters": " ".join("".join(rng.choices(string.ascii_letters, k=7)) for _ in range(100)), "bytes": " ".join(f"x{rng.randbytes(8).decode('latin1')}" for _ in range(100)),
        "private use": " ".join("".join(chr(rng.randrange(0xE000, 0xF8FF)) for _ in range(6)) for _ in range(80)), "one word": " ".join(f"ab{'ab' * (i % 3)} ab{'-' * (i % 50)}" for i in range(60)),
        "wrong encoding": german.replace("e", "é").encode().decode("latin1"),
    }
    stay = {"prose": prose, "german": german, "greek": greek, "numbers too": prose + " In 1823 it cost 4,500 and in 1950 it was sold for 125,000."}
    data = [(i, t) for i, t in enumerate([*go.values(), *stay.values()])]
    got = {r.doc_id: r for r in quality_rules(spark.createDataFrame(data, "doc_id bigint, text string"), PATH).collect()}
    names = [*go, *stay]
    assert not any(got[i].base_failed for i in got if names[i] != "one word")
    assert [names[i] for i in sorted(got) if got[i].kept] == [*stay]


@pytest.mark.parametrize(("text", "script"), [("abc", "Latin"), ("日本語", "CJK"), ("Ελλ", "Greek"), ("", "Latin"), ("שלום", "other"), ("привет a", "Cyrillic")])
def test_script(text, script):
    assert script_of(text) == script


SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not Path(SF).exists(), reason="no test data")
def test_measures_decide_on_labelled_texts(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    rated = quality_rules(spark.read.parquet(f"{SF}/documents.parquet"), PATH).where("NOT base_failed")
    kept = Counter((r.quality, r.kept) for r in rated.join(labels, "doc_id").collect())
    assert kept[1, True] > 100 and kept[1, False] <= 0.01 * kept[1, True]
    assert kept[0, False] > 10 and kept[0, False] >= 4 * kept[0, True]


@pytest.mark.parametrize(("script", "tokens", "per_token", "entropy", "is_thin"), [("Latin", 776, 2.0, 5.96, True), ("Latin", 776, 2.0, 6.4, False), ("Latin", 776, 2.2, 5.0, False), ("Latin", 150, 2.0, 5.96, False), ("CJK", 776, 0.5, 5.0, False), ("Latin", 0, 0.0, 0.0, False)])
def test_joint_band_goes_by_length(script, tokens, per_token, entropy, is_thin):
    assert thin(script, tokens, per_token, entropy) is is_thin
