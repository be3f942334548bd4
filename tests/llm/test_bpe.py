import hashlib

import public_tokenizers as P
import tiktoken

from quern.llm.bpe import Bytes, bpe_decode, bpe_encode, bpe_round_trip, distinct_units, ranks, units

PATH = P.path("byte_bpe_multi_50k.tiktoken")


def test_ids_equal_the_library_and_decode_to_the_text(spark, odd_docs):
    own = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks(PATH), special_tokens={})
    expected = []
    for r in odd_docs.select("doc_id", "text").collect():
        ids = own.encode_ordinary(r.text or "")
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        expected.append((r.doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest(), ids))
    found = [tuple(r) for r in bpe_round_trip(odd_docs, PATH, P.PATTERN, with_ids=True).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_a_table_of_one_odd_text(spark):
    """The head of a text whose pieces open with white space isn't a word by itself."""
    own = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks(PATH), special_tokens={})
    for text in ("a\n b", "\n b", "  x", "a  ", "\u3000 z\n\n q", "one"):
        [r] = bpe_round_trip(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), PATH, P.PATTERN, with_ids=True).collect()
        assert r.token_ids == own.encode_ordinary(text)


def test_texts_without_spaces_are_passed_on(spark, monkeypatch):
    from quern.llm import bpe

    monkeypatch.setattr(bpe, "MOST_SEEN", 10)
    docs = spark.createDataFrame([(i, "\n".join(f"w{i}x{j}" for j in range(40))) for i in range(30)], "doc_id bigint, text string")
    own = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks(PATH), special_tokens={})
    found = {r.doc_id: r.token_ids for r in bpe_round_trip(docs, PATH, P.PATTERN, with_ids=True).collect()}
    assert found == {r.doc_id: own.encode_ordinary(r.text) for r in docs.collect()}


def test_encode_then_decode(spark, odd_docs):
    decoded = bpe_decode(bpe_encode(odd_docs, PATH, P.PATTERN), PATH).collect()
    assert sorted(bytes(r.decoded).decode() for r in decoded) == sorted(r.text or "" for r in odd_docs.collect())


def test_empty_table_and_empty_ids(spark, no_docs):
    assert bpe_round_trip(no_docs, PATH, P.PATTERN).collect() == []
    assert Bytes(PATH).decode(b"") == b""


def test_units_split_into_the_words_of_the_text():
    import random

    import regex

    find, rng = regex.compile(P.PATTERN).findall, random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choices([" ", "  ", "\n", "a", "bc", "'s", "1", ".", "é", "\x1c", "\x85", "\xa0", "日"], k=rng.randrange(12)))
        assert "".join(units(text)) == text
        assert [w for u in units(text) for w in find(u)] == find(text), ascii(text)
        assert {w for u in distinct_units(text, set()) for w in find(u)} == set(find(text)), ascii(text)
