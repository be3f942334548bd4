import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from quern.operators import buckets, consolidate, dedup, freshness
from quern.operators.chunks import Limits, blocks, chunk_documents, chunked
from quern.operators.resolve import SEED, resolve
from quern.operators.validate import Schema, canonical_schema
from quern.plans import catalog

REF = "2026-09-10 12:00:00"
STATE = "source_id string, last_successful_crawl_at timestamp, last_attempted_crawl_at timestamp, last_boundary_item_id string, observed array<string>, total_ingested bigint"
ITEM = "source_id string, url_hash string, content_hash string, published_at timestamp, published_at_confidence double, date_extraction_method string, position int, first_seen_at timestamp, canonical_url string"


def at(text):
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc) if text else None


def test_gate_bounds(spark):
    cases = {"2026-09-09 12:01:00": "accepted_verified", "2026-09-09 11:59:00": "rejected_stale", "2026-09-10 12:30:00": "rejected_stale", "2026-09-09 12:00:00": "accepted_verified", "2026-09-10 12:15:00": "accepted_verified", "2026-09-10 12:15:01": "rejected_stale"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: r.d for r in df.select("t", freshness.gate_dated(F.to_timestamp("t"), F.to_timestamp(F.lit(REF))).alias("d")).collect()}
    assert got == cases


def item(source, h, position=2, published=None, first_seen=None):
    return (source, h, f"c-{h}", at(published), 0.9, "given", position, at(first_seen), f"https://x/{h}")


def test_undated_items_and_two_runs(spark):
    state = spark.createDataFrame([("s", at("2026-09-10 10:00:00"), None, None, ["known", "c-known2"], 3), ("new", None, None, None, [], 0)], STATE)
    items = [item("s", "a"), item("s", "known"), item("s", "known2"), item("s", "p25", 25), item("s", "p26", 26), item("s", "old", first_seen="2026-09-10 09:54:00"), item("s", "grace", first_seen="2026-09-10 09:55:00"), item("new", "b"), item("gone", "z"), item("s", "dated", published="2026-09-10 11:00:00")]
    gated = freshness.gate(spark.createDataFrame(items, ITEM), state, F.to_timestamp(F.lit(REF)))
    got = {r.url_hash: (r.freshness_decision, r.date_extraction_method, r.published_at_confidence) for r in gated.collect()}
    no = "rejected_unknown"
    yes = ("accepted_inferred", "heuristic_stateful_new_since_last_run", 0.65)
    assert got == {
        "a": yes, "known": (no, "heuristic_previously_observed", 0.0), "known2": (no, "heuristic_previously_observed", 0.0), "p25": yes, "p26": (no, "heuristic_deep_listing_position", 0.0), "old": (no, "heuristic_stale_first_seen", 0.0), "grace": yes,
        "b": (no, "heuristic_missing_baseline", 0.0), "z": (no, "heuristic_missing_baseline", 0.0), "dated": ("accepted_verified", "given", 0.9),
    }
    runs = spark.createDataFrame([("s", "SUCCESS", at(REF), at("2026-09-10 12:01:00")), ("new", "FAILED", at(REF), at(REF)), ("dead", "SUCCESS", at(REF), at(REF))], "source_id string, status string, started_at timestamp, completed_at timestamp")
    after = freshness.next_state(state, gated, runs)
    by = {r.source_id: r for r in after.collect()}
    assert by["s"].observed == sorted(["a", "c-a", "p25", "c-p25", "grace", "c-grace", "dated", "c-dated"]) and by["s"].total_ingested == 7
    assert by["s"].last_boundary_item_id == "https://x/a" and by["new"].last_successful_crawl_at is None and by["new"].last_attempted_crawl_at is not None
    assert by["dead"].observed == [] and by["dead"].last_successful_crawl_at is not None
    # What the snapshot lost is accepted in the next run; what it holds is not.
    again = freshness.gate(spark.createDataFrame([item("s", "known"), item("s", "a")], ITEM), after, F.to_timestamp(F.lit(REF)))
    assert {r.url_hash: r.freshness_decision for r in again.collect()} == {"known": "accepted_inferred", "a": no}


def test_resolver_tiers(spark):
    seed = spark.createDataFrame(catalog.SEED_ROWS, SEED)
    rows = [(i, n, d) for i, (n, d, *_) in enumerate(catalog.NAME_ROWS)]
    got = {r.i: r for r in resolve(spark.createDataFrame(rows, "i int, raw_name string, domain string"), seed).collect()}
    for i, (_, _, cid, how, score) in enumerate(catalog.NAME_ROWS):
        assert (got[i].canonical_entity_id, got[i].match_strategy, got[i].confidence) == (cid, how, score), catalog.NAME_ROWS[i]
    assert got[0].domains_used == ["northwind.example"] and got[2].aliases_used == ["blue fin"] and got[10].aliases_used == ["Beta Works"]
    assert got[13].unresolved_reason == "EMPTY_INPUT" and got[11].unresolved_reason == "NO_MATCHING_ENTITY_FOUND" and "Bluefin AI" in got[3].unresolved_reason
    second = {r.i: r for r in resolve(spark.createDataFrame(rows, "i int, raw_name string, domain string"), seed, prepared_aliases=False, unicode_words=False).collect()}
    assert second[7].canonical_entity_id == "e5" and second[6].match_strategy == "UNRESOLVED" and second[5].canonical_entity_id == "e3"
    for word in ["AI", "Lab", "Systems", "Cloud"]:
        assert resolve(spark.createDataFrame([(word, None)], "raw_name string, domain string"), seed).collect()[0].match_strategy == "UNRESOLVED"


def test_record_hash_leaves_out_what_changes(spark):
    df = spark.createDataFrame([("STARTUP", " Acme ", "https://a.b/", None), ("STARTUP", "acme", "https://A.b", "x"), ("PRODUCT", "acme", "https://a.b", "FREE"), ("PRODUCT", "acme", "https://a.b", "PAID"), ("JOB", "acme", "https://a.b", None)], "k string, n string, u string, p string")
    h = [r[0] for r in df.select(dedup.record_hash(F.col("k"), F.col("n"), F.col("u"), F.col("p"))).collect()]
    assert h[0] == h[1] and len(set(h)) == 4 and h[4] is None


def test_upsert(spark):
    schema = "id string, source_id string, canonical_url_hash string, content_hash string, title string, first_seen_at int, ingested_at int, canonical_url string"
    target = spark.createDataFrame([("1", "s", "u1", "c1", "old", 1, 1, "a"), ("2", "s", "u2", "c2", "two", 1, 1, "b")], schema)
    batch = spark.createDataFrame([("9", "s", "u1", "c9", "new", 5, 5, "z"), ("8", "s", "u1", "c8", "older", 4, 4, "z"), ("7", "s", "u3", "c2", "clash", 5, 5, "c"), ("6", "s", "u4", "c4", "four", 5, 5, "d")], schema)
    got = {r.canonical_url_hash: tuple(r) for r in dedup.upsert(target, batch).collect()}
    assert got == {"u1": ("1", "s", "u1", "c9", "new", 1, 1, "a"), "u2": ("2", "s", "u2", "c2", "two", 1, 1, "b"), "u4": ("6", "s", "u4", "c4", "four", 5, 5, "d")}


def test_chunks():
    found, *_ = chunked("# A\n" + "a" * 60 + "\n# B\n" + "b" * 60 + "\n# C\n" + "c" * 60, Limits(max_chars=120))
    assert len(found) == 3 and found[0][2] == 0 and found[1][2] == found[0][3] + 2
    assert [c[1] for c in chunked("one paragraph here\n\nsecond paragraph of some text here\n\nthird one, last of all", Limits(max_chars=40))[0]] == ["one paragraph here", "second paragraph of some text here", "third one, last of all"]
    assert [len(c[1]) for c in chunked("A" * 150, Limits(max_chars=50))[0]] == [50, 50, 50]
    found, left, first, last = chunked("Word " * 5000, Limits(max_chars=200, max_chunks=3))
    assert len(found) == 3 and left > 0 and (first, last) == (found[-1][3] + 2, 25000)
    assert chunked(" \n", Limits()) == ([], 0, -1, -1) and chunked(None, Limits())[0] == []
    assert blocks("First. Second one. Third", 12) == ["First.", "Second one.", "Third"]
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choices(["word ", "\n\n", "# H\n", "- x\n", "End. ", "y" * 30], k=rng.randrange(60)))
        for block in blocks(text, 50):
            assert len(block) <= 50 or block == text


def test_chunk_table(spark):
    df = spark.createDataFrame([(1, "A" * 150), (2, None), (3, "short")], "doc_id bigint, text string")
    got = chunk_documents(df, Limits(max_chars=50)).orderBy("doc_id", "index").collect()
    assert [(r.doc_id, r.chunk_id, r.start_offset, r.end_offset) for r in got] == [(1, "chunk-001", 0, 50), (1, "chunk-002", 52, 102), (1, "chunk-003", 104, 154), (3, "chunk-001", 0, 5)]
    assert all(r.truncated is False and r.omitted_start is None for r in got)


def test_consolidation(spark):
    parts = [("k", 0, '{"a":"short","n":0,"l":["x"],"o":{"p":null},"z":null}'), ("k", 1, "broken"), ("k", 2, '{"a":" a longer one ","n":7,"l":["y","x"],"o":{"p":1,"q":2},"z":" "}'), ("k", 3, '{"a":"","n":3,"b":false}'), ("m", 0, "[1]")]
    got = consolidate.consolidate(spark.createDataFrame(parts, "key string, i int, j string"), "key", "i", "j").collect()
    assert len(got) == 1 and got[0].n == 3
    assert json.loads(got[0].merged) == {"a": " a longer one ", "n": 7, "l": ["x", "y"], "o": {"p": 1, "q": 2}, "z": None, "b": False}
    assert consolidate.richer("ab", "cd") == "ab" and consolidate.richer(5, 0) == 5 and consolidate.richer("x", 1) == 1


def test_schemas(spark):
    good = {"schemaVersion": "1.0", "recordType": "RESEARCH_PAPER", "source": {"name": "s", "url": "u"}, "content": {"title": "t", "authors": ["a"], "paper_url": "p", "github_url": None, "github_stars": 3, "published_date": "d"}, "collectedAt": "now", "more": 1}
    cases = [
        (good, ""), (good | {"source": None}, "/source must be object"), ({k: v for k, v in good.items() if k != "collectedAt"}, "/ must have required property 'collectedAt'"), (good | {"content": good["content"] | {"github_stars": None}}, "/content/github_stars must be integer"),
        (good | {"content": good["content"] | {"github_stars": -1}}, "/content/github_stars must be >= 0"), (good | {"content": good["content"] | {"authors": ["a", 2]}}, "/content/authors/items must be string"), (good | {"source": {"name": "", "url": "u"}}, "/source/name must NOT have fewer than 1 characters"),
    ]
    df = spark.createDataFrame([(i, json.dumps(c)) for i, (c, _) in enumerate(cases)] + [(99, "no json")], "i int, j string")
    got = {r.i: r.m for r in df.select("i", Schema(canonical_schema("RESEARCH_PAPER")).message(F.try_parse_json("j")).alias("m")).collect()}
    assert got == {i: m for i, (_, m) in enumerate(cases)} | {99: "/ is not JSON"}


@pytest.mark.parametrize("seed", [1, 2])
def test_token_bucket(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice("ab"), at(REF) + dt.timedelta(milliseconds=rng.randrange(4000))) for i in range(120)]
    got = buckets.token_bucket(spark.createDataFrame(rows, "id bigint, k string, t timestamp"), "k", "t", "id").collect()
    expected = {}
    for k in "ab":
        tokens, last = 10_000_000, None
        for i, _, t in sorted((r for r in rows if r[1] == k), key=lambda r: (r[2], r[0])):
            tokens = min(10_000_000, tokens + ((t - last) // dt.timedelta(microseconds=1) if last else 0) * 5)
            last, ok = t, tokens >= 1_000_000
            tokens -= 1_000_000 * ok
            expected[i] = ok
    assert {r.id: r.allowed for r in got} == expected and not all(expected.values())
    paced = buckets.pacing(spark.createDataFrame(rows, "id bigint, k string, t timestamp"), "k", "t", "id").collect()
    for k in "ab":
        starts = sorted(r.starts for r in paced if r.key == k)
        assert all(b - a >= 0.2 - 1e-6 for a, b in zip(starts, starts[1:], strict=False))
