import pytest
from pyspark.sql import functions as F

from quern.operators import freshness, summary
from quern.plans import export, signals
from quern.sources import feeds, inputs, markup, robots
from quern.streaming import signals as stream

PAGE = """<html><head><title>Fallback</title><meta property="og:title" content="The title"><meta name="author" content="Ann"><meta property="og:site_name" content="Acme"><meta name="description" content="Sum"></head>
<body><nav>menu</nav><header><h1>lost</h1></header><div class="shared-box">gone</div><div class="ad">stays</div><main><h2>Sub &amp; head</h2><p>One <b>two</b></p><ul><li>a<li>b</ul><span class="pay">$5</span></main><script>x</script></body></html>"""
PAYLOAD = "source_id string, payload_no int, body string, base_url string"


def test_article_and_job():
    a = markup.article(PAGE)
    assert (a["title"], a["author"], a["summary"]) == ("The title", "Ann", "Sum")
    assert a["full_text"].startswith("## Sub & head\n") and "One two" in a["full_text"] and "- a\n- b" in a["full_text"]
    whole = markup.readable(markup.clean(markup.tree(PAGE)))
    assert "stays" in whole and not any(x in whole for x in ("menu", "lost", "gone", "script"))
    j = markup.job(PAGE, {"salary": ".pay", "title": "main > h2, h2"})
    assert (j["company"], j["salary"], j["location"], j["title"]) == ("Acme", "$5", None, "Sub & head")
    assert markup.job(None)["company"] == markup.UNKNOWN_COMPANY and markup.article("")["full_text"] == ""


def test_named_references_need_their_semicolon():
    a = markup.article('<title>A&amp;&amp</title><meta name="author" content="B &copy C"><article><h1>A&amp;&amp</h1><p>&quot;x&quot &notit; &notin; &copy; &#38 &ampb &</p></article>')
    assert a == {"title": "A&&amp", "author": "B &copy C", "summary": None, "full_text": '# A&&amp\n\n"x&quot &notit; \u2209 \xa9 & &ampb &'}
    assert markup.listing('<a href="/l?a=1&copy=2&amp;lt=3">t &amp u</a>', "https://b.c/", {}) == [("https://b.c/l?a=1&copy=2&lt=3", "t &amp u", None)]
    odd = "<p \U000f0000&copy='&copy'>\U000f0000&amp</p><script>&amp &amp;</script>"  # the first character that might stand for an ampersand is the page's own
    assert list(markup.tree(odd).texts()) == ["\U000f0000&amp", "&amp &amp;"] and markup.tree(odd).find("p").attrs == {"\U000f0000&copy": "&copy"}
    (card,) = markup.product_cards('<div><h3><a href="/a">A &amp B</a></h3></div>', "https://b.c")  # read by Python's parser in the first place
    assert card[0] == "A & B"


def test_selectors():
    root = markup.tree('<div id="x" class="a b"><p data-k="one two"><a href="https://q">t</a></p></div><p class="b">u</p>')
    count = lambda s: sum(1 for _ in root.select(s))
    assert [count(s) for s in ("p", ".b", "#x p a", "div.a.b", "[data-k]", "[href^='https']", "a, p", "[data-k~=two]", "p a[href$=q]", "div a.b", "*")] == [2, 2, 1, 1, 1, 1, 3, 1, 1, 0, 4]


def test_feeds(spark):
    rss = '<rss xmlns:dc="d"><channel><item><title>AI one</title><link>/a</link><dc:date>2026-09-10</dc:date><author>Bo</author></item><item><title>No link</title></item><item><title>Email</title><guid>https://g.h/x</guid></item><item><title>other</title><link>/c</link></item></channel></rss>'
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>ai two</title><link href="https://z.y/b"/><updated>2026</updated></entry></feed>'
    df = spark.createDataFrame([("s", 0, rss, "https://b.c/"), ("s", 1, atom, "https://b.c/"), ("t", 0, "<broken", "https://b.c/")], PAYLOAD)
    found, failed = feeds.discover_feed(df, ["ai"])
    got = [(r.position, r.raw_url, r.title, r.published_date_raw, r.author_or_company) for r in found.orderBy("position").collect()]
    assert got == [(0, "https://b.c/a", "AI one", "2026-09-10", "Bo"), (1, "https://g.h/x", "Email", None, None), (2, "https://z.y/b", "ai two", "2026", None)]
    assert [(r.source_id, r.payload_no) for r in failed.collect()] == [("t", 0)]
    assert feeds.discover_feed(df, ["ai"], limit=2)[0].count() == 2


def test_listing(spark):
    html = '<article><a href="#x">no</a></article><article><h2>T</h2><a href="/j/1">go</a><i class="company">C</i></article><article><a href="javascript:x">no</a></article><article><a href="k">plain text</a></article>'
    found, _ = feeds.discover_listing(spark.createDataFrame([("s", 0, html, "https://b.c/d/")], PAYLOAD), {"item_container": "article"})
    assert [(r.position, r.raw_url, r.title, r.author_or_company) for r in found.orderBy("position").collect()] == [(0, "https://b.c/j/1", "T", "C"), (1, "https://b.c/d/k", "plain text", None)]


def test_robots_and_counters(spark):
    rules = spark.createDataFrame([("https://a.b", 200, "User-agent: *\nDisallow: /x")], "origin string, status int, body string")
    df = spark.createDataFrame([("https://a.b/x/1",), ("https://a.b/y",), ("https://c.d/x",), (None,)], "url string")
    assert {r.url: r.allowed for r in robots.allowed(df, rules, "q").collect()} == {"https://a.b/x/1": False, "https://a.b/y": True, "https://c.d/x": True, None: True}
    odd = spark.createDataFrame([("http://[x",)], "url string")
    assert [r.allowed for r in robots.allowed(odd, spark.createDataFrame([("http://[x", 200, "User-agent: *\nDisallow: /")], "origin string, status int, body string"), "q").collect()] == [True]
    got = spark.createDataFrame([(0, "1.2k stars"), (1, "3,400"), (2, "2M"), (3, "none")], "i int, t string").orderBy("i").select(feeds.counter(F.col("t")).alias("n")).collect()
    assert [r.n for r in got] == [1200, 3400, 2_000_000, None]


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(2, 'b "q"', None), (1, "a", 5), (3, "c\nd", 6)], "id int, name string, n int")
    export.write_json_array(df, "id", f"{tmp_path}/array")
    import json
    from pathlib import Path

    text = "".join(p.read_text() for p in sorted(Path(f"{tmp_path}/array").glob("part-*")))
    assert [r["id"] for r in json.loads(text)] == [1, 2, 3] and json.loads(text)[1] == {"id": 2, "name": 'b "q"', "n": None}
    ties = spark.createDataFrame([(None, "x"), (None, "x"), (2, "b"), (2, "a"), (2, "b")], "id int, v string")
    for rows, n in ((ties, 5), (ties.limit(0), 0), (ties.where("v = 'x'"), 2)):
        export.write_json_array(rows, "id", f"{tmp_path}/array")
        found = json.loads("".join(p.read_text() for p in sorted(Path(f"{tmp_path}/array").glob("part-*"))))
        assert len(found) == n and found == sorted(found, key=lambda r: (r["id"] or 0, r["v"]))
    export.write_jsonl(df, f"{tmp_path}/lines")
    assert spark.read.json(f"{tmp_path}/lines").count() == 3
    counts = export.write_workbook({"Some Tab": df, "Empty": df.limit(0)}, f"{tmp_path}/book")
    assert {r.tab: r.n for r in counts.collect()} == {"Some Tab": 3, "Empty": 0}
    assert spark.read.csv(f"{tmp_path}/book/some_tab", header=True, multiLine=True, escape='"').count() == 3
    assert spark.read.csv(f"{tmp_path}/book/empty", header=True).collect()[0].status == export.EMPTY_NOTE


def test_streams_equal_batches(spark, tmp_path):
    rows = [(r, f"u{u}", p) for r, u, p in [("2026-09-01", 1, 0), ("2026-09-01", 2, 1), ("2026-09-02", 1, 0), ("2026-09-02", 3, 30), ("2026-09-03", 1, 0), ("2026-09-03", 4, 2)]]
    df = spark.createDataFrame(rows, "d string, url_hash string, position int").select(F.lit("s").alias("source_id"), F.to_timestamp("d").alias("run_at"), "url_hash", "position")
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    read = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    got = stream.run_to_end(stream.undated_gate(read), "undated", f"{tmp_path}").collect()
    how = {(r.run_at.strftime("%d"), r.url_hash): r.method.removeprefix("heuristic_") for r in got}
    assert how == {
        ("01", "u1"): "missing_baseline", ("01", "u2"): "missing_baseline", ("02", "u1"): "stateful_new_since_last_run", ("02", "u3"): "deep_listing_position", ("03", "u1"): "previously_observed", ("03", "u4"): "stateful_new_since_last_run",
    }


def test_a_run_in_several_micro_batches_is_one_run(spark, tmp_path):
    """Whatever the cut: a baseline of four items, and a run whose items the next one knows."""
    days = ["2026-09-01"] * 4 + ["2026-09-02"] * 4 + ["2026-09-03"] * 4
    rows = [(d, f"u{i % 4}", i % 4) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "d string, url_hash string, position int").select(F.lit("s").alias("source_id"), F.to_timestamp("d").alias("run_at"), "url_hash", "position")
    found, all_rows = [], df.collect()
    for name, cuts in (("one", [0, 12]), ("cut", [0, 2, 5, 6, 11, 12])):
        for a, b in zip(cuts, cuts[1:], strict=False):  # a micro-batch each
            spark.createDataFrame(all_rows[a:b], df.schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}/in")
            read = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/{name}/in")
            got = stream.run_to_end(stream.undated_gate(read), "undated", f"{tmp_path}/{name}/check")
        found.append(sorted(map(tuple, got.select(F.col("run_at").cast("string"), "url_hash", "method").collect())))
    assert found[0] == found[1] and len(found[0]) == 12
    assert [m for _, _, m in found[0]] == ["heuristic_missing_baseline"] * 4 + ["heuristic_stateful_new_since_last_run"] * 4 + ["heuristic_previously_observed"] * 4


def test_a_directory_is_cut_only_where_it_says_so(spark):
    import json

    body = json.dumps({str(i): {"cik_str": i, "ticker": "T", "title": f"Firm {i}"} for i in range(1500)})
    df = spark.createDataFrame([(body, None)], "body string, batch_count int")
    assert feeds.directory_records(df, "d", "https://d.example/").count() == 1500
    assert feeds.directory_records(df.withColumn("batch_count", F.lit(7)), "d", "https://d.example/").count() == 7


def test_unreadable_payloads_and_selections(spark):
    bad = feeds.unreadable(spark.createDataFrame([(1, "<feed/>"), (2, "<feed>"), (3, None)], "k int, body string")).collect()
    assert sorted(r.k for r in bad) == [2, 3] and all(r.error.startswith("ParseError") for r in bad)
    assert feeds.selected("research_paper") == ("papers",) and feeds.selected("startup") == ("knowledge_base", "directory") and len(feeds.selected()) == 5
    with pytest.raises(ValueError):
        feeds.selected("poem")


def test_inputs(spark, tmp_path):
    (tmp_path / "sources.json").write_text('[{"id": "a", "type": "news"}, {"id": "b", "type": "job"}, {"id": "c", "type": "news"}]')
    (tmp_path / "object.json").write_text('{"id": "a"}')
    sources = inputs.read_sources(spark, f"{tmp_path}/sources.json", "id string, type string")
    assert sorted(r.id for r in inputs.selected_sources(sources, kind="news").collect()) == ["a", "c"]
    assert [r.id for r in inputs.selected_sources(sources, ["a", "b"], "job").collect()] == ["b"] and inputs.selected_sources(sources, []).count() == 3
    with pytest.raises(ValueError):
        inputs.read_sources(spark, f"{tmp_path}/object.json", "id string")
    folder = tmp_path / "docs"
    folder.mkdir()
    for name, text in {"a.HTML": "x", "b.txt": "  <p>x", "c.txt": "x < y"}.items():
        (folder / name).write_text(text)
    got = {r.path.rpartition("/")[2]: r.is_html for r in inputs.read_documents(spark, str(folder)).collect()}
    assert got == {"a.HTML": True, "b.txt": True, "c.txt": False}


def test_run_history_and_future_dates(spark):
    outcomes = spark.createDataFrame([("a", "accepted_verified"), ("a", "error"), ("b", "rejected_stale")], "source_id string, outcome string")
    sums, at = summary.run_summary(outcomes), F.to_timestamp(F.lit("2026-09-01"))
    empty = spark.createDataFrame([], "run_id string, source_id string, status string, started_at timestamp, completed_at timestamp, summary_json string")
    once = summary.run_history(empty, sums, at, at)
    assert {(r.source_id, r.status) for r in once.collect()} == {("a", "PARTIAL"), ("b", "SUCCESS")} and '"accepted_count":1' in once.where("source_id = 'a'").collect()[0].summary_json
    assert summary.run_history(once, sums, at, at).count() == 2
    dates = spark.createDataFrame([("2026-09-01 00:15:00",), ("2026-09-01 00:15:01",), (None,)], "d string")
    assert [r[0] for r in dates.select(freshness.is_future(F.to_timestamp("d"), at)).collect()] == [False, True, None]


def test_repeated_candidates_stay_as_many(spark):
    candidates = spark.createDataFrame([("n", "/a", "listed", None, None, "d", 0, None)] * 2 + [("j", "/a", "listed", None, "C", "d", 0, None), ("n", "/none", "", None, None, "told", 1, None)], "source_id string, raw_url string, title string, published_date_raw string, author_or_company string, description string, position int, first_seen_at timestamp")
    details = spark.createDataFrame([("https://x.example/a", "<title>T</title><article><p>one</p></article>")], "canonical_url string, html string")
    sources = spark.createDataFrame([("n", "N", "news", "https://x.example"), ("j", "J", "job", "https://x.example")], "source_id string, name string, type string, base_url string")
    done = signals.extract_signals(candidates, details, sources, F.to_timestamp(F.lit("2024-01-15 00:00:00")))
    found = sorted((r.source_id, r.position, r.title, r.full_text, r.company) for r in done.collect())
    assert found == [("j", 0, "T", "one", "Unknown Company"), ("n", 0, "T", "one", None), ("n", 0, "T", "one", None), ("n", 1, "Untitled Article", "told", None)]
