import datetime as dt

import pytest
from pyspark.sql import functions as F

from quern.functions import dates, names, politeness, text, urls

UTC = dt.timezone.utc


def column(spark, values, make, kind="string"):
    """What an expression makes of each value, in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}").coalesce(1)
    return [r.y for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


def test_canonical_urls(spark):
    pairs = {
        "HTTP://Mill.Example:80/Old/Wheel": "http://mill.example/Old/Wheel", "http://mill.example:8081/grain": "http://mill.example:8081/grain", "https://mill.example/flour#rye": "https://mill.example/flour",
        "https://mill.example/sack?no=7&utm_campaign=spring&gclid=q&MC_EID=2": "https://mill.example/sack?no=7", "https://mill.example/find?stone=2&corn=1&river=3": "https://mill.example/find?corn=1&river=3&stone=2",
        "https://mill.example": "https://mill.example/", "HTTPS://WWW.Mill.Example:443//guide///tours/#map": "https://www.mill.example/guide/tours", "http://[x": "http://[x/", "  https://a.b/x/ \n": "https://a.b/x", "": "", None: "", "mailto:a@b": "mailto:a@b", "/relative": "/relative",
        "http://a.b/x;p=1/y;q=2?k=a+b%2Fc~*&e=&f": "http://a.b/x;p=1/y?k=a+b%2Fc~%2A", "http://u:P@H.x/?b=2&b=1&B=0": "http://u:p@h.x/?B=0&b=1&b=2", "http://a.b/?x=%zz": "http://a.b/?x=%25zz", "https://a.b:80/": "https://a.b:80/",
    }
    assert column(spark, list(pairs), urls.canonical_url) == list(pairs.values())
    assert column(spark, ["https://work.example/miller/77?PHPSESSID=k&_gl=1&shift=early"], urls.signal_url) == ["https://work.example/miller/77?shift=early"]
    based = column(spark, ["../c?x=1", "//h.x/y", "https://q.z/", "d", "http://[x"], lambda x: urls.canonical_url(x, F.lit("https://a.b/p/q/")))
    assert based == ["https://a.b/p/c?x=1", "https://h.x/y", "https://q.z/", "https://a.b/p/q/d", "http://[x/"]


def test_domains_and_slugs(spark):
    assert column(spark, ["https://www.mill.example/visit?day=2", "HTTP://RIVER.EXAMPLE:443/boats", "shop.mill.example/", None, ""], urls.domain) == ["mill.example", "river.example", "shop.mill.example", "", ""]
    assert column(spark, ["https://x.y:81/a", "no", None], urls.pacing_key) == ["x.y:81", "default", "default"]
    assert column(spark, ["https://github.com/O/r.git", "https://github.com/topics/x", "https://github.com/o", "x"], urls.repository_slug) == ["O/r", None, None, None]
    assert column(spark, ["https://github.com/o/r.git/", "http://github.com/o/r/tree/x", "https://GitHub.com/o/r", None], urls.clean_repository_url) == ["https://github.com/o/r", "http://github.com/o/r", None, None]


def test_entity_names(spark):
    pairs = {
        "Riverside, Inc.": "riverside", "Open  ai Corp": "openai", "Millstone LLC": "millstone", "Millstone OpCo LLC": "millstone", "Brook Incorporated": "brook", "Mühle GmbH": "muhle", "Rye Limited": "rye", "Oats B.V.": "oats", "Barley, PBC": "barley",
        "Farine SAS": "farine", "  Eleven   labs   Ltd.  ": "elevenlabs", "w & b": "weights and biases", "Crème Brûlée": "creme brulee", "㈱ 5㎏ ①": "株 5kg 1", "a_b": "a_b", "": "", None: "", "AG Labs": "labs", "Co Star Group": "star group", "ﬁne ™": "fine tm", "日本 K.K.": "日本",
    }
    assert column(spark, list(pairs), names.entity_name) == list(pairs.values())


def test_pricing_and_counts(spark):
    assert column(spark, ["free trial", "Freemium plan", "open source", "Custom", "$9", "?", None], names.pricing_model) == ["FREEMIUM", "FREEMIUM", "FREE", "ENTERPRISE", "PAID", None, None]
    assert column(spark, [" 12 ", "-1", "12.5", "x", "", None], names.employee_count) == [12, None, None, None, None, None]
    assert column(spark, ["Featured  Tool", "Verified", "x Promoted"], names.without_badge) == ["Tool", "", "x Promoted"]
    assert column(spark, ["email us", "the sky"], lambda x: names.has_keyword(x, ["AI"])) == [True, False]
    df = spark.createDataFrame([(180000, 240000), (0, 5000), (None, None)], "a int, b int")
    assert [r[0] for r in df.select(names.salary(F.col("a"), F.col("b"), F.lit("open"))).collect()] == ["$180,000 - $240,000", "$5,000", "open"]


def test_tokens_and_redaction(spark):
    assert column(spark, ["", None, "a", "word " * 10, "x" * 38, "🙂" * 10], text.token_estimate) == [0, 0, 2, 14, 11, 6]
    keys = ["a AIza" + "x" * 35, "gsk_" + "y" * 32, "sk-" + "z" * 31, "Bearer abc.d", "plain"]
    assert column(spark, keys, text.redacted) == ["a [REDACTED]", "[REDACTED]", "sk-" + "z" * 31, "[REDACTED]", "plain"]
    assert column(spark, ["x" * 250], text.redacted) == ["x" * 200 + "... [TRUNCATED 250 chars]"]
    assert column(spark, [{"api_key": "v", "n": "v"}], text.redacted_map, "map<string,string>") == [{"api_key": "[REDACTED]", "n": "v"}]


def test_json_healing(spark):
    pairs = {
        '```json\n{"a": 1}\n```': '{"a":1}', 'Sure: {"a": [1, 2,],} bye': '{"a":[1,2]}', '{"a": {"b": 1}': None, '{"a": 1': '{"a":1}', "{'a': 1}": '{"a":1}', "[1, 2": "[1,2]", "gib { berish": None, "": None, None: None, '{"a":1}': '{"a":1}',
    }
    assert column(spark, list(pairs), lambda x: F.to_json(text.parsed_json(x))) == list(pairs.values())


def test_markup(spark):
    page = """<html><head><title>A &amp; B</title><meta name="description" content="first"><meta name="description" content="What &amp;lt; is"></head><body><!-- c --><nav>menu</nav><div class="cookie-bar">c</div>
    <h1>Head</h1><p>One  two .</p><table><tr><th>a</th><td> b <i>c</i></td></tr></table><ul><li>x</li><li>y</li></ul><p hidden>gone</p><h5>Low</h5>&#65;&#x42;<script>var a;</script></body></html>"""
    (got,) = column(spark, [page], text.normalized_html)
    assert got.startswith("Document Title: A & B\nDescription: What < is\n\n")
    body = got.split("\n\n", 1)[1]
    assert "# Head" in body and "One two." in body and "| a | b c |" in body and "- x\n- y" in body and "#### Low" in body and "AB" in body
    assert not any(x in body for x in ("menu", "gone", "var a", "\n\n\n")) and " c" not in body.replace("b c", "")
    assert column(spark, ["", None], text.normalized_html) == ["", ""]
    assert column(spark, ["&amp;lt;b&amp;gt; &#39;x&apos;"], text.unescaped) == ["<b> 'x'"]


def test_dates(spark):
    at = lambda *a: dt.datetime(*a)
    pairs = {
        "Thu, 10 Sep 2026 14:00:00 +0000": at(2026, 9, 10, 14), "10 Sep 2026 14:00:00 -0700": at(2026, 9, 10, 21), "Thu, 10 Sep 2026 14:00 EST": at(2026, 9, 10, 19), "2026-09-10T14:00:00Z": at(2026, 9, 10, 14), "2026-09-10T14:00:00.25+02:00": at(2026, 9, 10, 12, 0, 0, 250000),
        "2026-09-10": at(2026, 9, 10), "20260910": at(2026, 9, 10), "2026-W37-4": at(2026, 9, 10), "September 10, 2026": at(2026, 9, 10), "Sep 10, 2026 14:00": at(2026, 9, 10, 14), "10 September 2026": at(2026, 9, 10), "2026-09-10 14:00:00": at(2026, 9, 10, 14), "1789045200": None, "2026-13-40": None, "": None, None: None, "soon": None,
    }
    assert column(spark, list(pairs), lambda x: dates.parse_date(x).cast("timestamp_ntz")) == list(pairs.values())
    assert column(spark, ["09/10/2026", "13/05/2026", "9-10-2026 07:08", "2026/09/10"], lambda x: dates.parse_numeric(x).cast("timestamp_ntz")) == [at(2026, 9, 10), at(2026, 5, 13), at(2026, 9, 10, 7, 8), None]
    assert column(spark, ["09/10/2026"], lambda x: dates.parse_numeric(x, "en_GB").cast("timestamp_ntz")) == [at(2026, 10, 9)]
    ref = F.to_timestamp(F.lit("2026-09-10 18:00:00"))
    said = {"2 hours ago": at(2026, 9, 10, 16), "yesterday": at(2026, 9, 9, 18), "Posted 3 days ago": at(2026, 9, 7, 18), "just now": at(2026, 9, 10, 18), "Today": at(2026, 9, 10, 18), "not yesterday": None, "": None}
    assert column(spark, list(said), lambda x: dates.parse_relative(x, ref, "America/New_York").cast("timestamp_ntz")) == list(said.values())
    november = F.to_timestamp(F.lit("2026-11-01 08:00:00"))
    assert column(spark, ["4 hours ago"], lambda x: dates.parse_relative(x, november, "America/New_York").cast("timestamp_ntz")) == [at(2026, 11, 1, 3)]
    assert column(spark, ["https://a.b/2026/09/10/x", "https://a.b/2026/19/10/x", None], lambda x: dates.url_date(x).cast("timestamp_ntz")) == [at(2026, 9, 10), None, None]


@pytest.mark.parametrize(
    ("html", "feed", "method", "confidence"),
    [
        ('<script type="application/ld+json">{"@graph":[{"datePublished":"2026-09-10T10:00:00Z"}]}</script>', "2020-01-01", "structured_json_ld_published", 0.98), ('<script type="application/ld+json">{broken</script>', "Thu, 10 Sep 2026 14:00:00 +0000", "structured_feed_pubdate", 0.95),
        ('<meta property="article:published_time" content="2026-09-10">', None, "meta_article:published_time", 0.88), ('<time datetime="2026-09-10T10:00Z">x</time>', "nonsense", "visible_time_datetime", 0.85), ("<time>2 hours ago</time>", None, "visible_time_relative", 0.80),
        ("<time>10 Sep 2026</time>", None, "visible_time_text", 0.82), ("<p>none</p>", None, "url_date_regex", 0.70),
    ],
)
def test_date_places(spark, html, feed, method, confidence):
    df = spark.createDataFrame([(html, feed, "https://a.b/2026/09/10/x")], "html string, feed string, url string")
    got = df.select(dates.extract_date(F.col("html"), F.col("feed"), F.col("url"), F.to_timestamp(F.lit("2026-09-10 18:00:00")), url_pattern=dates.URL_DATE).alias("d")).collect()[0].d
    assert (got.method, got.confidence, got.is_future) == (method, confidence, False)


def test_errors_and_delays(spark):
    cases = [(403, None, "cloudflare"), (200, None, "Just a moment..."), (429, None, None), (413, None, None), (None, "Read timeout", None), (503, None, None), (None, "bad JSON", None), (404, None, None), (None, None, None)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, s int, m string, b string").orderBy("i")
    got = [tuple(r.e) for r in df.select(politeness.classify_error(F.col("s"), F.col("m"), F.col("b")).alias("e")).collect()]
    assert got == [
        ("BLOCKED_ACCESS", 403, False, None), ("BLOCKED_ACCESS", 200, False, None), ("HTTP_429_RATE_LIMITED", 429, True, 5.0), ("HTTP_413_PAYLOAD_TOO_LARGE", 413, True, None), ("NETWORK_TIMEOUT", 408, True, 2.0),
        ("HTTP_5XX_SERVER_ERROR", 503, True, 3.0), ("PARSING_FAILURE", None, False, None), ("UNKNOWN_ERROR", 404, False, None), ("UNKNOWN_ERROR", None, False, None),
    ]
    delay = lambda x: politeness.call_backoff(x, F.lit(None).cast("int"), F.lit(0.5))
    assert column(spark, [0, 1, 2, 10], delay, "int") == [250, 500, 1000, 5000]
    assert column(spark, [4000, 60000], lambda x: politeness.call_backoff(F.lit(1), x, F.lit(0.5)), "int") == [4200, 10500]
    now = F.to_timestamp(F.lit("2026-10-21 07:28:00"))
    assert column(spark, ["120", "1.5", "Wed, 21 Oct 2026 07:28:30 GMT", "Wed, 21 Oct 2020 07:28:30 GMT", "x", None], lambda x: politeness.retry_after_ms(x, now)) == [120000, 1500, 30000, 0, None, None]
