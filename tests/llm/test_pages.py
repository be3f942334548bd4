import itertools
import random
from pathlib import Path

import pytest

from quern.llm.pages import Network, blocks, extract_pages, main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
<body class="page sidebar-right"><header><h1>Site name</h1></header><nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav>
<!-- <p>no</p> --><div class="cookie-notice"><p>We use cookies on this site to make it better for all of our readers.</p></div>
<div class="ad">Buy the very best things here today, cheaper than ever before.</div>
<article><h1>The title &amp; more</h1><p><b>Lead&nbsp;text<br>goes on <p>A first   paragraph of the article, with some <a href="#">link</a> in it.
<p>Short.</p><ul><li>A list item that belongs to the article<li>and another one of the same kind</ul><pre>some code</pre>
<div class="share"><a href="x">Tweet</a> <a href="y">Post</a></div></article>
<section id="comments"><article class="comment"><p>What a wonderful article, I have read it twice and will read it again.</p></article></section>
<aside><p>Other stories that you may like to read at this very place.</p></aside>
<form><label>Mail</label><input name=a><button>Send it now</button></form>
<footer>&copy; 2024 Somebody and others who wrote a lot of words here</footer></body></html>"""
TEXT = ["The title & more", "Lead text goes on", "A first paragraph of the article, with some link in it.", "Short.", "A list item that belongs to the article", "and another one of the same kind", "some code"]


def test_article_only():
    assert main_text(PAGE).split("\n\n") == TEXT


def test_without_an_article_element():
    page = PAGE.replace("<article>", '<div class="entry-content">').replace("</article>\n<section", "</div>\n<section")
    assert main_text(page).split("\n\n") == TEXT


@pytest.mark.parametrize("page", [None, "", " ", "<", "<p", "<div><span>", "<script>x", "<!-- x", "</p></div>", "<title>t</title>", "<p>" * 3000])
def test_no_text(page):
    assert main_text(page) == ""


def test_odd_markup():
    assert main_text("<p>a plain paragraph with several words &am") == "a plain paragraph with several words &am"
    assert main_text("<p title='a>b'>some words stand here <b a=\"") == "some words stand here"
    assert main_text("just some words without any markup around") == "just some words without any markup around"
    assert main_text("<div>" * 2000 + "deep words are still found in here" + "</div>" * 2000) == "deep words are still found in here"
    assert main_text("1 < 2 and 3 > 2 is what this text says") == "1 < 2 and 3 > 2 is what this text says"


def test_neighbours_pull_in_weak_blocks():
    long = "<p>" + "many words of an article " * 5 + "</p>"
    assert "weak" in main_text(f"<div>{long}<div>weak</div>{long}</div>")
    assert "weak" not in main_text(f"<div>{long}{long}</div><div><ul><li><a>weak</a></li><li><a>weak</a></li></ul></div>")


LEAD = "The old mill by the river was built by the miller's family more than two hundred years ago."
MORE = "Since then it has ground the corn of all the farms around, and its wheel still turns in the spring."
LAST = "Visitors may see it on Sundays, when the miller's daughter shows how the stones are set and dressed."
BODY = f"<p>{LEAD}</p><p>{MORE}</p><p>{LAST}</p>"
NAV = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/mills'>All mills</a></li></ul></nav>"
SAID = "".join(f"<div><b>Reader {i}</b><p>I was there last year with my children and we liked it a lot, as did all the others.</p></div>" for i in range(9))
SIDE = "<div class='sidebar'><h3>Popular</h3><ul><li><a href='/a'>Ten bridges to see</a></li><li><a href='/b'>The best of the coast</a></li></ul></div>"
FOOT = "<footer><p>Copyright 2024 by the people of the mill, who wrote all of this down for you.</p></footer>"


@pytest.mark.parametrize(
    "page",
    [
        f"{NAV}<div class='page has-sidebar'>{BODY}</div>{FOOT}",
        f"<form id='aspnetForm'><article>{BODY}</article></form>{FOOT}",
        f"<form id='aspnetForm'>{NAV}<div>{BODY}</div></form>",
        f"<div class='layout-with-nav'><div class='content'>{BODY}</div>{SIDE}</div>{FOOT}",
        f"<div id='wrapper' class='no-comments'><div class='post-body'>{BODY}</div></div>",
        f"<main class='modal-page'>{NAV}{BODY}</main>{FOOT}",
        f"<div class='sidebar-page'><main>{BODY}</main>{SIDE}</div>",
        f"<table><tr><td class='menu'><a href='/'>Home</a> <a href='/x'>Mills</a></td><td><font>{BODY}</font></td></tr></table>",
        f"<article>{BODY}</article><section id='comments'>{SAID}</section>",
        f"<article>{BODY}</article><section id='comments'><article><p>{MORE[::-1]}</p></article></section>",
        f"<div class='entry'>{BODY}</div><div><h3>9 Comments</h3>{SAID}</div>{FOOT}",
        f"<article>{BODY}<section><h4>Kommentare (9)</h4>{SAID}</section></article>",
        f"<div>{BODY}</div>{SIDE}{FOOT}",
        f"<div role='main'>{BODY}</div><div role='complementary'><p>{MORE[::-1]}</p></div>",
        f"<div class='related'><p>{MORE[::-1]}</p></div><div class='story'>{BODY}</div><div style='display: none'><p>{LEAD[::-1]}</p></div>",
    ],
)
def test_makes_of_pages(page):
    assert main_text(f"<html><body class='sidebar page'>{page}</body></html>").split("\n\n") == [LEAD, MORE, LAST]


def test_unclosed_elements_take_linear_time():
    import time

    def seconds(n):
        began = time.perf_counter()
        main_text("<button>a <div><p>b </q></i></section>" * n)
        return time.perf_counter() - began

    seconds(50)
    assert seconds(4000) < 40 * max(seconds(400), 0.01)


def test_flow_is_a_minimum_cut():
    rng = random.Random(6)
    for _ in range(60):
        n = rng.randrange(2, 8)
        graph, edges = Network(n), []
        for a, b in itertools.combinations(range(n), 2):
            if rng.random() < 0.6:
                edges.append((a, b, rng.randrange(9), rng.randrange(9)))
                graph.edge(*edges[-1])
        best = min(
            sum((there if a in s and b not in s else 0) + (back if b in s and a not in s else 0) for a, b, there, back in edges)
            for k in range(n - 1) for rest in itertools.combinations(range(1, n - 1), k) for s in [{0, *rest}]
        )
        assert graph.flow(0, n - 1) == best


def test_table(spark):
    data = [(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (2, "", "")]
    found = extract_pages(spark.createDataFrame(data, "page_id bigint, url string, html string").selectExpr("*", "'x' AS text")).collect()
    assert sorted(map(tuple, found), key=repr) == sorted([(1, "u", "\n\n".join(TEXT), len("\n\n".join(TEXT)))] * 2 + [(None, None, "", 0), (2, "", "", 0)], key=repr)
    assert extract_pages(spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []


@pytest.mark.skipif(not Path("/root/testdata/sf0.001/pages.parquet").exists(), reason="no test data")
def test_given_pages_give_their_articles(spark):
    import re

    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        article = re.search(r"<article>(.*?)(?:</article>|$)", r.html, re.DOTALL)[1]
        expected = [" ".join(__import__("html").unescape(re.sub(r"<[^>]*>?", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert main_text(r.html).split("\n\n") == [x for x in expected if x]
    assert blocks("") == []
