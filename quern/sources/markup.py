"""HTML pages as trees, a subset of CSS, and what is read from pages: clean text, articles, job offers, listings.

Trees exist within a row's turn in an Arrow batch only. The subset of CSS: names, .class, #id, [attribute], [attribute='v'] and its
^=, $=, *= forms, joined into compounds, descendants by a space, alternatives by a comma.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.entities import html5
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Elements without readable text, and words in a class or id (also within other words) that mark chrome.
NOISY_ELEMENTS = ("script", "style", "noscript", "svg", "iframe", "button", "form", "nav", "header", "footer", "aside", "dialog", "canvas", "audio", "video", "object", "embed")
NOISY_NAMES = re.compile("cookie|gdpr|banner|popup|modal|advert|sponsor|promo|social|share|widget|newsletter|subscribe|signup|related|comments", re.IGNORECASE)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY = {
    "p": frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"]),
}
UNKNOWN_COMPANY = "Unknown Company"


class Node:
    __slots__ = ("attrs", "children", "name", "parent")

    def __init__(self, name: str, attrs: dict[str, str], parent: Node | None) -> None:
        self.name, self.attrs, self.parent, self.children = name, attrs, parent, []

    def walk(self) -> Iterator[Node]:
        """Elements beneath, in order of the page."""
        waiting = [c for c in reversed(self.children) if isinstance(c, Node)]
        while waiting:
            node = waiting.pop()
            yield node
            waiting += [c for c in reversed(node.children) if isinstance(c, Node)]

    def texts(self) -> Iterator[str]:
        waiting: list = list(reversed(self.children))
        while waiting:
            x = waiting.pop()
            if isinstance(x, Node):
                waiting += reversed(x.children)
            else:
                yield x

    def text(self, joint: str = "") -> str:
        return joint.join(t for t in map(str.strip, self.texts()) if t)

    def find(self, *names: str) -> Node | None:
        return next((n for n in self.walk() if n.name in names), None)

    def select(self, selector: str) -> Iterator[Node]:
        tests = compiled(selector)
        return (n for n in self.walk() if any(t(n) for t in tests))

    def first(self, selector: str | None) -> Node | None:
        return next(self.select(selector), None) if selector else None


#: What HTMLParser may decode as a named reference, by its beginning if need be.
_REFERENCE = re.compile(r"&([^\t\n\f <&#;]{1,32};?)")


class _Builder(HTMLParser):
    """mark: a character of no page, which stands for ampersands that are no references."""

    def __init__(self, mark: str) -> None:
        super().__init__(convert_charrefs=True)
        self.mark, self.root = mark, Node("", {}, None)
        self.at = self.root

    def plain(self, text: str | None) -> str:
        return (text or "").replace(self.mark, "&")

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        tag = self.plain(tag)
        while self.at.name in CLOSED_BY and tag in CLOSED_BY[self.at.name]:
            self.at = self.at.parent
        node = Node(tag, {self.plain(k): self.plain(v) for k, v in reversed(attrs)}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.at = self.at.parent

    def handle_endtag(self, tag: str) -> None:
        node, tag = self.at, self.plain(tag)
        while node is not None and node.name != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(self.plain(data))


def tree(html: str | None, *, lenient: bool = False) -> Node:
    """The page's elements. Named references need their semicolon, as for libxml2 up to 2.13; lenient: as HTML5 has it, some don't."""
    html = html or ""
    mark = next(c for c in map(chr, range(0xF0000, 0x110000)) if c not in html)
    builder = _Builder(mark)
    builder.feed(html if lenient else _REFERENCE.sub(lambda m: m[0] if m[0][-1] == ";" and m[1] in html5 else mark + m[1], html))
    builder.close()
    return builder.root


_SIMPLE = re.compile(r"""\*|[A-Za-z][\w-]*|\.[\w-]+|\#[\w-]+|\[\s*([\w:-]+)\s*(?:([~^$*|]?=)\s*["']?([^"'\]]*)["']?\s*)?\]""")
_CACHE: dict[str, list[Callable[[Node], bool]]] = {}


def _simple(m: re.Match) -> Callable[[Node], bool]:
    s = m[0]
    if s == "*":
        return lambda n: True
    if s[0] == ".":
        return lambda n: s[1:] in n.attrs.get("class", "").split()
    if s[0] == "#":
        return lambda n: n.attrs.get("id") == s[1:]
    if s[0] == "[":
        key, how, value = m[1].lower(), m[2], m[3]
        if how is None:
            return lambda n: key in n.attrs
        tests = {"=": lambda a: a == value, "^=": lambda a: a.startswith(value), "$=": lambda a: a.endswith(value), "*=": lambda a: value in a, "~=": lambda a: value in a.split(), "|=": lambda a: a == value or a.startswith(f"{value}-")}
        return lambda n: key in n.attrs and tests[how](n.attrs[key])
    return lambda n: n.name == s.lower()


def compiled(selector: str) -> list[Callable[[Node], bool]]:
    if selector not in _CACHE:
        _CACHE[selector] = [_descendant([[_simple(m) for m in _SIMPLE.finditer(part)] for part in re.split(r"\s+(?![^\[]*\])", one.strip())]) for one in re.split(r",(?![^\[]*\])", selector) if one.strip()]
    return _CACHE[selector]


def _descendant(parts: list[list[Callable[[Node], bool]]]) -> Callable[[Node], bool]:
    *above, last = parts

    def test(node: Node) -> bool:
        if not all(t(node) for t in last):
            return False
        k, up = len(above) - 1, node.parent
        while k >= 0 and up is not None:
            if all(t(up) for t in above[k]):
                k -= 1
            up = up.parent
        return k < 0

    return test


def clean(root: Node) -> Node:
    """The tree without noisy elements and chrome, in place. The body, main and html stay whatever they are called."""
    waiting = [root]
    while waiting:
        node = waiting.pop()
        node.children = [c for c in node.children if not isinstance(c, Node) or not _noisy(c)]
        waiting += [c for c in node.children if isinstance(c, Node)]
    return root


def _noisy(node: Node) -> bool:
    named = node.name not in ("body", "main", "html") and bool(NOISY_NAMES.search(node.attrs.get("id", "")) or NOISY_NAMES.search(" ".join(node.attrs.get("class", "").split())))
    return node.name in NOISY_ELEMENTS or named


def readable(root: Node) -> str:
    """Text with marked headings and list items, and blank lines around paragraphs."""
    lines: list[str] = []
    waiting: list = [root]
    while waiting:
        x = waiting.pop()
        if isinstance(x, str):
            lines += [x.strip()] if x.strip() else []
        elif isinstance(x, tuple):
            lines.append(x[0])
        elif re.fullmatch("h[1-6]|p|li", x.name):
            if said := x.text(" "):
                lines.append(f"- {said}" if x.name == "li" else f"\n{said}\n" if x.name == "p" else f"\n{'#' * int(x.name[1])} {said}\n")
        elif x.name == "br":
            lines.append("\n")
        else:
            waiting += [("\n",)] if x.name in ("div", "section", "article") else []
            waiting += reversed(x.children)
    text = re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()
    return text or re.sub(r"\n{3,}", "\n\n", root.text("\n")).strip()


def meta(root: Node, *names: tuple[str, str]) -> str | None:
    """The content of the first meta tag of the first name that has one."""
    for attribute, name in names:
        node = next((n for n in root.walk() if n.name == "meta" and n.attrs.get(attribute) == name), None)
        if node is not None:
            return node.attrs.get("content", "").strip() or None
    return None


def _chosen(root: Node, selector: str | None) -> str:
    node = root.first(selector)
    return node.text() if node is not None else ""


def _body(root: Node, selector: str | None, order: tuple[str, ...]) -> str:
    cleaned = clean(root)
    return readable(cleaned.first(selector) or next((n for name in order if (n := cleaned.find(name)) is not None), cleaned))


def article(html: str | None, selectors: dict[str, str] | None = None) -> dict[str, str | None]:
    selectors, root = selectors or {}, tree(html)
    title = root.find("title")
    found = {
        "title": _chosen(root, selectors.get("title")) or meta(root, ("property", "og:title"), ("name", "twitter:title")) or (title.text() if title is not None else ""),
        "author": _chosen(root, selectors.get("author")) or meta(root, ("name", "author"), ("property", "article:author"), ("name", "byl")),
        "summary": meta(root, ("name", "description"), ("property", "og:description")),
    }
    return found | {"full_text": _body(root, selectors.get("body"), ("article", "main", "body"))}


def job(html: str | None, selectors: dict[str, str] | None = None) -> dict[str, str | None]:
    selectors, root = selectors or {}, tree(html)
    title = root.find("title")
    found = {
        "title": _chosen(root, selectors.get("title")) or meta(root, ("property", "og:title")) or (title.text() if title is not None else ""),
        "company": _chosen(root, selectors.get("company")) or meta(root, ("property", "og:site_name")) or UNKNOWN_COMPANY,
        "location": _chosen(root, selectors.get("location")) or None,
        "salary": _chosen(root, selectors.get("salary")) or None,
    }
    return found | {"description_full_text": _body(root, selectors.get("body"), ("main", "article", "body"))}


ARTICLE, JOB = ("title", "author", "summary", "full_text"), ("title", "company", "location", "salary", "description_full_text")


def _column(html: Column, names: tuple[str, ...], one: Callable[[str | None], dict]) -> Column:
    def run(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(h) for h in pages], columns=list(names))

    return F.pandas_udf(run, ", ".join(f"{n} string" for n in names))(html)


def article_column(html: Column, selectors: dict[str, str] | None = None) -> Column:
    """title, author, summary and full_text of a page as a struct; empty texts for null."""
    return _column(html, ARTICLE, lambda h: article(h, selectors))


def job_column(html: Column, selectors: dict[str, str] | None = None) -> Column:
    """title, company, location, salary and description_full_text of a page as a struct."""
    return _column(html, JOB, lambda h: job(h, selectors))


def extract_articles(pages: DataFrame, *, key: str = "page_id", column: str = "html", selectors: dict[str, str] | None = None) -> DataFrame:
    """key, title, author, summary and full_text of each page, in one reading of it."""
    return pages.select(key, article_column(F.col(column), selectors).alias("found")).select(key, "found.*")


def extract_jobs(pages: DataFrame, *, key: str = "page_id", column: str = "html", selectors: dict[str, str] | None = None) -> DataFrame:
    """key, title, company, location, salary and description_full_text of each page."""
    return pages.select(key, job_column(F.col(column), selectors).alias("found")).select(key, "found.*")


def listing(html: str | None, base: str, selectors: dict[str, str]) -> list[tuple[str, str | None, str | None]]:
    """Address, title and company of a listing page's items; items without a link of their own are passed over."""
    out = []
    for item in tree(html).select(selectors.get("item_container", "article, a[href]")):
        if chosen := selectors.get("link"):
            node = item.first(chosen)
        else:
            node = item if item.name == "a" and item.attrs.get("href") else item.find("a")
        link = node.attrs.get("href", "") if node is not None else ""
        if link and not link.startswith(("#", "javascript:")):
            title = _chosen(item, selectors.get("listing_title", "h2, h3, .title")) or item.text(" ")[:120]
            company = item.first(selectors.get("listing_company", ".company"))
            out.append((urljoin(base, link), title or None, company.text() if company is not None else None))
    return out


def product_cards(html: str | None, site: str) -> list[tuple[str, str, str | None, str]]:
    """Name with badge, address, pricing badge and text of each card of a software directory at site.

    A card is the division around a heading with a link. A link out of the directory takes the place of its own address.
    """
    out = []
    host = re.escape(site.split("//")[-1])
    for heading in (n for n in tree(html, lenient=True).walk() if n.name in ("h3", "h4")):
        link, card = heading.find("a"), heading.parent
        while card is not None and card.name != "div":
            card = card.parent
        if link is None or card is None or not link.attrs.get("href") or "/compare/" in link.attrs["href"]:
            continue
        outside = next((n for n in card.walk() if n.name == "a" and re.match(rf"https?://(?!{host}|cdn)", n.attrs.get("href", ""))), None)
        badge = next((n for n in card.walk() if n.name == "span" and any(re.search(r"is-price-\w+", c) for c in n.attrs.get("class", "").split())), None)
        address = outside.attrs["href"] if outside is not None else urljoin(site, link.attrs["href"])
        out.append((link.text(), address, badge.text() if badge is not None else None, card.text(" ")))
    return out
