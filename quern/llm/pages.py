"""HTML extraction by minimum-cut labelling.

A page becomes blocks (the texts between block-level tags) under a tree of containers. A classifier gives each block
the cost of calling it boilerplate and the cost of calling it content, from its tag, its words, its link share and
what its containers are called. These costs are the capacities from the source and to the sink. Smoothness edges join
neighbours in page order, and joins by DOM proximity run through the containers: block to container, container to
its parent. A maximum flow saturates the cheapest cut; what the source still reaches is content.

Elements that are never content (navigation, footers, headers outside of an article, forms, asides and so on) have
an unlimited capacity to the sink, so smoothness can't pull them in. Scripts, styles and comments never become text.

What an element's tag, role or class says against it holds only where it can be meant for all of the element: it fades
as the share of the page's text beneath grows from PART to WHOLE, and it doesn't count for an element that holds the
main element, or an article and a PART of the text; nor do names that wrap whole pages (has-sidebar, with-nav). So a page inside a form
or a wrapper called after its sidebar keeps its text. Reader comments may be longer than the article, so what says comments fades
only above the main element or the first heading. A list of comments without a telling name is known by its heading, and goes from there
to the end of the element that holds the heading.

Character references are decoded, white space within a block is one space, blocks are trimmed, empty ones left out,
and joined in page order by two line feeds. A null, empty or text-less page gives the empty text. Unclosed and
truncated markup is read as browsers do: what is open ends with the page, a cut-off tag is dropped. Repeated rows
each get the same result. The empty table gives an empty result. Only page_id, url and html are read.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import rows, slices, text_of

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*'|["'])*+)>|<[!?/][^>]*(?:>|\Z)|<[A-Za-z][^>]*\Z""", re.DOTALL)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
#: Elements whose content isn't text of the page.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "svg", "iframe", "canvas", "object", "select", "math"}
BUTTON_END = re.compile(r"</button\s*>", re.IGNORECASE)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "ruby",
    "rp", "rt", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "img", "wbr", "br", "input", "button", "meter", "progress", "output",
}
#: An element that is open and ends where one of these starts.
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
NOT_IN_P = INLINE | {"li", "dt", "dd"} | VOID
#: Elements that are boilerplate whatever they hold.
HARD = {"nav", "footer", "aside", "form", "button", "menu", "dialog", "head"}
HARD_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}
GOOD_TAGS = {"article": 3.0, "main": 2.5}
#: Words in class or id, and what they say of the text beneath.
BAD_WORDS = frozenset(
    "ad ads advert advertisement advertising adsense banner promo promotion sponsor sponsored cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social related recommended recommendations sidebar widget menu nav navbar navigation breadcrumb breadcrumbs footer header masthead "
    "comment comments reply replies respond disqus form search pagination pager tags meta toolbar copyright legal disclaimer skip toc".split()
)
GOOD_WORDS = frozenset("article content post entry story body text main page".split())
COMMENT_WORDS = frozenset("comment comments reply replies respond disqus".split())
#: Words before one of BAD_WORDS in a class that make it one of a wrapper: has-sidebar, with-nav, no-comments.
WRAPPING = frozenset("has have with without no show hide hides is page layout".split())
#: The heading of a list of comments: a word for them, with a number or a few small words around.
COMMENTS_HEADING = re.compile(r"(?:\d+|reader|readers|user|leave|post|write|add|a|your|all|the|view|show)?\W*(?:\d+|reader|readers|a|your)?\W*(?:comments?|replies|reply|responses|kommentare?|commentaires?|comentarios?|commenti|reacties)\W*(?:\(?\d+\)?)?\W*", re.IGNORECASE)
#: Share of the page's text under an element from which on nothing is left of what speaks against it, and the share that an
#: element around an article needs for that.
WHOLE, PART = 0.5, 0.25
TAG_SCORE = {"p": 1.0, "pre": 1.0, "blockquote": 0.8, "h1": 0.8, "h2": 0.5, "h3": 0.5, "h4": 0.3, "li": -0.5, "td": -0.3, "th": -0.3, "dt": -0.2, "dd": 0.0, "figcaption": 0.2}
BAD, GOOD, LINKED, SHORT = -5.0, 1.0, -5.0, -0.8
#: Smoothness of neighbours, of a block with its container and of a container with its parent; capacities are integers.
NEAR, INSIDE, NESTED, SCALE, UNLIMITED = 0.6, 0.4, 0.4, 1000, 1 << 50
SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


class Element:
    """An element, what its own tag says (the rest comes from its parents, once all of the page is known)."""

    __slots__ = ("bad", "chars", "comments", "evidence", "good", "hard", "hidden", "holds", "index", "inside", "name", "parent", "unwanted")

    def __init__(self, name: str, parent: Element | None, attributes: str = "", index: int = 0) -> None:
        self.name, self.parent, self.index, self.chars = name, parent, index, 0
        self.inside = bool(parent and (parent.inside or parent.name in GOOD_TAGS))
        self.good, self.evidence, self.hard = 0.0, 0.0, False
        self.unwanted = name in HARD or (name == "header" and not self.inside)
        self.hidden = self.bad = self.comments = False
        self.holds: set[str] = set()  # which of article, main and h1 are beneath
        if attributes:
            classes: list[list[str]] = []
            for m in ATTRIBUTE.finditer(attributes):
                key, value = m[1].lower(), (m[2] or "").strip("\"'")
                if key == "role":
                    self.unwanted |= value.lower() in HARD_ROLES
                elif key == "style":
                    self.hidden |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE))
                elif key in ("hidden", "aria-hidden"):
                    self.hidden |= value.lower() not in ("false", "until-found")
                else:
                    classes += [[w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])", c)] for c in value.split()]
            if name not in ("html", "body"):
                named = [c for c in classes if c and not (len(c) > 1 and c[0] in WRAPPING)]
                words = {w for c in named for w in c}
                self.bad = bool(words & BAD_WORDS)
                self.comments = bool(words & COMMENT_WORDS)
                if not self.bad and {w for c in classes for w in c} & GOOD_WORDS:
                    self.good = GOOD
        if name in GOOD_TAGS or name == "h1":
            e = parent
            while e is not None and name not in e.holds:
                e.holds |= {name}
                e = e.parent

    def settle(self, total: int) -> None:
        """Add what the parents say to what this element says; they are settled already."""
        up, share = self.parent, self.chars / max(total, 1)
        left = min(1.0, max(0.0, (WHOLE - share) / (WHOLE - PART)))
        if self.comments:
            left = 0.0 if "main" in self.holds or ("h1" in self.holds and share >= PART) else 1.0
        elif "main" in self.holds or ("article" in self.holds and share >= PART):
            left = 0.0
        self.hard = self.hidden or bool(up and up.hard) or ((self.unwanted or self.comments) and left > 0)
        self.evidence = up.evidence if up else 0.0
        if self.name in GOOD_TAGS and not self.inside:
            self.evidence = max(self.evidence, 0.0) + GOOD_TAGS[self.name]
        self.evidence += BAD * left if self.bad else self.good


class Block:
    __slots__ = ("element", "linked", "pieces")

    def __init__(self, element: Element) -> None:
        self.element, self.pieces, self.linked = element, [], 0

    @property
    def text(self) -> str:
        return " ".join("".join(self.pieces).split())


def blocks(page: str) -> list[tuple[str, int, Element]]:
    """Texts of the blocks in page order, the characters of each within links, and the element that holds it."""
    root = Element("", None)
    stack, out, current, at, links, every = [root], [], Block(root), 0, 0, [root]
    names, unclosed = Counter(), False

    def end() -> None:
        nonlocal current
        if current.pieces and (text := current.text):
            out.append((text, current.linked, current.element))
            current.element.chars += len(text)
        current = Block(stack[-1])

    def pop() -> None:
        names[stack.pop().name] -= 1

    def said(raw: str) -> None:
        if raw:
            text = html.unescape(raw)
            current.pieces.append(text)
            current.linked += len(text.strip()) if links else 0

    while m := TOKEN.search(page, at):
        said(page[at : m.start()])
        at, name = m.end(), (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            if name == "a":
                links = 0
            if name in INLINE:
                continue
            if names[name]:
                while stack[-1].name != name:
                    pop()
                pop()
                end()
            elif name == "p":
                end()
            continue
        if name in RAW:
            if not m[3].rstrip().endswith("/"):
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
                at = close.end() if close else len(page)
            if name not in INLINE:
                current.pieces.append(" ")
            continue
        if name in INLINE:
            if name == "a":
                links = 1
            elif name == "br":
                current.pieces.append("\n")
            elif name == "button" and not unclosed:
                close = BUTTON_END.search(page, at)
                unclosed, at = close is None, close.end() if close else at
            continue
        if name not in VOID:
            if stack[-1].name == "p" and name not in NOT_IN_P:
                pop()
            if name in IMPLIED and stack[-1].name in IMPLIED[name]:
                pop()
            if stack[-1].name == "p" and name in ("li", "dt", "dd"):
                pop()
            if not m[3].endswith("/"):
                every.append(Element(name, stack[-1], m[3], len(every)))
                stack.append(every[-1])
                names[name] += 1
        links = 0
        end()
    said(page[at:])
    end()
    for e in reversed(every):  # children come after their parents
        if e.parent is not None:
            e.parent.chars += e.chars
    for e in every:
        e.settle(root.chars)
    return out


def under_comments(found: list[tuple[str, int, Element]]) -> set[int]:
    """The blocks from a heading of comments to the end of the element that holds it."""
    out: set[int] = set()
    for i, (text, _, e) in enumerate(found):
        if i not in out and len(text) < 40 and e.parent is not None and e.name not in ("p", "pre", "li", "td", "blockquote") and COMMENTS_HEADING.fullmatch(text):
            holder = e.parent if e.name in HEADINGS else e
            for j in range(i, len(found)):
                x = found[j][2]
                while x is not None and x.index > holder.index:
                    x = x.parent
                if x is not holder:
                    break
                out.add(j)
    return out


def score(text: str, linked: int, element: Element) -> float:
    """How much more it costs to call the block boilerplate than to call it content."""
    words = text.count(" ") + 1
    value = min(2.5, math.log1p(words) - 1.0) + TAG_SCORE.get(element.name, 0.0) + element.evidence + LINKED * min(1.0, linked / len(text))
    if words < 4 and element.name not in ("p", "h1", "h2", "h3", "pre", "blockquote"):
        value += SHORT
    if not element.inside and re.match(r"(?:©|\(c\)|copyright\b|all rights reserved)", text, re.IGNORECASE):
        value += BAD
    return value


class Network:
    """A flow network and its maximum flow by shortest augmenting paths in levels."""

    def __init__(self, n: int) -> None:
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.left: list[int] = []

    def edge(self, a: int, b: int, there: int, back: int = 0) -> None:
        self.out[a].append(len(self.to))
        self.out[b].append(len(self.to) + 1)
        self.to += [b, a]
        self.left += [there, back]

    def levels(self, source: int) -> list[int]:
        level, waiting = [-1] * len(self.out), deque([source])
        level[source] = 0
        while waiting:
            x = waiting.popleft()
            for e in self.out[x]:
                if self.left[e] > 0 and level[self.to[e]] < 0:
                    level[self.to[e]] = level[x] + 1
                    waiting.append(self.to[e])
        return level

    def flow(self, source: int, sink: int) -> int:
        total, to, left = 0, self.to, self.left
        while (level := self.levels(source))[sink] >= 0:
            tried, path, x = [0] * len(self.out), [], source
            while True:
                if x == sink:
                    pushed = min(left[e] for e in path)
                    total += pushed
                    for k, e in enumerate(path):
                        left[e] -= pushed
                        left[e ^ 1] += pushed
                    cut = next(k for k, e in enumerate(path) if not left[e])
                    x = to[path[cut] ^ 1]
                    del path[cut:]
                    continue
                own = self.out[x]
                while tried[x] < len(own) and not (left[own[tried[x]]] > 0 and level[to[own[tried[x]]]] == level[x] + 1):
                    tried[x] += 1
                if tried[x] < len(own):
                    path.append(own[tried[x]])
                    x = to[path[-1]]
                elif path:
                    x = to[path.pop() ^ 1]
                    tried[x] += 1
                else:
                    break
        return total


def network(found: list[tuple[str, int, Element]]) -> Network:
    """Blocks are nodes 0 to n - 1, then source and sink, then the containers that hold something in common."""
    n = len(found)
    containers: dict[int, int] = {}
    joins: list[tuple[int, int, float]] = [(i, i + 1, NEAR) for i in range(n - 1)]

    def node(e: Element) -> int:
        if e.index not in containers:
            containers[e.index] = n + 2 + len(containers)
            if e.parent is not None:
                joins.append((containers[e.index], node(e.parent), NESTED))
        return containers[e.index]

    for i, (_, _, e) in enumerate(found):
        holder = e.parent if e.parent is not None else e
        chain = holder
        missing = []
        while chain is not None and chain.index not in containers:  # parents first: the tree may be deep
            missing.append(chain)
            chain = chain.parent
        for x in reversed(missing):
            node(x)
        joins.append((i, node(holder), INSIDE))
    graph = Network(n + 2 + len(containers))
    comments = under_comments(found)
    for i, (text, linked, e) in enumerate(found):
        value = -UNLIMITED if e.hard or i in comments else round(SCALE * score(text, linked, e))
        if value > 0:
            graph.edge(n, i, value)
        elif value < 0:
            graph.edge(i, n + 1, -value)
    for a, b, weight in joins:
        graph.edge(a, b, round(SCALE * weight), round(SCALE * weight))
    return graph


def main_text(page: str | None) -> str:
    """The page's content, its blocks joined by two line feeds."""
    found = blocks(page or "")
    if not found:
        return ""
    graph, n = network(found), len(found)
    graph.flow(n, n + 1)
    level = graph.levels(n)
    return "\n\n".join(text for i, (text, _, _) in enumerate(found) if level[i] >= 0)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars, a row for each page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(x) for x in batch.column("html").to_pylist()]
            yield rows(SCHEMA, page_id=batch.column("page_id"), url=batch.column("url"), text=texts, n_chars=list(map(len, texts)))

    own = text_of(pages, "page_id", "url", "html").select(F.col("page_id").cast("bigint"), "url", "html")
    return own.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
