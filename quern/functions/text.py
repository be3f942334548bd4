"""Token estimates, redaction, broken JSON and markup by patterns, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.bind import let
from quern.functions.urls import stripped

RESERVED_PROMPT, RESERVED_OUTPUT, LEAST_BUDGET = 800, 2500, 500


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units: characters beyond the BMP count twice."""
    return F.length(text) + F.length(F.regexp_replace(text, r"[^\x{10000}-\x{10FFFF}]", ""))


def token_estimate(text: Column, *, length: Column | None = None) -> Column:
    """The larger of length / 3.7 and words x 1.35, each rounded up, one at least; none for an empty or null text.

    The length is taken in UTF-16 units unless another is given.
    """


    def estimated(text: Column) -> Column:
        n = utf16_length(text) if length is None else length
        words = F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))
        estimate = F.greatest(F.ceil(n / F.lit(3.7)), F.ceil(words * F.lit(1.35)), F.lit(1))
        return F.when(F.coalesce(text, F.lit("")) == "", F.lit(0)).otherwise(estimate).cast("bigint")

    return let(text, estimated)


def safe_budget(total: Column, prompt: int = RESERVED_PROMPT, output: int = RESERVED_OUTPUT) -> Column:
    return F.greatest(F.lit(LEAST_BUDGET), total - F.lit(prompt + output))


def collapsed(text: Column) -> Column:
    return stripped(F.regexp_replace(text, r"\s+", " "))


# What keys and tokens look like.
SECRETS = (r"AIza[0-9A-Za-z_-]{35}", r"gsk_[0-9A-Za-z_-]{32,}", r"sk-[0-9A-Za-z_-]{32,}", r"(?i)Bearer\s+[0-9A-Za-z_.-]+")
SECRET_KEY = r"(?i)(api[-_]?key|authorization|token|secret|password|bearer)"
REDACTED = "[REDACTED]"


def redacted(text: Column, most: int | None = 200) -> Column:
    """Keys and tokens masked, then cut to so many characters with a note of how many there were."""
    for pattern in SECRETS:
        text = F.regexp_replace(text, pattern, REDACTED)
    if most is None:
        return text
    note = F.concat(F.left(text, F.lit(most)), F.lit("... [TRUNCATED "), F.length(text).cast("string"), F.lit(" chars]"))
    return F.when(F.length(text) > most, note).otherwise(text)


def redacted_map(entries: Column, most: int | None = 200) -> Column:
    """A map of strings whose secret-sounding keys are masked whole."""
    return F.transform_values(entries, lambda k, v: F.when(k.rlike(SECRET_KEY), F.lit(REDACTED)).otherwise(redacted(v, most)))


def healed_json(raw: Column) -> Column:
    """JSON out of a model's answer: out of its fence, from the first bracket to the last of its kind (which is added if
    there is none), without trailing commas, with double quotes around keys."""

    def unfenced(text: Column) -> Column:
        return F.coalesce(F.nullif(stripped(F.regexp_extract(text, r"(?i)```(?:json)?\s*([\s\S]*?)\s*```", 1)), F.lit("")), text)

    return let(let(stripped(F.coalesce(raw, F.lit(""))), unfenced), _healed)


def _healed(text: Column) -> Column:
    start = F.regexp_instr(text, F.lit(r"[{\[]"))
    from_start = F.substring(text, start, F.length(text))
    is_object = F.startswith(from_start, F.lit("{"))
    closer = F.when(is_object, F.lit("}")).otherwise(F.lit("]"))
    last = F.length(from_start) - F.position(closer, F.reverse(from_start)) + 1
    closed = F.position(closer, F.reverse(from_start)) > 0
    sliced = F.when(closed, F.left(from_start, last)).otherwise(F.concat(from_start, closer))
    text = F.when(start > 0, sliced).otherwise(text)
    text = F.regexp_replace(text, r",\s*([}\]])", "$1")
    return F.regexp_replace(text, r"([{,]\s*)'([^'\n\r]+)'\s*:", '$1"$2":')


def parsed_json(raw: Column) -> Column:
    """The variant of a model's answer: as it stands, else healed; null (malformed) if neither parses."""
    return F.coalesce(F.try_parse_json(raw), F.try_parse_json(healed_json(raw)))


def low_information(value: Column, kind: str) -> Column:
    """Null, blank or empty; zero and false are information. kind: string, array, map or other."""
    if kind == "string":
        return value.isNull() | (stripped(value) == "")
    return value.isNull() | (F.size(value) == 0) if kind in ("array", "map") else value.isNull()


# The named references that are decoded, in order.
ENTITIES = (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "))


def unescaped(text: Column) -> Column:
    """The named references above, the ampersand first, so that an escaped reference is decoded twice; then numbers."""
    for reference, plain in ENTITIES:
        text = F.replace(text, F.lit(reference), F.lit(plain))

    def numbers(text: Column, pattern: str, base: int) -> Column:
        return let(text, lambda t: numbers_of(t, pattern, base))

    def numbers_of(text: Column, pattern: str, base: int) -> Column:
        # Text and references take turns: split gives one more piece than there are references.
        texts = F.split(text, pattern)
        codes = F.transform(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)), lambda r: F.conv(F.regexp_replace(r, "[&#x;]", ""), base, 10).cast("bigint") % 65536)
        chars = F.transform(codes, lambda c: F.decode(F.unhex(F.lpad(F.hex(c), 4, "0")), "UTF-16BE"))
        return F.when(F.size(codes) > 0, F.array_join(F.zip_with(texts, chars, lambda t, c: F.concat(t, F.coalesce(c, F.lit("")))), "")).otherwise(text)

    return numbers(numbers(text, "&#[0-9]+;", 10), "&#x[0-9a-fA-F]+;", 16)


def html_title(html: Column) -> Column:
    """The title, unescaped; null if there is no title element or it is blank."""
    return F.nullif(unescaped(stripped(F.regexp_extract(html, r"(?i)<title[^>]*>([\s\S]*?)</title>", 1))), F.lit(""))


# Fixed value: a meta tag that gives its name before its content.
META = r"""(?i)<meta\s+[^>]*?(?:name|property)=["']([^"']+)["'][^>]*?content=["']([^"']*)["'][^>]*>"""


def html_metadata(html: Column) -> Column:
    """A map from name or property to content, of meta tags that give the name first; the last of a name holds."""
    keys = F.transform(F.regexp_extract_all(html, F.lit(META), F.lit(1)), stripped)
    values = F.transform(F.regexp_extract_all(html, F.lit(META), F.lit(2)), lambda v: unescaped(stripped(v)))
    zipped = F.zip_with(keys, values, lambda k, v: F.struct(k.alias("k"), v.alias("v")))

    def last_of(pairs: Column) -> Column:
        # Of a key that comes twice, drop the earlier: a map takes no key twice.
        return F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["k"] == p["k"]))

    return F.map_from_entries(let(F.filter(zipped, lambda p: (p["k"] != "") & (p["v"] != "")), last_of))


def _rows(html: Column) -> Column:
    """Each table row as | a | b |, by splitting at the rows and putting the pieces together again."""
    return let(html, _rows_of)


def _rows_of(html: Column) -> Column:
    row = r"(?i)<tr[^>]*>[\s\S]*?</tr>"
    cell = r"(?i)<(?:td|th)[^>]*>([\s\S]*?)</(?:td|th)>"
    inner = F.transform(F.regexp_extract_all(html, F.lit(f"({row})"), F.lit(1)), lambda r: F.transform(F.regexp_extract_all(r, F.lit(cell), F.lit(1)), lambda c: collapsed(F.regexp_replace(c, "<[^>]+>", " "))))
    shown = F.transform(inner, lambda cells: F.when(F.size(cells) > 0, F.concat(F.lit("\n| "), F.array_join(cells, " | "), F.lit(" |"))).otherwise(F.lit("\n")))
    pieces = F.split(html, row)
    return F.when(F.size(shown) > 0, F.array_join(F.zip_with(pieces, shown, lambda t, r: F.concat(t, F.coalesce(r, F.lit("")))), "")).otherwise(html)


# The passes of the normalizer up to the table rows and after them, in order.
BEFORE_ROWS = (
    (r"<!--[\s\S]*?-->", " "),
    (r"(?i)<(script|style|noscript|svg|iframe|canvas|template)[^>]*>[\s\S]*?</\1>", " "),
    (r"(?i)<(nav|footer|aside)[^>]*>[\s\S]*?</\1>", "\n"),
    (r"""(?i)<([a-z0-9]+)[^>]*?(?:class|id)=["'][^"']*(?:cookie|consent|banner|newsletter|advertisement|modal-backdrop|privacy-notice)[^"']*["'][^>]*>[\s\S]*?</\1>""", " "),
    (r"""(?i)<([a-z0-9]+)[^>]*?(?:aria-hidden=["']true["']|style=["'][^"']*display:\s*none[^"']*["']|hidden)[^>]*>[\s\S]*?</\1>""", " "),
    (r"(?i)<h1[^>]*>([\s\S]*?)</h1>", "\n\n# $1\n\n"),
    (r"(?i)<h2[^>]*>([\s\S]*?)</h2>", "\n\n## $1\n\n"),
    (r"(?i)<h3[^>]*>([\s\S]*?)</h3>", "\n\n### $1\n\n"),
    (r"(?i)<h[4-6][^>]*>([\s\S]*?)</h[4-6]>", "\n\n#### $1\n\n"),
)
AFTER_ROWS = (
    (r"(?i)<li[^>]*>([\s\S]*?)</li>", "\n- $1"),
    (r"(?i)<dt[^>]*>([\s\S]*?)</dt>", "\n$1: "),
    (r"(?i)<dd[^>]*>([\s\S]*?)</dd>", "$1\n"),
    (r"(?i)<(?:p|div|section|article|blockquote|header)[^>]*>", "\n\n"),
    (r"(?i)</(?:p|div|section|article|blockquote|header)>", "\n"),
    (r"(?i)<br\s*/?>", "\n"),
    (r"(?i)<hr\s*/?>", "\n---\n"),
    (r"<[^>]+>", " "),
)


def normalized_html(html: Column, *, header: bool = True) -> Column:
    """Markup as text with marked headings, rows and list items. Null and empty give the empty string."""
    text = F.coalesce(html, F.lit(""))
    for pattern, to in BEFORE_ROWS:
        text = F.regexp_replace(text, pattern, to)
    text = _rows(text)
    for pattern, to in AFTER_ROWS:
        text = F.regexp_replace(text, pattern, to)
    text = F.regexp_replace(unescaped(text), r"[ \t]+([.,;:!?])", "$1")
    lines = F.transform(F.split(text, "\n"), lambda line: stripped(F.regexp_replace(line, r"[ \t]+", " ")))
    text = stripped(F.regexp_replace(F.array_join(lines, "\n"), r"\n{3,}", "\n\n"))
    if not header:
        return text
    title, description = html_title(html), F.element_at(html_metadata(html), F.lit("description"))
    parts = F.array_compact(F.array(F.concat(F.lit("Document Title: "), title), F.concat(F.lit("Description: "), description)))
    headed = let(parts, lambda p: F.when(F.size(p) > 0, F.concat(F.array_join(p, "\n"), F.lit("\n\n"))).otherwise(F.lit("")))
    return F.when(F.coalesce(html, F.lit("")) == "", F.lit("")).otherwise(F.concat(headed, text))


def repair_prompt(broken: Column, errors: Column, schema: Column) -> Column:
    """What a model is asked after an invalid answer."""
    return F.concat_ws(
        "\n",
        F.lit("Your last answer was not valid. Answer with one JSON object that follows the schema, and nothing around it."),
        F.lit(""), F.lit("ERRORS:"), errors, F.lit(""), F.lit("SCHEMA:"), schema, F.lit(""), F.lit("ANSWER TO MEND:"), broken,
    )
