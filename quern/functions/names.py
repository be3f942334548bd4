"""Names of organisations, pricing and numbers in free text, as column expressions."""

from __future__ import annotations

import functools
import json
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.bind import let
from quern.functions.urls import stripped

# Spellings that are brought together before anything else, in order.
SPELLINGS = (
    (r"\bopen\s+ai\b", "openai"), (r"\bmistral\s+ai\b", "mistral ai"), (r"\bperplexity\s+ai\b", "perplexity ai"),
    (r"\bscale\s+ai\b", "scale ai"), (r"\bstability\s+ai\b", "stability ai"), (r"\binflection\s+ai\b", "inflection ai"),
    (r"\beleven\s+labs\b", "elevenlabs"), (r"\bcursor\s+ai\b", "cursor"), (r"\bhugging\s+face\b", "hugging face"),
    (r"\bhuggingface\b", "hugging face"), (r"\brunway\s*ml\b", "runway"), (r"\bw\s*&\s*b\b", "weights and biases"),
    (r"\bwandb\b", "weights and biases"),
)
# Legal forms, wherever they stand in a name.
LEGAL_FORMS = (
    r"inc(\.|\b)", r"incorporated\b", r"llc(\.|\b)", r"l\.l\.c\.?", r"ltd(\.|\b)", r"limited\b", r"corp(\.|\b)", r"corporation\b",
    r"gmbh\b", r"co(\.|\b)", r"company\b", r"pbc\b", r"sas\b", r"se\b", r"ag\b", r"s\.a\.?", r"b\.v\.?", r"bv\b", r"k\.k\.?", r"kk\b",
    r"pte(\.|\s)+ltd(\.|\b)", r"pvt(\.|\s)+ltd(\.|\b)", r"opco(\s+llc)?\b",
)
# Words that say nothing about which organisation is meant.
GENERIC_WORDS = (
    "ai", "artificial", "intelligence", "lab", "labs", "systems", "technologies", "technology", "software", "solutions",
    "robotics", "cloud", "data", "deep", "machine", "learning", "ml", "group", "holdings",
)


@functools.cache
def _folds() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """From the Unicode tables: characters of the BMP that fold to one character, what they fold to, and those that fold
    to several. A character folds by compatibility decomposition, loss of combining marks, and composition."""
    one, to, gone, many = [], [], [], []
    for point in range(0x80, 0x10000):
        c = chr(point)
        if 0xD800 <= point < 0xE000:
            continue
        folded = unicodedata.normalize("NFC", "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)))
        if folded == c:
            continue
        if len(folded) == 1 and ord(folded) < 0x10000:
            one.append(c)
            to.append(folded)
        elif not folded:
            gone.append(c)
        else:
            many.append((c, folded))
    return "".join(one + gone), "".join(to), tuple(many)


def folded(text: Column) -> Column:
    """Letters without their marks and compatibility forms, on the JVM: one translate(), and for the few texts with
    characters that fold to several (ligatures, circled words, units) a look-up of each character."""
    source, target, many = _folds()
    several = "[" + "".join(f"\\x{{{ord(c):X}}}" for c, _ in many) + "]"

    def spelled(text: Column) -> Column:
        plain = F.from_json(F.lit(json.dumps(dict(many))), "map<string,string>")  # a constant
        return F.when(text.rlike(several), F.array_join(F.transform(F.split(text, ""), lambda c: F.coalesce(F.element_at(plain, c), c)), "")).otherwise(text)

    return let(F.translate(text, source, target), spelled)


def entity_name(name: Column, *, fold: bool = True, unicode_words: bool = True) -> Column:
    """The form in which names of organisations are compared. Null gives the empty string.

    With unicode_words=False letters beyond ASCII that have no plain form count as punctuation, so that names of other
    scripts become empty.
    """
    flag = "(?U)" if unicode_words else ""
    text = F.coalesce(name, F.lit(""))
    text = F.lower(folded(text) if fold else text)
    for pattern, plain in SPELLINGS:
        text = F.regexp_replace(text, flag + pattern, plain)
    text = F.regexp_replace(text, flag + r"[\s,]+$", "")
    text = F.regexp_replace(text, rf"{flag}\b({'|'.join(LEGAL_FORMS)})", " ")
    text = F.regexp_replace(text, flag + r"[^\w\s]", " ")
    return F.trim(F.regexp_replace(text, flag + r"\s+", " "))


def significant_words(normalized: Column) -> Column:
    """The distinct words of a normalized name but the generic ones, sorted."""
    words = F.filter(F.split(normalized, " "), lambda w: w != "")
    return F.array_sort(F.array_except(words, F.array(*(F.lit(w) for w in GENERIC_WORDS))))


def _first(text: Column, rules: list[tuple[tuple[str, ...], str]]) -> Column:
    out = None
    for needles, value in rules:
        hit = functools.reduce(lambda a, b: a | b, (F.contains(text, F.lit(n)) for n in needles))
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return out


# What pricing text says, in order.
PRICING = [(("FREE TRIAL", "FREEMIUM"), "FREEMIUM"), (("FREE", "OPEN SOURCE"), "FREE"), (("ENTERPRISE", "CUSTOM", "QUOTE"), "ENTERPRISE"), (("PAID", "COMMERCIAL", "SUBSCRIPTION", "$"), "PAID")]
BADGE_PRICING = [(("FREEMIUM", "FREE TRIAL"), "FREEMIUM"), (("FREE", "OPEN SOURCE"), "FREE"), (("ENTERPRISE",), "ENTERPRISE"), (("PAID", "COMMERCIAL"), "PAID")]
TEXT_PRICING = [(("freemium", "free trial"), "FREEMIUM"), (("open source", " free "), "FREE"), (("enterprise",), "ENTERPRISE"), (("paid", "$", "pricing"), "PAID")]


def pricing_model(text: Column) -> Column:
    """FREEMIUM, FREE, ENTERPRISE or PAID; null, for the quarantine, if the text says none."""
    return _first(F.upper(stripped(text)), PRICING)


def listing_pricing(badge: Column, container: Column) -> Column:
    """Pricing of a listing's card: from its badge, else from all of its text, else FREE."""
    by_text = F.coalesce(_first(F.lower(container), TEXT_PRICING), F.lit("FREE"))
    return F.when(badge.isNull(), by_text).otherwise(F.coalesce(_first(F.upper(badge), BADGE_PRICING), F.lit("FREE")))


def employee_count(text: Column) -> Column:
    """A whole number of zero or more, else null."""
    n = stripped(text.cast("string")).try_cast("bigint")
    return F.when(n >= 0, n)


def without_badge(name: Column) -> Column:
    return stripped(F.regexp_replace(name, r"(?i)^(Officially verified details|Verified|Featured|Promoted)\s*", ""))


def salary(low: Column, high: Column, otherwise: Column) -> Column:
    """$180,000 - $240,000, or the one bound there is, or the text; zero counts as missing."""
    money = lambda x: F.concat(F.lit("$"), F.format_number(x, 0))
    has_low, has_high = F.coalesce(low, F.lit(0)) != 0, F.coalesce(high, F.lit(0)) != 0
    return F.when(has_low & has_high, F.concat(money(low), F.lit(" - "), money(high))).when(has_low, money(low)).when(has_high, money(high)).otherwise(otherwise.cast("string"))


def has_keyword(text: Column, keywords: list[str]) -> Column:
    """Whether the lower-case text contains any keyword, within words too; no keywords let all pass."""
    return functools.reduce(lambda a, b: a | b, (F.contains(F.lower(text), F.lit(k.lower())) for k in keywords), F.lit(not keywords))
