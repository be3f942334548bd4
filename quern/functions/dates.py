"""Publication dates from text, as column expressions in UTC.

A date's text may be RFC 2822, ISO 8601 (extended, basic or week form), or one of a few written forms; without a zone it
is UTC. What can't be read is null, never an error.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.bind import let
from quern.functions.urls import stripped

MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
# Obsolete zone names and their hours.
ZONES = {"UT": 0, "UTC": 0, "GMT": 0, "Z": 0, "EST": -5, "EDT": -4, "CST": -6, "CDT": -5, "MST": -7, "MDT": -6, "PST": -8, "PDT": -7}
# What a relative date looks like and the unit of its number, in order.
RELATIVE = (
    (r"(?i)(\d+)\s*(?:seconds?|secs?|s)\s+ago", 1), (r"(?i)(\d+)\s*(?:minutes?|mins?|m)\s+ago", 60), (r"(?i)(\d+)\s*(?:hours?|hrs?|h)\s+ago", 3600),
    (r"(?i)(?:posted\s+)?(\d+)\s*(?:days?|d)\s+ago", 86400), (r"(?i)^(yesterday)\b", None), (r"(?i)^(today)\b", None), (r"(?i)(just\s+now)", None),
)
URL_DATE = r"/(\d{4})/(\d{1,2})/(\d{1,2})/"


def _int(text: Column) -> Column:
    return F.nullif(text, F.lit("")).try_cast("int")


def _month(name: Column) -> Column:
    place = F.array_position(F.array(*(F.lit(m) for m in MONTHS)), F.lower(F.left(name, F.lit(3))))
    return F.when(place > 0, place.cast("int"))


def _shifted(local: Column, seconds: Column) -> Column:
    """A local time east of Greenwich by so many seconds, in UTC."""
    return F.timestamp_micros(F.unix_micros(local) - seconds.cast("bigint") * F.lit(1_000_000))


def _made(year: Column, month: Column, day: Column, hour: Column, minute: Column, second: Column) -> Column:
    """A time of the Gregorian calendar, or null; seconds run to 59."""
    fits = (second >= 0) & (second < 60)
    return F.when(fits, F.try_make_timestamp(year, month, day, hour, minute, second, F.lit("UTC")))


_RFC = r"^(?:[A-Za-z]+,?\s+)?(\d{1,2})[\s-]+([A-Za-z]{3,9})\.?[\s-]+(\d{4}|\d{2})(?:\s+(\d{1,2}):(\d{2})(?::(\d{2}))?)?(?:\s+([+-]\d{4}|[A-Za-z]{1,5}))?(?:\s+\(.*\))?$"
_WRITTEN = r"^([A-Za-z]{3,9})\s+(\d{1,2}),?\s+(\d{4})(?:\s+(\d{1,2}):(\d{2})(?::(\d{2}))?)?$"
_ISO = r"^(\d{4})-?(\d{2})-?(\d{2})(?:[T ](\d{2}):?(\d{2})?(?::?(\d{2})(?:[.,](\d{1,9}))?)?\s*(Z|[+-]\d{2}(?::?\d{2})?)?)?$"
_WEEK = r"^(\d{4})-?W(\d{2})(?:-?([1-7]))?$"


def parse_date(text: Column) -> Column:
    """The time that a date's text says."""
    return let(stripped(text), _parsed)


def _parsed(text: Column) -> Column:
    part = lambda pattern, k: F.regexp_extract(text, pattern, k)
    zero = lambda x: F.coalesce(_int(x), F.lit(0))

    year = _int(part(_RFC, 3))
    year = F.when(F.length(part(_RFC, 3)) == 4, year).when(year < 69, year + 2000).otherwise(year + 1900)
    zone = part(_RFC, 7)
    signed = F.when(F.startswith(zone, F.lit("-")), F.lit(-1)).otherwise(F.lit(1)) * (zero(F.substring(zone, 2, 2)) * 3600 + zero(F.substring(zone, 4, 2)) * 60)
    named = functools.reduce(lambda c, z: c.when(F.upper(zone) == z[0], F.lit(z[1] * 3600)), ZONES.items(), F.when(F.lit(False), F.lit(0))).otherwise(F.lit(0))
    offset = F.when(zone.rlike(r"^[+-]\d{4}$"), signed).otherwise(named)
    rfc = _shifted(_made(year, _month(part(_RFC, 2)), _int(part(_RFC, 1)), zero(part(_RFC, 4)), zero(part(_RFC, 5)), zero(part(_RFC, 6))), offset)

    zone = F.regexp_replace(part(_ISO, 8), ":", "")
    signed = F.when(F.startswith(zone, F.lit("-")), F.lit(-1)).otherwise(F.lit(1)) * (zero(F.substring(zone, 2, 2)) * 3600 + zero(F.substring(zone, 4, 2)) * 60)
    offset = F.when(zone.rlike(r"^[+-]"), signed).otherwise(F.lit(0))
    micros = F.coalesce(F.rpad(part(_ISO, 7), 6, "0").try_cast("bigint"), F.lit(0))
    iso = _shifted(_made(_int(part(_ISO, 1)), _int(part(_ISO, 2)), _int(part(_ISO, 3)), zero(part(_ISO, 4)), zero(part(_ISO, 5)), zero(part(_ISO, 6))), offset)
    iso = F.timestamp_micros(F.unix_micros(iso) + micros)

    # Day 1 of week 1 is the Monday of the week with 4 January.
    fourth = F.try_make_timestamp(_int(part(_WEEK, 1)), F.lit(1), F.lit(4), F.lit(0), F.lit(0), F.lit(0), F.lit("UTC"))
    monday = F.date_sub(F.to_date(fourth), F.weekday(fourth))
    week = F.when(_int(part(_WEEK, 2)).between(1, 53), F.date_add(monday, (_int(part(_WEEK, 2)) - 1) * 7 + F.coalesce(_int(part(_WEEK, 3)), F.lit(1)) - 1).cast("timestamp"))

    written = _made(_int(part(_WRITTEN, 3)), _month(part(_WRITTEN, 1)), _int(part(_WRITTEN, 2)), zero(part(_WRITTEN, 4)), zero(part(_WRITTEN, 5)), zero(part(_WRITTEN, 6)))
    return F.coalesce(rfc, iso, week, written)


_NUMERIC = r"^(\d{1,2})[/-](\d{1,2})[/-](\d{4})(?:\s+(\d{1,2}):(\d{2})(?::(\d{2}))?)?$"


def parse_numeric(text: Column, locale: Column | str = "en_US") -> Column:
    """09/10/2026: month first in en_US, day first elsewhere; the other way round if that is no date."""
    return let(stripped(text), lambda t: _numeric(t, F.lit(locale) if isinstance(locale, str) else locale))


def _numeric(text: Column, locale: Column) -> Column:
    part = lambda k: F.coalesce(_int(F.regexp_extract(text, _NUMERIC, k)), F.lit(0))
    made = lambda month, day: _made(part(3), month, day, part(4), part(5), part(6))
    month_first, day_first = made(part(1), part(2)), made(part(2), part(1))
    found = F.when(F.startswith(locale, F.lit("en_US")), F.coalesce(month_first, day_first)).otherwise(F.coalesce(day_first, month_first))
    return F.when(text.rlike(_NUMERIC), found)


def parse_relative(text: Column, reference: Column, zone: Column | str = "UTC") -> Column:
    """"2 hours ago" and its like, by the wall clock of the source's zone: the difference is taken from local time."""
    zone = F.lit(zone) if isinstance(zone, str) else zone
    text, local, found = stripped(text), F.from_utc_timestamp(reference, zone), []
    for pattern, unit in RELATIVE:
        group = F.regexp_extract(text, pattern, 1)
        if unit:
            back = F.nullif(group, F.lit("")).try_cast("bigint") * F.lit(unit)
        else:
            back = F.when(group != "", F.when(F.lower(group) == "yesterday", F.lit(86400)).otherwise(F.lit(0)))
        found.append(F.to_utc_timestamp(_shifted(local, back), zone))
    return F.coalesce(*found)


def url_date(url: Column, pattern: str = URL_DATE) -> Column:
    """The date in an address by a pattern with the groups year, month and day."""
    part = lambda k: _int(F.regexp_extract(url, pattern, k))
    return F.try_make_timestamp(part(1), part(2), part(3), F.lit(0), F.lit(0), F.lit(0), F.lit("UTC"))


# Attributes and names of meta tags with a date, in order.
META_DATES = (
    ("property", "article:published_time"), ("property", "og:published_time"), ("name", "article:published_time"), ("name", "pubdate"),
    ("name", "publishdate"), ("name", "timestamp"), ("name", "dc.date"), ("name", "dc.date.issued"), ("name", "date"),
    ("name", "parsely-pub-date"), ("name", "sailthru.date"),
)
# Confidence by where a date was found.
CONFIDENCE = {
    "structured_json_ld_published": 0.98, "structured_json_ld_modified": 0.98, "structured_feed_pubdate": 0.95, "meta_preferred": 0.92, "meta": 0.88,
    "visible_time_datetime": 0.85, "visible_time_relative": 0.80, "visible_time_text": 0.82, "url_date_regex": 0.70, "sitemap_lastmod_fallback": 0.50,
}


def _attribute(tag: Column, name: str) -> Column:
    quoted = F.regexp_extract(tag, rf"""(?is)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return F.regexp_replace(quoted, """^["']|["']$""", "")


def _meta(html: Column, attribute: str, name: str) -> Column:
    """The content of the first meta tag of that name, whichever comes first of the two attributes; empty if none."""
    quoted = name.replace(".", r"\.")
    tag = F.regexp_extract(html, rf"""(?is)(<meta\b[^>]*\s{attribute}\s*=\s*["']?{quoted}["'\s/>][^>]*>|<meta\b[^>]*\s{attribute}\s*=\s*["']?{quoted}["']?\s*/?>)""", 1)
    return _attribute(tag, "content")


def json_ld_dates(html: Column, key: str) -> Column:
    """All texts of a key in the JSON-LD scripts of a page, in order."""
    scripts = F.regexp_extract_all(html, F.lit(r"""(?is)<script[^>]*type\s*=\s*["']?application/ld\+json["']?[^>]*>(.*?)</script>"""), F.lit(1))
    valid = F.filter(scripts, lambda s: F.try_parse_json(s).isNotNull())
    return F.flatten(F.transform(valid, lambda s: F.regexp_extract_all(s, F.lit(rf'"{key}"\s*:\s*"([^"]*)"'), F.lit(1))))


def extract_date(html: Column, feed: Column, url: Column, reference: Column, *, zone: str = "UTC", preferred: tuple[str, ...] = (), allow_modified: bool = False, url_pattern: str | None = None, sitemap: Column | None = None, skew_minutes: int = 15) -> Column:
    """A struct of ts, method, confidence, is_future and raw: the first date found, by how far its place is to be trusted.

    In order: JSON-LD, the feed's own date, preferred and standard meta tags, the first time element (its attribute, then
    its text as relative or plain date), the address by a configured pattern, the sitemap.
    """

    none = F.lit(None).cast("string")

    def place(raw: Column, method: str, confidence: float, *, silent: bool = False, relative: bool = False) -> Column:
        return F.struct(F.nullif(raw, F.lit("")).alias("raw"), F.lit(method).alias("method"), F.lit(confidence).alias("confidence"), F.lit(silent).alias("silent"), F.lit(relative).alias("relative"))

    def all_of(raws: Column, method: str, confidence: float) -> Column:
        return F.transform(raws, lambda raw: place(raw, method, confidence, silent=True))

    tag = F.regexp_extract(html, r"(?is)(<time\b[^>]*>)", 1)
    stamp, shown = _attribute(tag, "datetime"), stripped(F.regexp_replace(F.regexp_extract(html, r"(?is)<time\b[^>]*>(.*?)</time>", 1), "<[^>]*>", ""))
    later = [place(feed, "structured_feed_pubdate", 0.95)]
    later += [place(F.coalesce(F.nullif(_meta(html, "property", n), F.lit("")), _meta(html, "name", n)), f"meta_preferred_{n}", 0.92) for n in preferred]
    later += [place(_meta(html, attribute, n), f"meta_{n}", 0.88) for attribute, n in META_DATES]
    later += [place(stamp, "visible_time_datetime", 0.85), place(shown, "visible_time_relative", 0.80, relative=True), place(shown, "visible_time_text", 0.82)]
    places = [all_of(json_ld_dates(html, "datePublished"), "structured_json_ld_published", 0.98)]
    if allow_modified:
        places.append(all_of(json_ld_dates(html, "dateModified"), "structured_json_ld_modified", 0.98))
    last = [place(sitemap, "sitemap_lastmod_fallback", 0.50)] if sitemap is not None else []

    def dated(p: Column) -> Column:
        ts = F.when(p["relative"], parse_relative(p["raw"], reference, zone)).otherwise(parse_date(p["raw"]))
        return F.struct(ts.alias("ts"), p["method"].alias("method"), p["confidence"].alias("confidence"), F.when(~p["silent"], p["raw"]).alias("raw"))

    told = F.filter(F.concat(*places, F.array(*later)), lambda p: p["raw"].isNotNull())
    found = F.transform(told, dated)
    if url_pattern:
        of_url = F.struct(url_date(url, url_pattern).alias("ts"), F.lit("url_date_regex").alias("method"), F.lit(0.70).alias("confidence"), url.alias("raw"))
        found = F.concat(found, F.array(of_url))
    if last:
        found = F.concat(found, F.transform(F.array(*last), dated))
    nothing = F.struct(F.lit(None).cast("timestamp").alias("ts"), F.lit("not_found").alias("method"), F.lit(0.0).alias("confidence"), none.alias("raw"))
    limit = reference + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(skew_minutes))
    first = F.coalesce(F.get(F.filter(found, lambda d: d["ts"].isNotNull()), F.lit(0)), nothing)
    return let(first, lambda d: F.struct(d["ts"].alias("ts"), d["method"].alias("method"), d["confidence"].alias("confidence"), F.coalesce(d["ts"] > limit, F.lit(False)).alias("is_future"), d["raw"].alias("raw")))
