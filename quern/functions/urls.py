"""URLs and domains as column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Query keys that carry no identity.
TRACKING_KEYS = (
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid", "gclsrc", "dclid",
    "zanpid", "msclkid", "ref", "ref_src", "source", "_hsenc", "_hsmi", "mc_cid", "mc_eid",
)
# Further keys of feeds, newsletters and sessions.
SIGNAL_KEYS = (
    *TRACKING_KEYS, "utm_id", "utm_reader", "feed", "feed_type", "rss", "from", "referer", "gh_src", "src",
    "session_id", "sessionid", "jsessionid", "phpsessid", "_ga", "_gl",
)
# First path segments of the code host that aren't owners.
RESERVED_OWNERS = ("topics", "features", "explore", "trending", "about", "pricing", "login")

SPACE = r"^\s+|\s+$"


def stripped(text: Column) -> Column:
    """Without white space of any kind at both ends; trim() knows spaces only."""
    return F.regexp_replace(text, SPACE, "")


def _decoded(text: Column) -> Column:
    return F.coalesce(F.try_url_decode(text), text)


def _encoded(text: Column) -> Column:
    """As in application/x-www-form-urlencoded by RFC 3986's unreserved characters."""
    return F.replace(F.replace(F.url_encode(text), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def resolve_url(url: Column, base: Column) -> Column:
    """A reference made absolute by RFC 3986; one that is malformed (an open bracket, say) comes back as it is."""

    def one(url: str | None, base: str | None) -> str | None:
        try:
            return url if url is None or not base else urljoin(base, url)
        except ValueError:
            return url

    @F.pandas_udf(StringType())
    def joined(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for urls, bases in parts:
            yield pd.Series([one(u, b) for u, b in zip(urls, bases, strict=True)], dtype=object)

    return joined(url, base)


def canonical_url(url: Column, base: Column | None = None, tracking: Iterable[str] = TRACKING_KEYS) -> Column:
    """One form of each address: lower-case scheme and host, no default port, no repeated or final slash, no parameters
    of the last segment, no blank or tracking query keys, the rest sorted, no fragment.

    Null and empty give the empty string; what isn't http or https comes back trimmed.
    """
    text = stripped(F.coalesce(url, F.lit("")))
    text = resolve_url(text, base) if base is not None else text
    scheme = F.lower(F.regexp_extract(text, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    rest = F.regexp_replace(text, r"^[A-Za-z][A-Za-z0-9+.-]*:", "")
    host = F.lower(F.regexp_extract(rest, r"^//([^/?#]*)", 1))
    host = F.regexp_replace(host, F.when(scheme == "http", F.lit(r":80$")).otherwise(F.lit(r":443$")), F.lit(""))
    path = F.regexp_extract(rest, r"^(?://[^/?#]*)?([^?#]*)", 1)
    path = F.regexp_replace(F.regexp_replace(path, r";[^/]*$", ""), r"/+", "/")
    path = F.when(path == "", F.lit("/")).when(F.length(path) > 1, F.regexp_replace(path, r"/$", "")).otherwise(path)
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    keys = F.array(*(F.lit(k) for k in sorted(set(tracking))))
    fields = F.filter(F.split(query, "&"), lambda p: p.rlike("=."))
    pairs = F.transform(fields, lambda p: F.struct(stripped(_decoded(F.substring_index(p, "=", 1))).alias("k"), stripped(_decoded(F.regexp_replace(p, "^[^=]*=", ""))).alias("v")))
    kept = F.array_sort(F.filter(pairs, lambda p: ~F.array_contains(keys, F.lower(p["k"]))))
    asked = F.array_join(F.transform(kept, lambda p: F.concat(_encoded(p["k"]), F.lit("="), _encoded(p["v"]))), "&")
    whole = F.concat(scheme, F.lit("://"), host, path, F.when(asked != "", F.concat(F.lit("?"), asked)).otherwise(F.lit("")))
    return F.when(scheme.isin("http", "https"), whole).otherwise(text)


def signal_url(url: Column, base: Column | None = None) -> Column:
    return canonical_url(url, base, SIGNAL_KEYS)


def url_hash(canonical: Column) -> Column:
    return F.sha2(canonical, 256)


def domain(url: Column) -> Column:
    """The host of an address or bare domain, without port and one leading www; sub-domains stay. Null gives the empty string."""
    text = F.lower(stripped(F.coalesce(url, F.lit(""))))
    text = F.when(text.rlike("^https?://"), text).otherwise(F.concat(F.lit("https://"), text))
    host = F.regexp_extract(text, r"^https?://([^/?#]*)", 1)
    host = F.when(host != "", host).otherwise(F.regexp_extract(text, r"^https?://[^/?#]*([^?#;]*)", 1))
    return stripped(F.regexp_replace(F.substring_index(host, ":", 1), r"^www\.", ""))


def pacing_key(url: Column) -> Column:
    """The host with its port, or ``default``."""
    return F.coalesce(F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit("")), F.lit("default"))


def repository_slug(url: Column) -> Column:
    """owner/name of a code host's address, or null."""
    found = r"github\.com/([a-zA-Z0-9_.-]+)/([a-zA-Z0-9_.-]+)"
    owner, name = F.regexp_extract(url, found, 1), F.regexp_replace(F.regexp_extract(url, found, 2), r"\.git$", "")
    return F.when((owner != "") & (name != "") & ~F.lower(owner).isin(*RESERVED_OWNERS), F.concat(owner, F.lit("/"), name))


def clean_repository_url(url: Column) -> Column:
    """https://host/owner/name without a final slash or .git; null if there is none."""
    found = F.regexp_extract(F.regexp_replace(stripped(url), r"/+$", ""), r"(https?://github\.com/[a-zA-Z0-9_.-]+/[a-zA-Z0-9_.-]+)", 1)
    return F.nullif(F.regexp_replace(found, r"\.git$", ""), F.lit(""))
