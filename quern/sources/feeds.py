"""Discovery: candidates and records from fetched payloads (feeds, JSON, listings).

Payloads are rows, so nothing here fetches. A candidate's position is its place among the kept items of all of its
source's payloads, from 0. JSON is read by Spark; XML and HTML by the standard library, a payload at a time.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.names import listing_pricing, without_badge
from quern.functions.text import collapsed
from quern.functions.urls import canonical_url, stripped
from quern.sources import markup

CANDIDATES = "source_id string, payload_no int, item_no int, raw_url string, title string, published_date_raw string, author_or_company string, description string"
DATES, AUTHORS = ("pubdate", "published", "updated", "date"), ("creator", "author", "company")


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _text(element: ET.Element | None) -> str:
    return "".join(t.strip() for t in element.itertext()) if element is not None else ""


def _child(item: ET.Element, *names: str) -> ET.Element | None:
    return next((e for e in item.iter() if e is not item and _local(e.tag).lower() in names), None)


def feed_items(xml: str | None, base: str, keywords: list[str]) -> list[tuple[str, str, str | None, str | None, str]]:
    """Address, title, date, author and description of a feed's items; ParseError if it is no XML."""
    root = ET.fromstring((xml or "").strip())
    items = [e for e in root.iter() if _local(e.tag) == "item"] or [e for e in root.iter() if _local(e.tag) == "entry"]
    out = []
    for item in items:
        link = _child(item, "link")
        address = (link.get("href") or _text(link)) if link is not None else ""
        if not address and _text(named := _child(item, "guid", "id")).startswith(("http://", "https://")):
            address = _text(named)
        title = _text(_child(item, "title"))
        said = f"{title} {''.join(item.itertext())}".lower()
        if not address or (keywords and not any(k.lower() in said for k in keywords)):
            continue
        described = _child(item, "description", "summary")
        date, author = _child(item, *DATES), _child(item, *AUTHORS)
        out.append((urljoin(base, address), title, _text(date) or None, _text(author) or None, _text(described if described is not None else item)))
    return out


def _positioned(df: DataFrame, limit: int | None) -> DataFrame:
    """Positions by source, without one window over a source's payloads: counts of payloads are summed, then added to the
    places within payloads. Items are ordered by their place already."""
    before = Window.partitionBy("source_id").orderBy("payload_no").rowsBetween(Window.unboundedPreceding, -1)
    first = df.groupBy("source_id", "payload_no").agg(F.count("*").alias("_n_")).withColumn("_first_", F.coalesce(F.sum("_n_").over(before), F.lit(0))).drop("_n_")
    out = df.join(first, ["source_id", "payload_no"]).withColumn("position", (F.col("_first_") + F.col("item_no")).cast("int")).drop("_first_", "item_no")
    return out if limit is None else out.where(F.col("position") < limit)


def _parsed(payloads: DataFrame, one) -> DataFrame:
    """one(row of payload_no, body, base_url, config) for each payload; a payload that fails gives an error row."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                try:
                    out += [(r.source_id, r.payload_no, i, *item, None) for i, item in enumerate(one(r))]
                except Exception as e:  # the row says so; other payloads go on
                    out.append((r.source_id, r.payload_no, -1, None, None, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["source_id", "payload_no", "item_no", "raw_url", "title", "published_date_raw", "author_or_company", "description", "error"])

    return payloads.select("source_id", "payload_no", "body", "base_url").mapInPandas(run, f"{CANDIDATES}, error string")


def discover_feed(payloads: DataFrame, keywords: list[str] | None = None, limit: int | None = 50) -> tuple[DataFrame, DataFrame]:
    """Candidates of RSS and Atom payloads (source_id, payload_no, body, base_url), and the payloads that failed with their errors."""
    found = _parsed(payloads, lambda r: feed_items(r.body, r.base_url or "", keywords or []))
    return _positioned(found.where("error IS NULL").drop("error"), limit), found.where("error IS NOT NULL").select("source_id", "payload_no", "error")


def discover_listing(payloads: DataFrame, selectors: dict[str, str], limit: int | None = 50) -> tuple[DataFrame, DataFrame]:
    """Candidates of HTML listings; a listing that fails gives no candidate, and its error comes apart."""
    found = _parsed(payloads, lambda r: [(url, title, None, company, None) for url, title, company in markup.listing(r.body, r.base_url or "", selectors)])
    return _positioned(found.where("error IS NULL").drop("error"), limit), found.where("error IS NOT NULL").select("source_id", "payload_no", "error")


def discover_api(payloads: DataFrame, fields: dict[str, str] | None = None, limit: int | None = 50) -> DataFrame:
    """Candidates of JSON payloads: a list, or the list under ``api_item_key``, or the first list of an object.

    fields names url_field, id_field, title_field, company_field and date_field. Items without an address and an id (legal
    notices) take no position. A payload that is no JSON gives nothing.
    """
    fields = {"url_field": "url", "id_field": "id", "title_field": "position", "company_field": "company", "date_field": "date"} | (fields or {})
    # The raw text of each value keeps its order and kind; objects are maps of raw values.
    as_list = F.from_json("body", "array<string>")
    as_map = F.from_json("body", "map<string,string>")
    keyed = F.from_json(F.element_at(as_map, F.lit(fields["api_item_key"])), "array<string>") if "api_item_key" in fields else F.lit(None).cast("array<string>")
    lists = F.filter(F.map_values(as_map), lambda v: F.startswith(F.ltrim(v), F.lit("[")))
    first = F.from_json(F.get(lists, F.lit(0)), "array<string>")
    items = F.when(F.startswith(F.ltrim("body"), F.lit("[")), as_list).otherwise(F.coalesce(keyed, first))
    each = payloads.select("source_id", "payload_no", "base_url", F.posexplode(items).alias("n", "item")).where(F.startswith("item", F.lit("{")))
    each = each.withColumn("m", F.from_json("item", "map<string,string>"))
    value = lambda name: F.nullif(F.element_at("m", F.lit(name)), F.lit(""))
    by_id = F.concat("base_url", F.lit("/job/"), value(fields["id_field"]))
    found = each.select(
        "source_id", "payload_no", "n", F.coalesce(value(fields["url_field"]), by_id).alias("raw_url"), F.coalesce(value(fields["title_field"]), value("title")).alias("title"),
        F.coalesce(value(fields["date_field"]), value("epoch"), value("published_at")).alias("published_date_raw"), value(fields["company_field"]).alias("author_or_company"), F.col("item").alias("description"),
    ).where("raw_url IS NOT NULL")
    place = Window.partitionBy("source_id", "payload_no").orderBy("n")  # a payload is one answer of a server
    return _positioned(found.withColumn("item_no", F.row_number().over(place) - 1).drop("n"), limit)


RECORD = "kind string, name string, source_name string, source_url string, pricing string, employees string, repository string, stars bigint, authors array<string>, published_date string"
REPOSITORY = r"(?i)https?://(?:www\.)?github\.com/[a-z0-9_.-]+/[a-z0-9_.-]+"


def _record(kind: str, name: Column, source: str, url: Column, **more: Column) -> list[Column]:
    empty = {"pricing": "string", "employees": "string", "repository": "string", "stars": "bigint", "authors": "array<string>", "published_date": "string"}
    return [F.lit(kind).alias("kind"), name.alias("name"), F.lit(source).alias("source_name"), url.alias("source_url"), *(more.get(k, F.lit(None)).cast(t).alias(k) for k, t in empty.items())]


def directory_records(payloads: DataFrame, source: str, site: str) -> DataFrame:
    """Startups of an object of objects {cik_str, ticker, title}; at most batch_count of each payload, if that is given."""
    companies = F.map_values(F.from_json("body", "map<string,struct<cik_str:string,ticker:string,title:string>>"))
    named = F.filter(companies, lambda c: stripped(F.coalesce(c["title"], F.lit(""))) != "")
    bounded = F.when(F.col("batch_count").isNull(), named).otherwise(F.slice(named, F.lit(1), F.greatest(F.col("batch_count").cast("int"), F.lit(0))))
    each = payloads.select(F.explode(bounded).alias("c"))
    return each.select(*_record("STARTUP", title_case(stripped(F.col("c.title"))), source, F.concat(F.lit(site), F.lpad(F.col("c.cik_str"), 10, "0"))))


def title_case(text: Column) -> Column:
    """Each run of letters with its first letter upper and the rest lower, also after digits and apostrophes."""
    runs, gaps = F.regexp_extract_all(text, F.lit(r"(\p{L}+)"), F.lit(1)), F.split(text, r"\p{L}+")
    cased = F.transform(runs, lambda r: F.concat(F.upper(F.left(r, F.lit(1))), F.lower(F.substring(r, F.lit(2), F.length(r)))))
    return F.when(F.size(runs) > 0, F.array_join(F.zip_with(gaps, cased, lambda g, r: F.concat(g, F.coalesce(r, F.lit("")))), "")).otherwise(text)


def knowledge_base_records(payloads: DataFrame, source: str) -> DataFrame:
    """Startups of SPARQL results; names that are bare item numbers are passed over."""
    value = "struct<value:string>"
    bindings = F.from_json("body", f"results struct<bindings:array<struct<item:{value},itemLabel:{value},website:{value},employees:{value}>>>")
    each = payloads.select(F.explode(bindings["results"]["bindings"]).alias("b"))
    name, site, item = (stripped(F.coalesce(F.col(f"b.{x}.value"), F.lit(""))) for x in ("itemLabel", "website", "item"))
    url = F.when(F.startswith(site, F.lit("http")), site).otherwise(item)
    whole = F.col("b.employees.value").try_cast("double").try_cast("bigint").cast("string")
    return each.where((name != "") & ~name.rlike(r"^Q\d+$") & (url != "")).select(*_record("STARTUP", name, source, url, employees=whole))


def repository_records(payloads: DataFrame, source: str) -> DataFrame:
    """Products of a code host's search: owner/name, the home page if it is an address."""
    items = F.from_json("body", "items array<struct<name:string,owner:struct<login:string>,homepage:string,html_url:string,stargazers_count:bigint>>")["items"]
    each = payloads.select(F.explode(items).alias("r"))
    name, owner = (stripped(F.coalesce(F.col(x), F.lit(""))) for x in ("r.name", "r.owner.login"))
    url = F.when(F.startswith(F.coalesce("r.homepage", F.lit("")), F.lit("http")), F.col("r.homepage")).otherwise(F.col("r.html_url"))
    shown = F.when(owner != "", F.concat(owner, F.lit("/"), name)).otherwise(name)
    return each.where((name != "") & (F.coalesce(url, F.lit("")) != "")).select(*_record("PRODUCT", shown, source, canonical_url(url), pricing=F.lit("FREE"), stars=F.col("r.stargazers_count")))


def unreadable(payloads: DataFrame) -> DataFrame:
    """The payloads that paper_records passes over, as they are no XML: their columns and error."""

    @F.pandas_udf("string")
    def failed(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(body: str | None) -> str | None:
            try:
                ET.fromstring((body or "").strip())
            except ET.ParseError as e:
                return f"ParseError: {e}"
            return None

        for bodies in parts:
            yield pd.Series([one(b) for b in bodies], dtype=object)

    return payloads.withColumn("error", failed(F.col("body"))).where("error IS NOT NULL")


def catalog_records(payloads: DataFrame, source: str, site: str) -> DataFrame:
    """Products of a software directory's listings."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame([c for body in frame["body"] for c in markup.product_cards(body, site)], columns=["name", "address", "badge", "shown"])

    cards = payloads.select("body").mapInPandas(run, "name string, address string, badge string, shown string")
    name = without_badge(F.col("name"))
    return cards.where(name != "").select(*_record("PRODUCT", name, source, canonical_url(F.col("address")), pricing=listing_pricing(F.col("badge"), F.col("shown"))))


def paper_records(payloads: DataFrame, source: str, stats: DataFrame | None = None) -> DataFrame:
    """Papers of Atom payloads (unreadable() gives those that are none); stars of the first repository in summary or comment from stats (slug, stars), 0 without one."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for body in frame["body"]:
                try:
                    root = ET.fromstring((body or "").strip())
                except ET.ParseError:
                    continue
                for entry in (e for e in root.iter() if _local(e.tag) == "entry"):
                    direct = {}
                    for e in entry:
                        direct.setdefault(_local(e.tag), []).append(e)
                    one = lambda name: (direct[name][0].text or "") if name in direct else ""  # noqa: B023, E731
                    alternate = next((e.get("href") for e in direct.get("link", []) if e.get("rel") == "alternate"), None)
                    names = [_text(n) for a in direct.get("author", []) for n in a if _local(n.tag) == "name"]
                    out.append((one("title"), alternate or one("id").strip(), [n for n in names if n], one("published").strip(), f"{one('summary')} {one('comment')}"))
            yield pd.DataFrame(out, columns=["title", "url", "authors", "published", "said"])

    entries = payloads.select("body").mapInPandas(run, "title string, url string, authors array<string>, published string, said string")
    found = F.nullif(F.regexp_replace(F.regexp_replace(F.regexp_extract("said", f"({REPOSITORY})", 1), r"[/.,:;)]+$", ""), r"\.git$", ""), F.lit(""))
    df = entries.select(collapsed(F.col("title")).alias("title"), "url", "authors", "published", found.alias("found")).where("title != ''")
    slug = F.lower(F.regexp_extract("found", r"(?i)github\.com/([^/]+/[^/]+)", 1))
    if stats is not None:
        known = stats.groupBy(F.lower("slug").alias("_slug_")).agg(F.max("stars").alias("_stars_"))
        df = df.join(known, slug == F.col("_slug_"), "left")
    stars = F.coalesce("_stars_", F.lit(0)) if stats is not None else F.lit(0)
    return df.select(*_record("RESEARCH_PAPER", F.col("title"), source, F.col("url"), repository=F.col("found"), stars=stars, authors=F.col("authors"), published_date=F.col("published")))


def counter(text: Column) -> Column:
    """1.2k, 3,400 or 2M as a whole number; null if there is none."""
    number = F.replace(F.regexp_extract(text, r"(?i)([\d,.]+)\s*(k|m)?", 1), F.lit(","), F.lit("")).try_cast("double")
    unit = F.lower(F.regexp_extract(text, r"(?i)([\d,.]+)\s*(k|m)?", 2))
    return F.floor(number * F.when(unit == "k", 1e3).when(unit == "m", 1e6).otherwise(1.0)).cast("bigint")


#: Sources by flavour: a function of payloads each. Further ones are added by name.
REGISTRY = {
    "papers": paper_records, "knowledge_base": knowledge_base_records, "directory": directory_records, "catalog": catalog_records, "repositories": repository_records,
    "feed": discover_feed, "api": discover_api, "listing": discover_listing,
}


#: Other names that a selection may use.
ALIASES = {"paper": "papers", "research_paper": "papers", "startup": "startups", "product": "products"}
#: What is run for a type of record.
OF_TYPE = {"papers": ("papers",), "startups": ("knowledge_base", "directory"), "products": ("catalog", "repositories")}


def selected(kind: str = "all") -> tuple[str, ...]:
    """The sources of a type of record by name or alias; all of them for ``all``."""
    if kind == "all":
        return tuple(x for names in OF_TYPE.values() for x in names)
    kind = ALIASES.get(kind, kind)
    if kind not in OF_TYPE:
        raise ValueError(f"no type of record is called {kind}; there are {', '.join(sorted(OF_TYPE))}")
    return OF_TYPE[kind]


def source(name: str):
    if name not in REGISTRY:
        raise ValueError(f"no source is called {name}; there are {', '.join(sorted(REGISTRY))}")
    return REGISTRY[name]


def paged(limits: DataFrame, batch: int) -> DataFrame:
    """A row for each page of a paged source: limits has source_id, start and total; the last page takes what is left."""
    pages = F.when(F.col("total") > 0, F.sequence(F.lit(0), F.ceil(F.col("total") / F.lit(batch)).cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    each = limits.select("source_id", "start", "total", F.explode(pages).alias("page"))
    return each.select("source_id", "page", (F.col("start") + F.col("page") * batch).alias("offset"), F.least(F.lit(batch), F.col("total") - F.col("page") * batch).alias("batch_count"))
