"""From candidates to accepted news and jobs, and the state for the next run.

candidates: source_id, raw_url, title, published_date_raw, author_or_company, description, position, first_seen_at.
details: canonical_url, html (what was fetched). sources: source_id, name, type (news or job), base_url, timezone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.dates import extract_date
from quern.functions.urls import signal_url, url_hash
from quern.operators.dedup import signal_hash
from quern.operators.freshness import gate
from quern.operators.small import broadcast_if_small
from quern.sources import markup


def extract_signals(candidates: DataFrame, details: DataFrame, sources: DataFrame, reference: Column, *, selectors: dict[str, str] | None = None, preferred: tuple[str, ...] = (), url_pattern: str | None = None) -> DataFrame:
    """A row for each candidate with its content, date and hashes, ready for the gate."""
    own = candidates.join(broadcast_if_small(sources.select("source_id", F.col("name").alias("source_name"), "type", "base_url")), "source_id")
    own = own.withColumn("canonical_url", signal_url(F.col("raw_url"), F.col("base_url")))
    df = own.join(details.select("canonical_url", "html"), "canonical_url", "left")
    df = df.withColumn("page", F.coalesce(F.nullif("html", F.lit("")), "description", F.lit("")))

    # Pages are read once for articles and once for jobs, each for its own sources only, and where their rows are.
    is_news = F.col("type") == "news"
    df = df.withColumn("article", markup.article_column(F.when(is_news, F.col("page")), selectors)).withColumn("job", markup.job_column(F.when(~is_news, F.col("page")), selectors))
    of_news, of_jobs = (lambda name: F.when(is_news, F.col(f"article.{name}"))), (lambda name: F.when(~is_news, F.col(f"job.{name}")))
    df = df.withColumn("listed_title", F.col("title")).withColumn("title", F.coalesce(of_news("title"), of_jobs("title"))).withColumn("full_text", F.coalesce(of_news("full_text"), of_jobs("description_full_text")))
    df = df.withColumns({name: of_news(name) for name in ("author", "summary")} | {name: of_jobs(name) for name in ("company", "location", "salary")})

    blank = lambda *cs: F.coalesce(*(F.nullif(c, F.lit("")) for c in cs))
    untitled = F.when(F.col("type") == "news", F.lit("Untitled Article")).otherwise(F.lit("Untitled Job"))
    date = extract_date(F.coalesce("html", F.lit("")), F.col("published_date_raw"), F.col("canonical_url"), reference, preferred=preferred, url_pattern=url_pattern)
    df = df.withColumn("title", F.coalesce(blank(F.col("title"), F.col("listed_title")), untitled)).withColumn("author", blank(F.col("author"), F.col("author_or_company")))
    df = df.withColumn("full_text", blank(F.col("full_text"), F.col("description"))).withColumn("summary", blank(F.col("summary"), F.col("description"))).withColumn("date", date)
    return df.select(
        "source_id", "type", "canonical_url", url_hash(F.col("canonical_url")).alias("url_hash"), signal_hash(F.col("source_id"), F.col("title"), F.col("canonical_url")).alias("content_hash"), "title", "author", "company", "location",
        "salary", "full_text", "summary", F.col("date.ts").alias("published_at"), F.col("date.confidence").alias("published_at_confidence"), F.col("date.method").alias("date_extraction_method"), "position", "first_seen_at",
    )


def ingest(candidates: DataFrame, details: DataFrame, sources: DataFrame, state: DataFrame, reference: Column, **rules) -> DataFrame:
    """Extracted signals with their freshness decision; ids are made of source and address, so a run can be repeated."""
    gated = gate(extract_signals(candidates, details, sources, reference, **rules), state, reference)
    return gated.withColumn("id", F.sha2(F.concat("source_id", F.lit("|"), "url_hash"), 256))
