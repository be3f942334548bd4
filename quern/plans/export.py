"""Curated tabs and the files that they become."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.operators.resolve import resolve

EMPTY_NOTE = "No records collected within window"


def _or_blank(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def flat_records(records: DataFrame, kind: str) -> DataFrame:
    """A flat row for each valid record of a kind, in order of id."""
    base = [F.lit("1.0").alias("schemaVersion"), F.col("kind").alias("recordType"), _or_blank(F.col("source_name")).alias("source_name"), _or_blank(F.col("source_url")).alias("source_url"), _or_blank(F.col("collected_at")).alias("collectedAt")]
    more = {
        "STARTUP": [_or_blank(F.col("name")).alias("entityName"), _or_blank(F.col("employees")).alias("employeeCount")],
        "PRODUCT": [_or_blank(F.col("name")).alias("startupName"), _or_blank(F.col("pricing")).alias("pricingModel")],
        "RESEARCH_PAPER": [
            _or_blank(F.col("name")).alias("title"), F.concat_ws("; ", "authors").alias("authors"), _or_blank(F.col("source_url")).alias("paper_url"),
            _or_blank(F.col("repository")).alias("github_url"), F.col("stars").alias("github_stars"), _or_blank(F.col("published_date")).alias("published_date"),
        ],
    }
    return records.where(F.col("kind") == kind).orderBy("id").select(*base, *more.get(kind, []))


def startups_tab(records: DataFrame, seed: DataFrame) -> DataFrame:
    df = resolve(records.where("kind = 'STARTUP'"), seed, name="name", address="source_url")
    return df.orderBy("id").select(
        _or_blank(F.col("canonical_entity_id")).alias("canonicalId"), _or_blank(F.col("canonical_entity_name")).alias("canonicalName"), F.col("name").alias("rawEntityName"),
        _or_blank(F.col("employees")).alias("employeeCount"), F.col("source_name").alias("sourceName"), F.col("source_url").alias("sourceUrl"),
        F.col("collected_at").alias("collectedAt"), F.col("match_strategy").alias("matchStrategy"), "confidence",
    )


def products_tab(records: DataFrame, seed: DataFrame) -> DataFrame:
    df = resolve(records.where("kind = 'PRODUCT'"), seed, name="name", address="source_url")
    return df.orderBy("id").select(
        F.col("name").alias("startupName"), _or_blank(F.col("canonical_entity_id")).alias("canonicalStartupId"), _or_blank(F.col("canonical_entity_name")).alias("canonicalStartupName"),
        _or_blank(F.col("pricing")).alias("pricingModel"), F.col("source_name").alias("sourceName"), F.col("source_url").alias("sourceUrl"),
        F.col("collected_at").alias("collectedAt"), F.col("match_strategy").alias("matchStrategy"), "confidence",
    )


def papers_tab(records: DataFrame) -> DataFrame:
    df = records.where("kind = 'RESEARCH_PAPER'").orderBy("id")
    return df.select(
        F.col("name").alias("title"), F.concat_ws("; ", "authors").alias("authors"), F.col("source_url").alias("paper_url"), _or_blank(F.col("repository")).alias("github_url"), _or_blank(F.col("stars")).alias("github_stars"),
        F.when(F.col("stars").isNotNull(), F.col("collected_at")).otherwise(F.lit("")).alias("github_stars_retrieved_at"), _or_blank(F.col("published_date")).alias("published_date"), F.col("source_name").alias("sourceName"), F.col("collected_at").alias("collectedAt"),
    )


def jobs_tab(jobs: DataFrame) -> DataFrame:
    """Newest first, ties by id."""
    return jobs.orderBy(F.desc("ingested_at"), "id").select(
        "id", "company", "title", _or_blank(F.col("location")).alias("location"), _or_blank(F.col("employment_type")).alias("employmentType"), _or_blank(F.col("salary")).alias("salary"), _or_blank(F.col("published_at")).alias("publishedAt"),
        F.col("freshness_decision").alias("freshnessDecision"), F.col("source_id").alias("sourceId"), F.col("canonical_url").alias("canonicalUrl"), F.col("ingested_at").cast("string").alias("collectedAt"),
    )


def news_tab(news: DataFrame) -> DataFrame:
    """Newest first, ties by id; without a summary the first 200 characters of the text take its place."""
    summary = F.coalesce(F.nullif(F.col("summary"), F.lit("")), F.left("full_text", F.lit(200)))
    return news.orderBy(F.desc("ingested_at"), "id").select(
        "id", "title", _or_blank(F.col("author")).alias("author"), _or_blank(F.col("published_at")).alias("publishedAt"), F.col("freshness_decision").alias("freshnessDecision"), F.col("source_id").alias("sourceId"),
        F.col("canonical_url").alias("canonicalUrl"), F.translate(summary, "\n", " ").alias("summary"), F.col("ingested_at").cast("string").alias("collectedAt"),
    )


def mapping_log(records: DataFrame, seed: DataFrame, at: Column) -> DataFrame:
    """What the resolver made of each startup and product; a run replaces the log of the last."""
    df = resolve(records.where("kind IN ('STARTUP', 'PRODUCT') AND coalesce(name, '') != ''"), seed, name="name", address="source_url")
    return df.orderBy("id").select(
        F.concat("kind", F.lit(":"), F.col("id").cast("string")).alias("sourceRecordId"), F.col("name").alias("rawEntityName"), F.col("normalized_entity_name").alias("normalizedEntityName"),
        _or_blank(F.col("canonical_entity_id")).alias("canonicalEntityId"), _or_blank(F.col("canonical_entity_name")).alias("canonicalEntityName"), F.col("match_strategy").alias("matchStrategy"), "confidence",
        F.to_json("aliases_used").alias("aliasesUsed"), F.to_json("domains_used").alias("domainsUsed"), F.col("resolver_version").alias("resolverVersion"), at.cast("string").alias("timestamp"), _or_blank(F.col("unresolved_reason")).alias("unresolvedReason"),
    )


def tab_counts(tabs: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tabs.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("tab"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def write_csv(df: DataFrame, path: str, *, note_if_empty: bool = True) -> None:
    """Part files with a header each; an empty tab is a file that says so (or, without the note, no line at all)."""
    if df.isEmpty():
        spark = df.sparkSession
        empty = spark.createDataFrame([(EMPTY_NOTE,)], "status string") if note_if_empty else spark.createDataFrame([], "status string")
        empty.coalesce(1).write.mode("overwrite").option("header", note_if_empty).csv(path)
    else:
        df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path, ignoreNullFields=False)


def write_json_array(df: DataFrame, order: str, path: str) -> None:
    """Text parts that, one after another, are one JSON array."""
    json_lines(df, order).orderBy("place", "key", "value").select("value").write.mode("overwrite").text(path)


def json_lines(df: DataFrame, order: str) -> DataFrame:
    """place, key and value: the lines of a JSON array, which are in order by these three columns.

    Rows come in order, null first and ties by their text, with a comma before each but the first. Which row is the first is
    a minimum, so rows needn't be numbered; rows that equal it are written from their count.
    """
    rows = df.select(F.col(order).alias("key"), F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("line"))
    first = rows.groupBy("key", "line").agg(F.count("*").alias("n")).agg(F.min(F.struct("key", "line", "n")).alias("first")).where("first IS NOT NULL").select("first.*")
    opened = first.select(F.lit(1).alias("place"), "key", F.concat(F.lit("  "), "line").alias("value"))
    same = first.select(F.lit(2).alias("place"), "key", F.explode(F.array_repeat(F.concat(F.lit("  ,"), "line"), (F.col("n") - 1).cast("int"))).alias("value"))
    one = first.select(F.col("key").alias("key_"), F.col("line").alias("line_"))
    rest = rows.join(F.broadcast(one), F.col("key").eqNullSafe(F.col("key_")) & (F.col("line") == F.col("line_")), "left_anti")
    kind = df.schema[order].dataType.simpleString()
    frame = df.sparkSession.createDataFrame([(0, None, "["), (3, None, "]")], f"place int, key {kind}, value string")
    return opened.union(same).union(rest.select(F.lit(2), "key", F.concat(F.lit("  ,"), "line"))).union(frame)


def write_workbook(tabs: dict[str, DataFrame], path: str) -> DataFrame:
    """A folder of CSVs, one for each tab, and how many rows each has. Spreadsheet files and services are left to their own tools."""
    for name, df in tabs.items():
        write_csv(df, f"{path}/{name.lower().replace(' ', '_')}")
    return tab_counts(tabs)
