"""Inputs beside payloads: lists of sources, and documents from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_sources(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The sources of a JSON file, which must be one array. It is a configuration file, so it is read as a whole."""
    whole = spark.read.text(path, wholetext=True)
    if whole.where(F.coalesce(F.startswith(F.ltrim("value"), F.lit("[")), F.lit(False)) & F.try_parse_json("value").isNotNull()).count() != whole.count():
        raise ValueError(f"{path} must hold a JSON array of sources")
    return whole.select(F.explode(F.from_json("value", f"array<struct<{schema}>>")).alias("s")).select("s.*")


def selected_sources(sources: DataFrame, ids: list[str] | None = None, kind: str | None = None) -> DataFrame:
    """Those of the ids, if any are given, and of these those of the type, if one is given."""
    if ids:
        sources = sources.where(F.col("id").isin(*ids))
    return sources.where(F.col("type") == kind) if kind else sources


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """path, text and is_html of each file of a folder: markup by its name's end or by how the text begins."""
    df = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))
    return df.withColumn("is_html", F.col("path").rlike(r"(?i)\.html?$") | F.startswith(F.ltrim("text"), F.lit("<")))
