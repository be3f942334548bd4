"""From payloads to new valid records: parse, validate, hash, keep first arrivals that the target lacks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.operators.dedup import insert_if_new, record_hash
from quern.operators.validate import validated


def ingest(parsed: list[DataFrame], target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New records of all parsed sources, and the quarantine. target: the records that are there, with content_hash."""
    records = parsed[0]
    for df in parsed[1:]:
        records = records.unionByName(df, allowMissingColumns=True)
    good, bad = validated(records)
    hashed = good.withColumn("content_hash", record_hash(F.col("kind"), F.col("name"), F.col("source_url"), F.col("pricing")))
    return insert_if_new(hashed, target, "content_hash", ["source_name", "source_url"]), bad
