"""Counts, run summaries and compliance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.operators.freshness import is_accepted

RECORD_TYPES = ("STARTUP", "PRODUCT", "RESEARCH_PAPER", "NEWS", "JOB")


def counts_of(df: DataFrame, column: str, values: tuple[str, ...] = RECORD_TYPES) -> DataFrame:
    """A row for each value, with 0 for those that don't occur; other values of the column aren't counted."""
    every = df.sparkSession.createDataFrame([(v,) for v in values], f"`{column}` string")
    counted = df.groupBy(column).agg(F.count("*").alias("n"))
    return every.join(counted, column, "left").select(column, F.coalesce("n", F.lit(0)).alias("n"))


def counts_with_total(df: DataFrame, column: str) -> DataFrame:
    """Groups and their counts, and a row with a null group for all."""
    return df.rollup(column).agg(F.count("*").alias("n"), F.grouping(column).cast("int").alias("is_total"))


def run_status(fetched: Column, accepted: Column, errors: Column) -> Column:
    return F.when(errors == 0, F.lit("SUCCESS")).when((fetched > 0) & (accepted > 0), F.lit("PARTIAL")).otherwise(F.lit("FAILED"))


def run_summary(outcomes: DataFrame) -> DataFrame:
    """A row for each source of outcomes (source_id, outcome): an outcome is a decision, robots_txt_disallowed or error.

    An item that robots forbid is rejected without a fetch; an error is fetched in vain and neither.
    """
    robots, error = F.col("outcome") == "robots_txt_disallowed", F.col("outcome") == "error"
    accepted = is_accepted(F.col("outcome"))
    df = outcomes.groupBy("source_id").agg(
        F.count("*").alias("candidates_discovered"), F.count_if(~robots & ~error).alias("candidates_fetched"), F.count_if(accepted).alias("accepted_count"),
        F.count_if(~accepted & ~error).alias("rejected_count"), F.count_if(error).alias("error_count"),
    )
    return df.withColumn("status", run_status(F.col("candidates_fetched"), F.col("accepted_count"), F.col("error_count")))


def run_history(history: DataFrame, summaries: DataFrame, started_at: Column, completed_at: Column) -> DataFrame:
    """The history of runs and a row for each of summaries: run_id (of source and start), source_id, status, both times and the
    summary as JSON. A run that is there already stays as it is, so that a repeated append does no harm."""
    run_id = F.sha2(F.concat_ws("|", "source_id", started_at.cast("string")), 256)
    new = summaries.select(run_id.alias("run_id"), "source_id", "status", started_at.alias("started_at"), completed_at.alias("completed_at"), F.to_json(F.struct(*summaries.columns)).alias("summary_json"))
    return history.unionByName(new.join(history.select("run_id"), "run_id", "left_anti"))


def rejection_breakdown(outcomes: DataFrame) -> DataFrame:
    """source_id and a map from the reason of a rejection to its count, built from one row for each reason."""
    rejected = outcomes.where(~is_accepted(F.col("outcome")) & (F.col("outcome") != "error"))
    each = rejected.groupBy("source_id", "outcome").agg(F.count("*").cast("int").alias("n"))
    return each.groupBy("source_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("outcome", "n")))).alias("rejection_breakdown"))


def totals(summaries: DataFrame) -> DataFrame:
    names = ("candidates_discovered", "candidates_fetched", "accepted_count", "rejected_count", "error_count")
    return summaries.agg(F.count("*").alias("sources"), *(F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in names))


def compliance(df: DataFrame, kind: str, valid: Column) -> DataFrame:
    return df.groupBy(kind).agg(F.count_if(valid).alias("valid"), F.count("*").alias("total")).withColumn("ratio", F.col("valid") / F.col("total"))


def first_of_each(df: DataFrame, kind: str, order: str) -> DataFrame:
    """The row of the least order of each kind."""
    return df.groupBy(kind).agg(F.min_by(F.struct(*[c for c in df.columns if c != kind]), F.col(order)).alias("_r_")).select(kind, "_r_.*")
