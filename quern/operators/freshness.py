"""The freshness gate, the state that it reads, and what a run leaves behind for the next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.operators.small import broadcast_if_small

# The window, the clock skew, the grace before the last success, the last place that counts as recent,
# the confidence of an inferred item, and how many hashes a snapshot keeps.
WINDOW_HOURS, SKEW_MINUTES, GRACE_MINUTES, LAST_PLACE, INFERRED, SNAPSHOT = 24, 15, 5, 25, 0.65, 5000
ACCEPTED = ("accepted_verified", "accepted_inferred")


def _minutes(n: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(n))


def gate_dated(published: Column, reference: Column, *, hours: int = WINDOW_HOURS, skew: int = SKEW_MINUTES) -> Column:
    """accepted_verified from reference - hours to reference + skew, both included; else rejected_stale; null if undated."""
    fresh = (published <= reference + _minutes(skew)) & (published >= reference - _minutes(60 * hours))
    return F.when(published.isNull(), F.lit(None).cast("string")).when(fresh, F.lit("accepted_verified")).otherwise(F.lit("rejected_stale"))


def is_future(published: Column, reference: Column, *, skew: int = SKEW_MINUTES) -> Column:
    """Whether a date lies further ahead than clocks may differ; null if undated."""
    return published > reference + _minutes(skew)


def freshness(published: Column, confidence: Column, method: Column, reference: Column, *, last_success: Column, seen: Column, first_seen: Column, position: Column, hours: int = WINDOW_HOURS, skew: int = SKEW_MINUTES) -> Column:
    """A struct of decision, published_at, confidence and method.

    An undated item is accepted as inferred only if there was a successful run, its snapshot doesn't hold the item, the
    item wasn't first seen before that run, and its place on the listing (from 0) is LAST_PLACE or less.
    """

    def outcome(decision: Column | str, at: Column, score: Column | float, how: Column | str) -> Column:
        lit = lambda x: x if isinstance(x, Column) else F.lit(x)
        return F.struct(lit(decision).alias("decision"), at.cast("timestamp").alias("published_at"), lit(score).cast("double").alias("confidence"), lit(how).alias("method"))

    unknown = lambda how: outcome("rejected_unknown", F.lit(None), 0.0, how)
    return (
        F.when(published.isNotNull(), outcome(gate_dated(published, reference, hours=hours, skew=skew), published, confidence, method))
        .when(last_success.isNull(), unknown("heuristic_missing_baseline"))
        .when(F.coalesce(seen, F.lit(False)), unknown("heuristic_previously_observed"))
        .when(F.coalesce(first_seen, reference) < last_success - _minutes(GRACE_MINUTES), unknown("heuristic_stale_first_seen"))
        .when(position > LAST_PLACE, unknown("heuristic_deep_listing_position"))
        .otherwise(outcome("accepted_inferred", F.lit(None), INFERRED, "heuristic_stateful_new_since_last_run"))
    )


def gate(items: DataFrame, state: DataFrame, reference: Column) -> DataFrame:
    """items with freshness_decision, published_at, published_at_confidence and date_extraction_method.

    items: source_id, url_hash, content_hash, published_at, published_at_confidence, date_extraction_method, position,
    first_seen_at. state: source_id, last_successful_crawl_at, observed (array of hashes). The snapshot is exploded and joined
    on the hash, so its size is never searched row by row.
    """
    last = state.select("source_id", F.col("last_successful_crawl_at").alias("_last_"))
    hashes = state.select("source_id", F.explode("observed").alias("_hash_")).distinct().withColumn("_seen_", F.lit(True))
    of = lambda kind: broadcast_if_small(hashes.select(F.col("source_id"), F.col("_hash_").alias(kind), F.col("_seen_").alias(f"_seen_{kind}_")))
    df = items.join(broadcast_if_small(last), "source_id", "left")
    df = df.join(of("url_hash"), ["source_id", "url_hash"], "left").join(of("content_hash"), ["source_id", "content_hash"], "left")
    seen = F.col("_seen_url_hash_").isNotNull() | F.col("_seen_content_hash_").isNotNull()
    result = freshness(F.col("published_at"), F.col("published_at_confidence"), F.col("date_extraction_method"), reference, last_success=F.col("_last_"), seen=seen, first_seen=F.col("first_seen_at"), position=F.col("position"))
    changed = {"published_at": "published_at", "published_at_confidence": "confidence", "date_extraction_method": "method"}
    return df.withColumn("_f_", result).select(*(F.col(f"_f_.{changed[c]}").alias(c) if c in changed else F.col(c) for c in items.columns), F.col("_f_.decision").alias("freshness_decision"))


def is_accepted(decision: Column) -> Column:
    return decision.isin(*ACCEPTED)


def next_state(state: DataFrame, gated: DataFrame, runs: DataFrame) -> DataFrame:
    """The state after a run. runs: source_id, status, started_at, completed_at.

    Each attempt moves the attempt mark. Only a SUCCESS moves the success mark, and then the snapshot becomes the hashes of
    the items that this run accepted (empty, if there are none): the SNAPSHOT least ones by value.
    """
    accepted = gated.where(is_accepted(F.col("freshness_decision")))
    hashes = accepted.select("source_id", F.explode(F.array("url_hash", "content_hash")).alias("h"))
    observed = hashes.groupBy("source_id").agg(F.slice(F.array_sort(F.collect_set("h")), 1, SNAPSHOT).alias("_observed_"))
    firsts = accepted.groupBy("source_id").agg(F.count("*").alias("_n_"), F.min_by("canonical_url", F.struct("position", "canonical_url")).alias("_boundary_"))
    df = state.join(runs, "source_id", "full_outer").join(observed, "source_id", "left").join(firsts, "source_id", "left")
    won = F.coalesce(F.col("status") == "SUCCESS", F.lit(False))
    return df.select(
        "source_id",
        F.when(won, F.col("completed_at")).otherwise(F.col("last_successful_crawl_at")).alias("last_successful_crawl_at"),
        F.coalesce("started_at", "last_attempted_crawl_at").alias("last_attempted_crawl_at"),
        F.when(won, F.coalesce("_boundary_", "last_boundary_item_id")).otherwise(F.col("last_boundary_item_id")).alias("last_boundary_item_id"),
        F.when(won, F.coalesce("_observed_", F.array().cast("array<string>"))).otherwise(F.coalesce("observed", F.array().cast("array<string>"))).alias("observed"),
        (F.coalesce("total_ingested", F.lit(0)) + F.when(won, F.coalesce("_n_", F.lit(0))).otherwise(F.lit(0))).cast("bigint").alias("total_ingested"),
    )


def merge_checkpoints(offsets: DataFrame, batch: DataFrame) -> DataFrame:
    """adapter_name, last_offset and total_collected after a batch of (adapter_name, offset, saved, at): the last offset holds,
    the totals add up; rows without an offset leave no mark."""
    new = batch.where("offset IS NOT NULL").groupBy("adapter_name").agg(F.max_by("offset", "at").alias("_offset_"), F.sum("saved").alias("_saved_"))
    both = offsets.join(new, "adapter_name", "full_outer")
    return both.select("adapter_name", F.coalesce("_offset_", "last_offset").alias("last_offset"), (F.coalesce("total_collected", F.lit(0)) + F.coalesce("_saved_", F.lit(0))).cast("bigint").alias("total_collected"))


def single_flight(requests: DataFrame, running: DataFrame) -> DataFrame:
    """Requests of a source that runs already, or that an earlier request of the batch starts, get SKIPPED_LOCKED."""
    first = requests.groupBy("source_id").agg(F.min("request_id").alias("_first_"))
    df = requests.join(first, "source_id").join(broadcast_if_small(running.select("source_id").distinct().withColumn("_busy_", F.lit(True))), "source_id", "left")
    free = F.col("_busy_").isNull() & (F.col("request_id") == F.col("_first_"))
    return df.select(*requests.columns, F.when(free, F.lit("STARTED")).otherwise(F.lit("SKIPPED_LOCKED")).alias("status"))
