"""Streams: first arrivals, the gate with state by source, and token buckets.

Each is a DataFrame to DataFrame function of a streaming frame; sinks and checkpoints are the caller's. Business state
(the last success, the snapshot) is kept by source in the stream's state store, next to Spark's own watermark.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quern.operators.freshness import LAST_PLACE, gate_dated


def first_arrivals(stream: DataFrame, key: str, at: str, delay: str = "1 day") -> DataFrame:
    """The first arrival of each key; keys are forgotten once the watermark has passed them."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def gated(stream: DataFrame, published: str, reference: Column) -> DataFrame:
    """The dated gate: rows keep their columns and get freshness_decision, rejects too."""
    return stream.withColumn("freshness_decision", F.coalesce(gate_dated(F.col(published), reference), F.lit("rejected_unknown")))


def undated_gate(stream: DataFrame) -> DataFrame:
    """The undated gate over runs that come as a stream: source_id, run_at (timestamp), url_hash, position (int).

    A run's items are judged by the run before it: the first is the baseline and rejects all; an item that the last run
    accepted is known; items beyond the last place are rejected. The snapshot is the last run's accepted items only. Runs of a
    source are taken in order of run_at. A run may come in several micro-batches: the state holds what the run before it accepted
    beside what it has accepted so far, so decisions don't depend on where it was cut. Items of a run that is older than the last
    are late and rejected as stale.
    """

    def judge(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, known, before = state.get if state.exists else (None, [], None)
        items = pd.concat(list(frames)).sort_values(["run_at", "position", "url_hash"])
        for run_at, run in items.groupby("run_at"):
            moment = int(run_at.timestamp() * 1e6)
            if last is None or moment > last:
                last, known, before = moment, [], None if last is None else known
            seen = set(before or [])
            out = []
            for r in run.itertuples(index=False):
                if moment < last:
                    how = "heuristic_stale_first_seen"
                elif before is None:
                    how = "heuristic_missing_baseline"
                elif r.url_hash in seen:
                    how = "heuristic_previously_observed"
                elif r.position > LAST_PLACE:
                    how = "heuristic_deep_listing_position"
                else:
                    how = "heuristic_stateful_new_since_last_run"
                out.append((key[0], run_at, r.url_hash, r.position, "accepted_inferred" if how.endswith("last_run") else "rejected_unknown", how))
            known = [*known, *(o[2] for o in out if o[4] == "accepted_inferred")]
            yield pd.DataFrame(out, columns=["source_id", "run_at", "url_hash", "position", "decision", "method"])
        state.update((last, known, before))

    schema = "source_id string, run_at timestamp, url_hash string, position int, decision string, method string"
    return stream.select("source_id", "run_at", "url_hash", "position").groupBy("source_id").applyInPandasWithState(judge, schema, "last bigint, known array<string>, before array<string>", "append", GroupStateTimeout.NoTimeout)


def bucket(stream: DataFrame, key: str, at: str, *, rate: float = 5.0, burst: float = 10.0) -> DataFrame:
    """key, t (seconds), allowed: a token bucket by key whose state outlives micro-batches. Arrivals are taken in order of
    time within a batch; one that is earlier than the last gets no tokens back."""

    def take(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tokens, last = state.get if state.exists else (burst, None)
        items = pd.concat(list(frames)).sort_values("t")
        out = []
        for t in items["t"]:
            tokens = min(burst, tokens + max(0.0, t - (t if last is None else last)) * rate)
            last = t if last is None else max(last, t)
            ok = tokens >= 1.0
            tokens -= ok
            out.append((k[0], t, ok))
        state.update((tokens, last))
        yield pd.DataFrame(out, columns=["key", "t", "allowed"])

    own = stream.select(F.col(key).cast("string").alias("key"), (F.unix_micros(at) / F.lit(1e6)).alias("t"))
    return own.groupBy("key").applyInPandasWithState(take, "key string, t double, allowed boolean", "tokens double, last double", "append", GroupStateTimeout.NoTimeout)


def work_folder(spark: SparkSession) -> str:
    """A new folder for state and results where driver and executors meet: under spark.checkpoint.dir, or a temporary one if
    that is unset and the session is local, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    base = base or f"file://{tempfile.gettempdir()}"
    return f"{base.rstrip('/')}/quern-stream-{uuid.uuid4().hex[:12]}"


def run_to_end(stream: DataFrame, name: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """All that is there now, through the stream and into a parquet table beside the checkpoint."""
    out = f"{checkpoint}/{name}-out"
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{checkpoint}/{name}-state").outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)
