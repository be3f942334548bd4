"""Token buckets and pacing, simulated over arrivals.

A bucket is a fold over a key's arrivals in time order. Arrivals come sorted to the task, batch by batch, and only the
bucket's state is kept, so a key of any size runs in constant memory. A bucket's answer depends on all before it: a key is
one task, and keys are dealt over tasks. Times are whole microseconds.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RATE, BURST, SPACING = 5.0, 10.0, 0.2


def _folded(arrivals: DataFrame, key: str, at: str, tie: str, schema: str, fold) -> DataFrame:
    own = arrivals.select(F.col(key).cast("string").alias("key"), F.unix_micros(F.col(at).cast("timestamp")).alias("t"), F.col(tie).cast("bigint").alias("id"))
    return own.repartition("key").sortWithinPartitions("key", "t", "id").mapInPandas(fold, schema)


def token_bucket(arrivals: DataFrame, key: str, at: str, tie: str, *, rate: float = RATE, burst: float = BURST) -> DataFrame:
    """key, id, t, allowed and tokens left: a token comes back every 1 / rate seconds, up to burst; an arrival takes one."""

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Millionths of tokens and microseconds: sums of whole numbers stay exact.
        current, full, tokens, last = None, burst * 1e6, 0.0, 0
        for frame in frames:
            allowed, left = [], []
            for k, t in zip(frame["key"], frame["t"], strict=True):
                if current is None or k != current[0]:
                    current, tokens, last = (k,), full, t
                tokens, last = min(full, tokens + (t - last) * rate), t
                ok = tokens >= 1e6
                tokens -= 1e6 * ok
                allowed.append(ok)
                left.append(tokens / 1e6)
            yield frame.assign(t=frame["t"] / 1e6, allowed=allowed, tokens=left)[["key", "id", "t", "allowed", "tokens"]]

    return _folded(arrivals, key, at, tie, "key string, id bigint, t double, allowed boolean, tokens double", fold)


def pacing(arrivals: DataFrame, key: str, at: str, tie: str, *, spacing: float = SPACING) -> DataFrame:
    """key, id, t and starts: when each request may start, if a host's requests stand that many seconds apart at least."""

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, free, step = None, 0, round(spacing * 1e6)
        for frame in frames:
            starts = []
            for k, t in zip(frame["key"].tolist(), frame["t"].tolist(), strict=True):
                if current is None or k != current[0]:
                    current, free = (k,), t
                begins = max(t, free)
                free = begins + step
                starts.append(begins / 1e6)
            yield frame.assign(t=frame["t"] / 1e6, starts=starts)[["key", "id", "t", "starts"]]

    return _folded(arrivals, key, at, tie, "key string, id bigint, t double, starts double", fold)
