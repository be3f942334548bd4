"""Partial records of one thing made into one: the richer value of each field holds.

``consolidate`` folds JSON objects of any shape in their order. It runs group by group in Python, batch after batch, and
keeps only the merged object of the group. ``consolidate_typed`` does the same for known fields by plain aggregates.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.urls import stripped


def says_nothing(value) -> bool:
    """Null, blank or empty; zero and false say something."""
    return value is None or (isinstance(value, str) and not value.strip()) or (isinstance(value, (list, dict)) and not value)


def richer(a, b):
    """The value to keep of an earlier and a later one."""
    if says_nothing(b):
        return a
    if says_nothing(a):
        return b
    number = lambda x: isinstance(x, (int, float)) and not isinstance(x, bool)
    if isinstance(a, dict) and isinstance(b, dict):
        return merged(a, b)
    if isinstance(a, list) and isinstance(b, list):
        text = lambda x: json.dumps(x, separators=(",", ":")) if isinstance(x, (dict, list)) or x is None or isinstance(x, bool) else str(x)
        first: dict = {}
        for x in [*a, *b]:
            first.setdefault(text(x), x)
        return list(first.values())
    if number(a) and number(b):
        return b if a == 0 < b else a if b == 0 < a else max(a, b)
    if isinstance(a, str) and isinstance(b, str):
        return b if len(b.strip()) > len(a.strip()) else a
    return b


def merged(a: dict, b: dict) -> dict:
    return a | {k: richer(a[k], v) if k in a else v for k, v in b.items()}


def consolidate(parts: DataFrame, key: str, order: str, column: str) -> DataFrame:
    """key, the merged object as JSON, and how many objects there were; what is no JSON object is passed over."""

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state, n, done = None, None, 0, []

        def out() -> dict:
            return {"key": current[0], "merged": json.dumps(state, ensure_ascii=False, separators=(",", ":")), "n": n}

        for frame in frames:
            for k, text in zip(frame["key"], frame["part"], strict=True):
                try:
                    value = json.loads(text) if text else None
                except ValueError:
                    value = None
                if current is not None and k != current[0]:
                    if n:
                        done.append(out())
                    state, n = None, 0
                current = (k,)
                if isinstance(value, dict):
                    state, n = value if state is None else merged(state, value), n + 1
            if done:
                yield pd.DataFrame(done)
                done = []
        if n:
            yield pd.DataFrame([out()])

    own = parts.select(F.col(key).cast("string").alias("key"), F.col(order).alias("place"), F.col(column).alias("part"))
    sorted_parts = own.repartition("key").sortWithinPartitions("key", "place", "part").select("key", "part")
    return sorted_parts.mapInPandas(fold, "key string, merged string, n bigint").withColumnRenamed("key", key)


def longest(text: Column, order: Column) -> Column:
    """The longest text by trimmed length, the first of equals; blank ones lose."""
    said = F.when(stripped(text) != "", text)
    return F.max_by(said, F.when(said.isNotNull(), F.struct(F.length(stripped(text)), -order)))


def all_items(items: Column, order: Column) -> Column:
    """All distinct items of arrays, in order of their first place."""
    return F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), items.alias("i")))), lambda s: s["i"])))


def consolidate_typed(parts: DataFrame, key: str, order: str, *, texts: tuple[str, ...] = (), numbers: tuple[str, ...] = (), arrays: tuple[str, ...] = ()) -> DataFrame:
    at = F.col(order)
    return parts.groupBy(key).agg(
        *(longest(F.col(c), at).alias(c) for c in texts), *(F.max(c).alias(c) for c in numbers), *(all_items(F.col(c), at).alias(c) for c in arrays), F.count("*").alias("n")
    )
