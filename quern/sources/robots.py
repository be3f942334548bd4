"""The robots filter: rules of hosts as a table, joined by origin and asked for each address."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.operators.small import broadcast_if_small


def allowed(urls: DataFrame, rules: DataFrame, agent: str, *, url: str = "url") -> DataFrame:
    """urls with the column allowed. rules: origin (scheme://host), status, body. No rules, or a status other than 200, allow."""
    origin = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1))
    df = urls.withColumn("_origin_", origin).join(broadcast_if_small(rules.where("status = 200").select(F.lower("origin").alias("_origin_"), F.col("body").alias("_body_"))), "_origin_", "left")

    @F.pandas_udf("boolean")
    def ask(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        parsers: dict[str, RobotFileParser] = {}

        def one(address: str | None, body: str | None) -> bool:
            if body is None or address is None:
                return True
            if body not in parsers:
                parsers[body] = RobotFileParser()
                parsers[body].parse(body.splitlines())
            try:
                return parsers[body].can_fetch(agent, address)
            except ValueError:  # a malformed address: nothing forbids it
                return True

        for addresses, bodies in parts:
            yield pd.Series([one(a, b) for a, b in zip(addresses, bodies, strict=True)], dtype=bool)

    return df.withColumn("allowed", ask(F.col(url), F.col("_body_"))).drop("_origin_", "_body_")
