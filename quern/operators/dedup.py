"""Content hashes, first arrivals, insert-if-new and upserts.

Uniqueness, which a store would keep by a constraint, is a step here: first arrivals by a grouped minimum (a map-side
combine, so that a hash with very many rows shuffles one row a task), then an anti-join against the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.urls import canonical_url, stripped


def record_hash(kind: Column, name: Column, url: Column, pricing: Column | None = None) -> Column:
    """sha256 of what makes a record the same record; what changes with time is left out. Null for kinds without a rule."""
    title, address = F.lower(stripped(name)), canonical_url(url)
    priced = F.lit("") if pricing is None else F.coalesce(pricing, F.lit(""))
    text = (
        F.when(kind == "STARTUP", F.concat(F.lit("STARTUP:"), title, F.lit(":"), address))
        .when(kind == "PRODUCT", F.concat(F.lit("PRODUCT:"), title, F.lit(":"), priced, F.lit(":"), address))
        .when(kind == "RESEARCH_PAPER", F.concat(F.lit("PAPER:"), title, F.lit(":"), address))
    )
    return F.sha2(text, 256)


def signal_hash(source_id: Column, title: Column, canonical: Column) -> Column:
    """sha256 of source, title and address; the body isn't part of it."""
    return F.sha2(F.concat(source_id, F.lit(":"), F.lower(stripped(title)), F.lit(":"), canonical), 256)


def keep_first(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key by the order, ties by all columns; rows with a null key are one key."""
    rest = [c for c in df.columns if c != key]
    ordered = F.struct(*(F.col(c) for c in order), F.to_json(F.struct(*df.columns)).alias("_tie_"))
    first = df.groupBy(key).agg(F.min_by(F.struct(*rest), ordered).alias("_first_"))
    return first.select(*(F.col(key) if c == key else F.col(f"_first_.`{c}`").alias(c) for c in df.columns))


def insert_if_new(batch: DataFrame, target: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The rows of a batch to append: first arrivals whose key the target doesn't hold."""
    return keep_first(batch, key, order).join(target.select(key).distinct(), key, "left_anti")


def change_only(batch: DataFrame, seen: DataFrame, url: str, text: str) -> DataFrame:
    """The rows of a batch whose address and text together weren't seen before."""
    of = lambda df: df.withColumn("_print_", F.sha2(F.concat_ws("\n", F.col(url), F.col(text)), 256))
    return of(batch).join(of(seen).select("_print_").distinct(), "_print_", "left_anti").drop("_print_")


#: Columns that an update of a known item leaves as they were.
KEPT = ("id", "first_seen_at", "ingested_at", "canonical_url")


def upsert(target: DataFrame, batch: DataFrame, *, keys: tuple[str, ...] = ("source_id", "canonical_url_hash"), unique: str = "content_hash", order: tuple[str, ...] = ("ingested_at",), kept: tuple[str, ...] = KEPT) -> DataFrame:
    """The target after a batch.

    A row of the batch whose keys the target has updates it, but for the kept columns. One whose keys are new but whose
    unique column the target has is skipped. Others are inserted. Of several rows of the same keys the last holds.
    """
    rest = [c for c in batch.columns if c not in keys]
    ordered = F.struct(*(F.col(c) for c in order), F.to_json(F.struct(*batch.columns)))
    last = batch.groupBy(*keys).agg(F.max_by(F.struct(*rest), ordered).alias("_n_"))
    both = target.join(last, list(keys), "full_outer").withColumn("_known_", F.col(f"`{unique}`").isNotNull())
    updated = both.where("_known_").select(
        *(F.col(c) if c in keys or c in kept or c not in rest else F.when(F.col("_n_").isNotNull(), F.col(f"_n_.`{c}`")).otherwise(F.col(f"`{c}`")).alias(c) for c in target.columns)
    )
    new = both.where("NOT _known_").select(*(F.col(c) if c in keys else F.col(f"_n_.`{c}`").alias(c) for c in target.columns))
    # Two new rows of one unique value: the first by key stays, as the second would meet it in the store.
    new = keep_first(new.join(target.select(unique).distinct(), unique, "left_anti").select(*target.columns), unique, list(keys))
    return updated.unionByName(new)
