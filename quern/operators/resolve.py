"""Deterministic resolution of organisation names: six tiers of equality, never a guess.

The seed is exploded into one lookup for each tier, keyed by what the tier compares. Records meet each lookup by a left
join (broadcast while the seed is small), and the first tier that knows the record decides, so that no record is
compared with each entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.names import entity_name, significant_words
from quern.functions.urls import domain, stripped
from quern.operators.small import MOST_ROWS

VERSION = "1.0.0"
SEED = "canonical_id string, canonical_name string, verified_aliases array<string>, normalized_aliases array<string>, official_domains array<string>"
#: Confidence by tier.
TIERS = {"domain": 1.0, "name": 1.0, "alias": 1.0, "normalized_name": 0.99, "normalized_alias": 0.98, "words_of_name": 0.90, "words_of_alias": 0.88}


def _entity() -> Column:
    return F.struct("canonical_id", "canonical_name")


def lookups(seed: DataFrame, *, prepared_aliases: bool = True, unicode_words: bool = True) -> dict[str, DataFrame]:
    """For each tier a table of key and its entities (several make it ambiguous). Of equal names or domains the last id holds."""
    said = lambda kind, text, place: F.struct(F.lit(kind).alias("kind"), text.alias("text"), place.cast("int").alias("place"))
    spellings = [F.array(said("name", F.col("canonical_name"), F.lit(-1))), F.transform("verified_aliases", lambda a, i: said("alias", a, i))]
    if prepared_aliases:
        spellings.append(F.transform("normalized_aliases", lambda a, i: said("prepared", a, i)))
    names = seed.select(_entity().alias("e"), F.explode(F.concat(*spellings)).alias("s")).select("e", "s.*")
    names = names.withColumn("low", F.lower(stripped(F.col("text")))).withColumn("normal", entity_name(F.col("text"), unicode_words=unicode_words))
    words = names.where("kind != 'prepared'").withColumn("words", F.array_join(significant_words(F.col("normal")), " "))
    score = F.when(F.col("kind") == "name", F.lit(TIERS["words_of_name"])).otherwise(F.lit(TIERS["words_of_alias"]))
    best = words.where("words != ''").groupBy(F.col("words").alias("key"), "e").agg(F.max_by(F.struct(score.alias("score"), F.col("text").alias("alias")), F.struct(score, -F.col("place"))).alias("b"))
    hosts = seed.select(_entity().alias("e"), F.explode("official_domains").alias("d")).select(domain(F.col("d")).alias("key"), "e").where("key != ''")
    last = lambda df: df.groupBy("key").agg(F.array(F.max("e")).alias("found"))
    every = lambda df: df.groupBy("key").agg(F.array_sort(F.collect_set("e")).alias("found"))
    keyed = lambda key, *kinds: names.where(F.col("kind").isin(*kinds) & (F.col(key) != "")).select(F.col(key).alias("key"), "e")
    return {
        "domain": last(hosts),
        "name": last(keyed("low", "name")),
        "alias": every(keyed("low", "alias")),
        "normalized_name": last(keyed("normal", "name")),
        "normalized_alias": every(keyed("normal", "alias", "prepared")),
        "words": best.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("e", "b"))).alias("found")),
    }


def resolve(records: DataFrame, seed: DataFrame, *, name: str = "raw_name", address: str = "domain", prepared_aliases: bool = True, unicode_words: bool = True) -> DataFrame:
    """records with the columns normalized_entity_name, canonical_entity_id, canonical_entity_name, match_strategy, confidence,
    aliases_used, domains_used, resolver_version and unresolved_reason.

    prepared_aliases=False leaves the seed's normalized aliases out and unicode_words=False compares ASCII words only: the
    rules of the second resolver.
    """
    raw, host = stripped(F.coalesce(F.col(name), F.lit(""))), domain(F.col(address))
    df = records.withColumn("_raw_", raw).withColumn("_domain_", host).withColumn("_normal_", entity_name(F.col("_raw_"), unicode_words=unicode_words))
    df = df.withColumn("_lower_", F.lower("_raw_")).withColumn("_words_", F.array_join(significant_words(F.col("_normal_")), " "))
    # One look at the seed tells for all lookups whether they are small; then one partition spares their aggregates a shuffle.
    keys_of = seed.agg(F.coalesce(F.sum(F.lit(2) + F.size("verified_aliases") + F.size("normalized_aliases") + F.size("official_domains")), F.lit(0)))
    small = keys_of.collect()[0][0] <= MOST_ROWS
    seed = seed.coalesce(1) if small else seed
    hint = F.broadcast if small else lambda table: table
    keys = {"domain": "_domain_", "name": "_lower_", "alias": "_lower_", "normalized_name": "_normal_", "normalized_alias": "_normal_", "words": "_words_"}
    for tier, table in lookups(seed, prepared_aliases=prepared_aliases, unicode_words=unicode_words).items():
        df = df.join(hint(table.select(F.col("key").alias(f"_{tier}_key_"), F.col("found").alias(f"_{tier}_found_"))), F.col(keys[tier]) == F.col(f"_{tier}_key_"), "left")

    strings = lambda *xs: F.array(*xs).cast("array<string>")
    none = F.lit(None).cast("string")

    def outcome(entity: Column | None, strategy: str, confidence: Column, aliases: Column, domains: Column, reason: Column) -> Column:
        cid, cname = (none, none) if entity is None else (entity["canonical_id"], entity["canonical_name"])
        return F.struct(cid.alias("canonical_entity_id"), cname.alias("canonical_entity_name"), F.lit(strategy).alias("match_strategy"), confidence.cast("double").alias("confidence"), aliases.alias("aliases_used"), domains.alias("domains_used"), reason.cast("string").alias("unresolved_reason"))

    def tier(label: str, strategy: str, used: Column | None, what: str) -> Column:
        found = F.col(f"_{label}_found_")
        first = F.get(found, F.lit(0))
        entity = first["e"] if label == "words" else first
        names = F.array_join(F.transform(found, lambda x: (x["e"] if label == "words" else x)["canonical_name"]), ", ")
        score = first["b"]["score"] if label == "words" else F.lit(TIERS[label])
        aliases = strings(first["b"]["alias"]) if label == "words" else strings() if label == "domain" else strings(entity["canonical_name"] if used is None else used)
        one = outcome(entity, strategy, score, aliases, strings(F.col("_domain_")) if label == "domain" else strings(), none)
        several = outcome(None, "AMBIGUOUS_MULTI_CANDIDATE", F.lit(0.0), strings() if label == "words" else aliases, strings(), F.concat(F.lit(f"several entities for one {what}: "), names))
        return F.when(F.size(found) == 1, one).when(F.size(found) > 1, several)

    empty = F.when((F.col("_raw_") == "") & (F.col("_domain_") == ""), outcome(None, "UNRESOLVED", F.lit(0.0), strings(), strings(), F.lit("EMPTY_INPUT")))
    decided = F.coalesce(
        empty,
        tier("domain", "OFFICIAL_DOMAIN", None, "domain"),
        tier("name", "EXACT_CANONICAL_NAME", None, "name"),
        tier("alias", "EXACT_CONFIGURED_ALIAS", F.col("_raw_"), "alias"),
        tier("normalized_name", "EXACT_CANONICAL_NAME", None, "name"),
        tier("normalized_alias", "EXACT_NORMALIZED_ALIAS", F.col("_normal_"), "normalized alias"),
        tier("words", "CONSERVATIVE_TOKEN_MATCH", None, "set of words"),
        outcome(None, "UNRESOLVED", F.lit(0.0), strings(), strings(), F.lit("NO_MATCHING_ENTITY_FOUND")),
    )
    out = df.withColumn("_out_", decided)
    fields = ("canonical_entity_id", "canonical_entity_name", "match_strategy", "confidence", "aliases_used", "domains_used", "unresolved_reason")
    return out.select(*records.columns, F.col("_normal_").alias("normalized_entity_name"), *(F.col(f"_out_.{f}").alias(f) for f in fields), F.lit(VERSION).alias("resolver_version"))
