"""The operators as queries over whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm.pages import extract_pages

    return extract_pages(_table(spark, sf_dir, "pages"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm.decontaminate import contaminated

    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm.secrets import secret_scan

    return secret_scan(_table(spark, sf_dir, "documents"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm.chat import chat_digests

    said = r"\### Assistant: </turn> ok"
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return chat_digests(turns.unionByName(more))


def op5_ngram(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm.ngram import score_held_out

    return score_held_out(_table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm.langid import language_id

    return language_id(_table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm.simhash import simhash_dedup

    return simhash_dedup(_table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm.quality import quality_rules

    return quality_rules(_table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"))


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quern.llm.sharding import shard_by_bytes

    return shard_by_bytes(_table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from quern.llm.bpe import bpe_round_trip

    return bpe_round_trip(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


QUERIES = {f.__name__: f for f in (op1_pages, op2_decontaminate, op3_secrets, op4_chat, op5_ngram, op6_language, op7_simhash, op8_quality, op9_shards, op10_bpe, pipeline)}
ORACLES: dict[str, str] = {
    "op4_chat": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ), sized AS (
            SELECT *, 6 + length(replace(replace(replace(role, '\', '\\'), '<', '\<'), chr(10), '\n')) + 1
                + length(replace(replace(text, '\', '\\'), '<', '\<')) + 8 AS chars
            FROM turns
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(chars) AS BIGINT) AS formatted_chars
        FROM sized GROUP BY conv_id
    """,
}
