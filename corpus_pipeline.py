"""A training corpus from raw documents: five stages, each on all that the one before it kept.

Rules drop what a tokeniser can't read or what repeats itself, near-duplicates leave one document of each group,
documents that hold a benchmark passage go, secrets are masked, and what is left becomes token ids.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame with the columns of documents; the last gives ids. A stage
is written and read again before the next. Rows with a null doc_id go through the stages like others, but are never
each other's near-duplicates. An empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quern.llm.bpe import bpe_round_trip
from quern.llm.common import staged
from quern.llm.decontaminate import keep_clean
from quern.llm.quality import keep_good
from quern.llm.secrets import redact
from quern.llm.simhash import keep_one

QUALITY_VOCABULARY, RANKS = "piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken"
#: No SQL: simhash components, tokenisers and entropy windows can't be said in it. tests/llm has the brute-force form.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, public_tokenizers.path(QUALITY_VOCABULARY))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_round_trip(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, with_ids=True)


STAGES = [("quality rules", quality), ("near-duplicates", near_duplicates), ("decontamination", decontamination), ("secrets", secrets), ("byte-level BPE", encoding)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
