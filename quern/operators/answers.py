"""Model answers: repair, provider order and failures, over a table of raw responses.

responses: doc_id, chunk_index, provider, provider_rank, is_repair, status_code, raw_text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.text import parsed_json
from quern.operators.validate import Schema


def checked(responses: DataFrame, schema: Schema) -> DataFrame:
    """responses with data (a variant, null if malformed) and error (null if the answer holds)."""
    df = responses.withColumn("data", F.when(F.coalesce("status_code", F.lit(200)) < 400, parsed_json(F.col("raw_text"))))
    message = schema.message(F.col("data"))
    status = F.concat(F.lit("status "), F.col("status_code").cast("string"))
    return df.withColumn("error", F.when(F.col("status_code") >= 400, status).when(message != "", message))


def best_attempts(answers: DataFrame) -> DataFrame:
    """For each chunk and provider the first answer if it holds, else its repair; a provider mends one chunk only, the first
    that needs it."""
    per = ["doc_id", "provider", "provider_rank", "chunk_index"]
    pick = lambda repair: F.first(F.when(F.col("is_repair") == repair, F.struct(F.to_json("data").alias("json"), "error")), ignorenulls=True)
    both = answers.groupBy(*per).agg(pick(False).alias("plain"), pick(True).alias("mended"))
    needs = both.where("plain.error IS NOT NULL AND mended IS NOT NULL").groupBy("doc_id", "provider").agg(F.min("chunk_index").alias("_mends_"))
    df = both.join(needs, ["doc_id", "provider"], "left")
    used = F.when(F.col("plain.error").isNull() & F.col("plain").isNotNull(), F.col("plain")).when(F.col("chunk_index") == F.col("_mends_"), F.col("mended")).otherwise(F.coalesce("plain", "mended"))
    return df.select(*per, used["json"].alias("json"), used["error"].alias("error"))


def choose_provider(answers: DataFrame, chunks: DataFrame) -> DataFrame:
    """doc_id, provider and failures: the first provider by rank with a valid answer for every chunk of the document.

    chunks: doc_id, n_chunks. Where none has, provider is null; failures lists provider and first error of those before.
    """
    ok = F.count_if(F.col("error").isNull()).alias("n_ok")
    first = F.min_by("error", F.when(F.col("error").isNotNull(), F.col("chunk_index"))).alias("first_error")
    runs = best_attempts(answers).groupBy("doc_id", "provider", "provider_rank").agg(ok, first)
    judged = chunks.join(runs, "doc_id", "left").withColumn("won", F.coalesce(F.col("n_ok") >= F.col("n_chunks"), F.lit(False)))
    done = judged.groupBy("doc_id").agg(
        F.min(F.when(F.col("won"), F.struct("provider_rank", "provider"))).alias("best"),
        F.array_sort(F.collect_list(F.when(~F.col("won") & F.col("provider").isNotNull(), F.struct("provider_rank", "provider", F.coalesce("first_error", F.lit("no answer")).alias("error"))))).alias("lost"),
    )
    before = F.filter("lost", lambda x: F.col("best").isNull() | (x["provider_rank"] < F.col("best.provider_rank")))
    return done.select("doc_id", F.col("best.provider").alias("provider"), F.transform(before, lambda x: F.concat(x["provider"], F.lit(": "), x["error"])).alias("failures"))
