"""Errors, retries and delays, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.functions.dates import parse_date

# Statuses that a bulk fetch and a model call try again.
RETRIED_FETCH, RETRIED_CALL = (429, 500, 502, 503, 504), (408, 409, 413, 429, 500, 502, 503, 504)
# What a challenge page says.
CHALLENGES = ("cloudflare", "just a moment...", "cf-browser-verification")


def classify_error(status: Column, message: Column, body: Column) -> Column:
    """A struct of error_code, status_code, is_transient and suggested_backoff_seconds; the first rule that fits holds.

    A page that mentions a challenge is blocked whatever its status.
    """
    body = F.lower(F.coalesce(body, F.lit("")))
    said = F.coalesce(message, F.when(status.isNotNull(), F.concat(F.lit("HTTP "), status.cast("string"))), F.lit("Unknown error"))
    said = F.lower(said)

    def outcome(code: str, status_code: Column, transient: bool, wait: float | None = None) -> Column:
        return F.struct(F.lit(code).alias("error_code"), status_code.cast("int").alias("status_code"), F.lit(transient).alias("is_transient"), F.lit(wait).cast("double").alias("suggested_backoff_seconds"))

    challenged = F.contains(body, F.lit(CHALLENGES[0])) | F.contains(body, F.lit(CHALLENGES[1])) | F.contains(body, F.lit(CHALLENGES[2]))
    unparsed = F.contains(said, F.lit("json")) | F.contains(said, F.lit("parse")) | F.contains(said, F.lit("syntax"))
    return (
        F.when(F.coalesce(status == 403, F.lit(False)) | challenged, outcome("BLOCKED_ACCESS", F.coalesce(status, F.lit(403)), False))
        .when(status == 429, outcome("HTTP_429_RATE_LIMITED", status, True, 5.0))
        .when(status == 413, outcome("HTTP_413_PAYLOAD_TOO_LARGE", status, True))
        .when(F.coalesce(status == 408, F.lit(False)) | F.contains(said, F.lit("timeout")), outcome("NETWORK_TIMEOUT", F.coalesce(status, F.lit(408)), True, 2.0))
        .when((status >= 500) & (status < 600), outcome("HTTP_5XX_SERVER_ERROR", status, True, 3.0))
        .when(unparsed, outcome("PARSING_FAILURE", status, False))
        .otherwise(outcome("UNKNOWN_ERROR", status, False))
    )


def fetch_backoff(attempt: Column, retry_after: Column, jitter: Column, factor: float = 2.0) -> Column:
    """Seconds: factor to the power of the attempt, or the server's wait if that is longer, times jitter (0.5 to 1.5)."""
    return F.greatest(F.pow(F.lit(factor), attempt), F.coalesce(retry_after.cast("double"), F.lit(0.0))) * jitter


def call_backoff(attempt: Column, retry_after_ms: Column, random: Column, base_ms: int = 500, most_ms: int = 10_000) -> Column:
    """Milliseconds: the server's wait, capped, plus a tenth at most; else a random share of a doubling ceiling."""
    waited = F.least(retry_after_ms.cast("double"), F.lit(float(most_ms)))
    ceiling = F.least(F.lit(float(most_ms)), F.lit(float(base_ms)) * F.pow(F.lit(2.0), attempt))
    return F.when(retry_after_ms > 0, F.floor(waited + waited * random * F.lit(0.1) + F.lit(0.5))).otherwise(F.floor(ceiling * random + F.lit(0.5))).cast("bigint")


def retry_after_ms(header: Column, now: Column) -> Column:
    """Milliseconds that a Retry-After header asks for: seconds, or a date; null if it says neither."""
    seconds = F.trim(header).try_cast("double")
    until = (F.unix_micros(parse_date(header)) - F.unix_micros(now)) / F.lit(1000)
    return F.when(seconds >= 0, F.floor(seconds * 1000 + F.lit(0.5)).cast("bigint")).when(until.isNotNull(), F.greatest(F.lit(0), until.cast("bigint")))


def is_retried(status: Column, *, call: bool = False) -> Column:
    return F.coalesce(status.isin(*(RETRIED_CALL if call else RETRIED_FETCH)), F.lit(False))
