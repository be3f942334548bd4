"""Semantic chunks of long texts.

A text is cut at the first kind of border that gives more than one piece (headings, blank lines, list or table rows,
sentences), the pieces are packed up to a limit, and a piece that is too large is cut in the same way; the last resort
is a cut at the last space. Lengths are in characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.text import token_estimate

CHARS_PER_TOKEN, MOST_CHUNKS, MOST_CHARS, JOINT = 3.5, 25, 500_000, "\n\n"
# The borders, in order.
BORDERS = tuple(
    re.compile(p) for p in (r"(?=(?:\r?\n|\A)#{1,4}\s+)", r"\n{2,}", r"\n(?=[-*\d.]\s+|\|)", r"(?<=[.?!])\s+(?=[A-Z0-9])")
)


@dataclass(frozen=True)
class Limits:
    max_chars: int = int(8000 * CHARS_PER_TOKEN)
    max_chunks: int = MOST_CHUNKS
    max_total: int = MOST_CHARS


def pieces(text: str) -> list[str]:
    for border in BORDERS:
        found = [p for p in map(str.strip, border.split(text)) if p]
        if len(found) > 1:
            return found
    return [text]


def hard_cut(text: str, most: int) -> Iterator[str]:
    while len(text) > most:
        space = text.rfind(" ", 0, most + 1)
        end = space if space > 0 else most
        yield text[:end].strip()
        text = text[end:].strip()
    if text:
        yield text


def blocks(text: str, most: int) -> list[str]:
    """The text as blocks of at most that many characters. A stack takes the place of recursion: texts nest deep."""
    out: list[str] = []
    waiting = [(text, False)]  # (text, whether it is packed already)
    while waiting:
        block, packed = waiting.pop()
        if packed or len(block) <= most:
            out.append(block)
            continue
        parts = pieces(block)
        if len(parts) == 1:
            out += hard_cut(block, most)
            continue
        packed_parts: list[tuple[str, bool]] = []
        current = ""
        for part in parts:
            joined = f"{current}{JOINT}{part}" if current else part
            if len(joined) <= most:
                current = joined
                continue
            if current:
                packed_parts.append((current, True))
            current = ""
            if len(part) <= most:
                current = part
            else:
                packed_parts.append((part, False))
        if current:
            packed_parts.append((current, True))
        waiting += reversed(packed_parts)
    return out


def chunked(text: str | None, limits: Limits) -> tuple[list[tuple[int, str, int, int]], int, int, int]:
    """Chunks as (index, content, start, end), characters left out, and the range that was left out (-1: none).

    Offsets run over the chunks with a joint between each two; they aren't places in the text.
    """
    if not text or not text.strip():
        return [], 0, -1, -1
    left, first, last = 0, -1, -1
    if len(text) > limits.max_total:
        left, first, last = len(text) - limits.max_total, limits.max_total, len(text)
        text = text[: limits.max_total]
    out, at = [], 0
    for i, content in enumerate(blocks(text, limits.max_chars)):
        if i >= limits.max_chunks:
            left, first, last = left + len(text) - at, at, len(text)
            break
        out.append((i, content, at, at + len(content)))
        at += len(content) + len(JOINT)
    return out, left, first, last


def chunk_documents(docs: DataFrame, limits: Limits = Limits(), *, key: str = "doc_id", column: str = "text") -> DataFrame:
    """A row for each chunk: key, chunk_id, index, content, char_count, estimated_tokens, start_offset, end_offset, truncated,
    omitted_chars, omitted_start and omitted_end (the last two null if nothing was left out)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for k, text in zip(frame["key"], frame["text"], strict=True):
                found, left, first, last = chunked(text, limits)
                out += [(k, f"chunk-{i + 1:03}", i, content, len(content), start, end, left > 0, left, first, last) for i, content, start, end in found]
            yield pd.DataFrame(out, columns=["key", "chunk_id", "index", "content", "char_count", "start_offset", "end_offset", "truncated", "omitted_chars", "omitted_start", "omitted_end"])

    kind = docs.schema[key].dataType.simpleString()
    own = docs.select(F.col(key).alias("key"), F.col(column).alias("text"))
    done = own.mapInPandas(run, f"key {kind}, chunk_id string, index int, content string, char_count int, start_offset int, end_offset int, truncated boolean, omitted_chars int, omitted_start int, omitted_end int")
    return done.select(
        F.col("key").alias(key), "chunk_id", "index", "content", "char_count", token_estimate(F.col("content")).alias("estimated_tokens"), "start_offset", "end_offset", "truncated", "omitted_chars",
        F.nullif("omitted_start", F.lit(-1)).alias("omitted_start"), F.nullif("omitted_end", F.lit(-1)).alias("omitted_end"),
    )


def rechunk_oversized(chunks: DataFrame, most: int, *, key: str = "doc_id") -> DataFrame:
    """Chunks of more than that many characters, as if a model had refused them for size, cut anew at half their length.

    The parts take their chunk's place; parts of it count from 0 in sub_index. One that can't be cut stays.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [(k, i, j, part) for k, i, text in zip(frame["key"], frame["index"], frame["content"], strict=True) for j, part in enumerate(blocks(text, len(text) // 2) if len(text) > most else [text])]
            yield pd.DataFrame(out, columns=["key", "index", "sub_index", "content"])

    kind = chunks.schema[key].dataType.simpleString()
    own = chunks.select(F.col(key).alias("key"), "index", "content")
    return own.mapInPandas(run, f"key {kind}, index int, sub_index int, content string").withColumnRenamed("key", key)
