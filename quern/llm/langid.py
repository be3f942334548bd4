"""Language identification by bit-sliced Bloom filters of character n-grams.

Training takes a bounded sample of labelled rows: in each language the SAMPLE rows of the smallest crc32(doc_id).
The n-grams of a language that are frequent there (the PER_SIZE most frequent of each size) go into its Bloom filter.
Both are parameters, as is MOST_LANGS: where lang holds more different values, those with the most rows are learned, and the
others never predicted, so that the model has a bound.
The filters of all languages share their hash functions and lie bit by bit side by side: slot i holds a mask with a
bit for each language, so the masks of an n-gram's slots, and-ed, are the set of all languages that contain it.

A text is asked for all of its n-grams at once. A language's popcount x among n n-grams is corrected for the false
positives of its filter, (x - n f) / (1 - f) with f the filter's fill to the power of HASHES. The largest decides,
ties go to the language with more training rows, then to the first by name; the score is its share of the sum.

Null texts and texts without a letter are ``und`` with score 0. A text whose n-grams no filter knows gets the language
with the most training rows and score 0. Without any labelled row every text is ``und``. Repeated rows each get the
same result; the empty table gives an empty result. lang is read for training only.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import remainder, rows, slices, text_of

SIZES = (2, 3, 4)
SAMPLE, PER_SIZE, MOST_LANGS, SLOTS, HASHES = 1500, 4000, 512, 1 << 18, 3
GRAMS = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("gram", pa.int64()), ("n", pa.int64())])
SCHEMA = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def grams(text: str, size: int) -> np.ndarray:
    """Hashes of the text's n-grams of that size, with repeats, lower case, runs of other than letters as one space."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), np.uint32).astype(np.uint64)
    letter = ((points >= 97) & (points <= 122)) | (points >= 0xAA)
    points = np.where(letter, points, np.uint64(32))
    points = points[letter | np.concatenate([[True], letter[:-1]])]
    if len(points) < size + 1:
        return np.array([], np.uint64)
    out = np.zeros(len(points) - size + 1, np.uint64)
    for k in range(size):
        out = out * np.uint64(0x100000001B3) + points[k : len(points) - size + 1 + k]
    return _mixed(out + np.uint64(size))


class Filters:
    """Bloom filters of several languages, sliced by bit."""

    def __init__(self, langs: list[str], prior: list[int], of: list[np.ndarray], slots: int = SLOTS) -> None:
        self.langs, self.prior, self.slots = langs, np.array(prior, np.int64), slots
        self.masks = np.zeros((max(1, -(-len(langs) // 64)), slots), np.uint64)
        for i, found in enumerate(of):
            for at in self._slots(found):
                self.masks[i // 64, at] |= np.uint64(1 << i % 64)
        self.false = np.array([float(((self.masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean()) ** HASHES for i in range(len(langs))])

    def _slots(self, found: np.ndarray) -> list[np.ndarray]:
        return [((found * np.uint64(_MIX[k])) >> np.uint64(40)).astype(np.int64) % self.slots for k in range(HASHES)]

    def containing(self, found: np.ndarray) -> np.ndarray:
        """For each n-gram the mask of all languages that contain it, false positives included."""
        first, *others = self._slots(found)
        out = self.masks[:, first]
        for at in others:
            out = out & self.masks[:, at]
        return out

    def estimates(self, text: str) -> np.ndarray:
        """How many of the text's n-grams each language contains, corrected for false positives."""
        count, n = np.zeros(len(self.langs)), 0
        for size in SIZES:
            found = grams(text, size)
            for a in range(0, len(found), 1 << 18):
                masks = self.containing(found[a : a + (1 << 18)])
                n += masks.shape[1]
                count += [int(np.count_nonzero(masks[i // 64] & np.uint64(1 << i % 64))) for i in range(len(self.langs))]
        return np.maximum(0.0, (count - n * self.false) / (1 - self.false))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return "und", 0.0
        x = self.estimates(text)
        best = min(range(len(x)), key=lambda i: (-x[i], -self.prior[i], self.langs[i]))
        return self.langs[best], float(x[best] / x.sum()) if x.sum() > 0 else 0.0


def _last_of_sample(named: DataFrame, prior: dict[str, int], sample: int) -> dict[str, tuple[int, int]]:
    """Rank and doc_id of the last row of each language's sample.

    crc32 is even over its range, so a share of it that holds about twice the sample is ranked, and a larger one if that
    proves too small. A language with very many rows is thus never ranked as a whole.
    """
    ids = named.where("doc_id IS NOT NULL").select("lang", "doc_id", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("rank"))
    share, found = 2.0, {}
    while True:
        limits = {x: (1 << 32) * min(1.0, share * sample / n) for x, n in prior.items()}
        within = F.broadcast(named.sparkSession.createDataFrame(list(limits.items()), "lang string, below double"))  # MOST_LANGS rows at most
        order = Window.partitionBy("lang").orderBy("rank", "doc_id")
        ranked = ids.join(within, "lang").where(F.col("rank") < F.col("below")).withColumn("k", F.row_number().over(order)).where(F.col("k") <= sample)
        rows_of = ranked.groupBy("lang").agg(F.max(F.struct("rank", "doc_id")).alias("last"), F.count("*").alias("n")).collect()
        found = {r.lang: (r.last.rank, r.last.doc_id) for r in rows_of}
        enough = {r.lang for r in rows_of if r.n >= sample}
        if all(x in enough or limit >= 1 << 32 for x, limit in limits.items()):
            return found
        share *= 8


def train(docs: DataFrame, sample: int = SAMPLE, per_size: int = PER_SIZE, most_langs: int = MOST_LANGS) -> Filters:
    """Filters from at most that many labelled rows of each language, those of the smallest crc32(doc_id)."""
    named = text_of(docs, "doc_id", "text", "lang").where("lang IS NOT NULL AND text IS NOT NULL").where(remainder(F.col("doc_id"), 5) != 0)
    prior = {r[0]: r[1] for r in named.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most_langs).collect()}
    last = _last_of_sample(named, prior, sample) if prior else {}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list[np.ndarray]] = {}
        for batch in slices(batches, "text"):
            for lang, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "doc_id", "text")), strict=True):
                if lang in last and (zlib.crc32(str(doc_id).encode()), doc_id) <= last[lang]:
                    for size in SIZES:
                        found.setdefault((lang, size), []).append(grams(text, size))
        for (lang, size), parts in found.items():
            values, counts = np.unique(np.concatenate(parts), return_counts=True)
            yield rows(GRAMS, lang=[lang] * len(values), size=[size] * len(values), gram=pa.array(values.view(np.int64)), n=pa.array(counts.astype(np.int64)))

    counted = named.where("doc_id IS NOT NULL").mapInArrow(count, "lang string, size int, gram bigint, n bigint").groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))
    most = Window.partitionBy("lang", "size").orderBy(F.desc("n"), "gram")
    top = counted.withColumn("k", F.row_number().over(most)).where(F.col("k") <= per_size).select("lang", "gram").collect()
    langs = sorted(prior)
    of: dict[str, list[int]] = {x: [] for x in langs}
    for r in top:
        of[r.lang].append(r.gram)
    return Filters(langs, [prior[x] for x in langs], [np.array(of[x], np.int64).view(np.uint64) for x in langs])


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """doc_id, held_out, lang_pred and score, a row for each document, from its text alone."""
    held = docs.sparkSession.sparkContext.broadcast(filters)  # languages x slots bits, whatever the input's size

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [held.value.predict(x) for x in batch.column("text").to_pylist()]
            yield rows(SCHEMA, doc_id=batch.column("doc_id"), held_out=batch.column("held_out"), lang_pred=[x for x, _ in found], score=[y for _, y in found])

    own = text_of(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "text")
    return own.mapInArrow(ask, "doc_id bigint, held_out boolean, lang_pred string, score double")


def language_id(docs: DataFrame) -> DataFrame:
    return predict(docs, train(docs))
