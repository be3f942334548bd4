"""Language-model scoring: an interpolated modified Kneser-Ney bigram model over the whole training part.

Tokens are the words of the text with A-Z in lower case, then one end token; the end token is also the context of the
first word. Three passes over the texts, none of which shuffles a text or a token:

1. Words are counted: a task adds up the hashes (XXH64) of its words, packs the sorted hashes with their counts into
   one blob for each part of the hash range, and the blobs meet by part. Each part is stored as a sorted hash array
   with its counts. A word's id is its place in all parts together, plus one; the end token has id 0.
2. Pairs of ids are counted in the same way, parted by the range of the context's id: a sorted array of
   (context, word) keys with counts. With it go, for each context, its total and its numbers of words seen once,
   twice and more often, and, for each word, in how many contexts it occurs. Contexts with more than a fourth of an even
   part of all tokens (at most four times the number of parts) are dealt by the hash of the pair, so that no task holds all
   pairs of a frequent word; their totals are summed over the parts.
3. Workers map these arrays into memory and score every text by binary search.

P(w | v) = max(c(vw) - D(c(vw)), 0) / c(v) + (sum_k D_k N_k(v)) / c(v) * P(w), and P(w) is of the same form over the
numbers of contexts, interpolated with 1 / (V + 1), so that an unknown word has a probability. D_1, D_2 and D_3+ come
from the numbers of n-grams seen one to four times, at each order; where those give no discount between 0 and the count
(tiny or odd inputs), they are 1/2, 1 and 3/2, so that unseen words always keep some probability. The order is two: distinct word triples of the whole corpus take more than the disk budget as sorted arrays.

Counts are kept in 64 bits where 32 don't hold them. Ids have 32 bits: a corpus of more than MOST_WORDS distinct words is an error.

Null texts count as empty: they have the end token only. A null doc_id counts as the empty text for the split.
Without training texts N and V are 0
and every word is unknown, at probability 1. Repeated rows each get the same result, and each counts in training. The empty
table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import Arrays, byte_texts, new_folder, partitions, remainder, rows, slices, text_of

BLOB = pa.schema([("part", pa.int32()), ("blob", pa.binary())])
STATS = pa.schema([("part", pa.int32()), ("size", pa.int64()), ("tokens", pa.int64()), *((f"n{k}", pa.int64()) for k in range(1, 5))])
STATS_DDL = "part int, size bigint, tokens bigint, n1 bigint, n2 bigint, n3 bigint, n4 bigint"
SCHEMA = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
HOT = pa.schema([("id", pa.int64())])
DDL = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
#: Keys that a task gathers before it packs them: repeats among them are never shuffled.
GATHERED = 4_000_000
#: Bytes of text that are looked up together: the more, the nearer neighbours are in the sorted arrays.
SLICE = 4 << 20
MODULUS = 10
#: Distinct words whose ids, with the end's, fit the half of a key.
MOST_WORDS = (1 << 32) - 2


def narrow(counts: np.ndarray) -> np.ndarray:
    """Counts in 32 bits if all fit, else in 64."""
    return counts.astype(np.uint32 if not len(counts) or counts.max() < 1 << 32 else np.uint64)


def pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys as differences and their counts, compressed."""
    import zstandard

    gaps = np.diff(keys, prepend=np.uint64(0))
    counts = narrow(counts)
    planes = np.concatenate([gaps.view(np.uint8).reshape(-1, 8).T.ravel(), counts.view(np.uint8).reshape(-1, counts.itemsize).T.ravel()])
    return np.array([len(keys), counts.itemsize], np.uint64).tobytes() + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    n, width = np.frombuffer(blob[:16], np.uint64).tolist()
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[16:], max_output_size=(8 + width) * n), np.uint8)
    gaps = np.ascontiguousarray(planes[: 8 * n].reshape(8, n).T).view(np.uint64).ravel()
    counts = np.ascontiguousarray(planes[8 * n :].reshape(width, n).T).view(f"<u{width}").ravel()
    return np.cumsum(gaps, dtype=np.uint64), counts.astype(np.int64)


def added(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and their summed counts."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.array([], np.int64)
    if counts is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of the texts, one text after another, and the number of words of each."""
    import xxhash

    split = [t.lower().split() for t in texts]
    every = [w for words in split for w in words]
    distinct = dict.fromkeys(every)
    hashes = dict(zip(distinct, map(xxhash.xxh64_intdigest, distinct), strict=True))
    return np.fromiter(map(hashes.__getitem__, every), np.uint64, len(every)), np.fromiter(map(len, split), np.int64, len(split))


def discounts(n: list[int]) -> np.ndarray:
    """D by count, at 0 to 3: modified Kneser-Ney from the numbers of n-grams seen one to four times."""
    n1, n2, n3, n4 = n
    if not (n1 and n2 and n3):
        return np.array([0.0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0.0, *(x if 0 < x <= k else k / 2 for k, x in enumerate(d, 1))])


class Sorted:
    """A sorted array in parts, each a file. bounds: the first key of each part but the first, in the parts' order."""

    def __init__(self, arrays: Arrays, names: tuple[str, ...], sizes: list[int]) -> None:
        self.arrays, self.names, self.sizes, self.open = arrays, names, sizes, {}
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    def part(self, k: int) -> list[np.ndarray]:
        if k not in self.open:
            self.open[k] = [self.arrays.load(f"{n}-{k}") for n in self.names]
        return self.open[k]

    def find(self, keys: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of ascending keys whose parts ascend too: the place in all parts together (-1: absent) and the first value."""
        at, value = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(keys)] if len(keys) else [0]
        for a, b in zip(cuts, cuts[1:], strict=False):
            k = int(parts[a])
            if not self.sizes[k]:
                continue
            own, values, *_ = self.part(k)
            i = np.minimum(np.searchsorted(own, keys[a:b]), len(own) - 1)
            hit = own[i] == keys[a:b]
            at[a:b] = np.where(hit, i + self.first[k], -1)
            value[a:b] = np.where(hit, values[i], 0)
        return at, value

    def __getstate__(self) -> dict:
        return self.__dict__ | {"open": {}}


class Model:
    """The stored model: words, pairs, and what is known of each context and each word."""

    def __init__(self, arrays: Arrays, n: int) -> None:
        self.arrays, self.n = arrays, n
        self.words = self.pairs = None
        self.train_tokens = self.distinct = self.ends = 0
        self.hot, self.hot_stats = np.array([], np.int64), np.zeros((0, 4), np.int64)

    def word_part(self, hashes: np.ndarray) -> np.ndarray:
        return (((hashes >> np.uint64(32)) * np.uint64(self.n)) >> np.uint64(32)).astype(np.int32)

    def context_part(self, ids: np.ndarray) -> np.ndarray:
        return (ids.astype(np.int64) * self.n // (int(self.words.first[-1]) + 1)).astype(np.int32)

    def is_hot(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which ids are frequent contexts, and their places among these."""
        if not len(self.hot):
            return np.zeros(len(ids), bool), np.zeros(len(ids), np.int64)
        at = np.minimum(np.searchsorted(self.hot, ids), len(self.hot) - 1)
        return self.hot[at] == ids, at

    def pair_part(self, keys: np.ndarray) -> np.ndarray:
        context = (keys >> np.uint64(32)).astype(np.int64)
        mixed = keys * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
        return np.where(self.is_hot(context)[0], self.word_part(mixed), self.context_part(context))

    def tokens(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the tokens of all texts (0: end, -1: unknown), the token count of each text, and the words' counts."""
        hashes, sizes = word_hashes(texts)
        distinct, back = np.unique(hashes, return_inverse=True)
        place, count = self.words.find(distinct, self.word_part(distinct))
        ids, counts = np.zeros(len(hashes) + len(sizes), np.int64), np.full(len(hashes) + len(sizes), self.ends, np.int64)
        inner = np.ones(len(ids), bool)
        inner[np.cumsum(sizes + 1) - 1] = False
        ids[inner], counts[inner] = np.where(place >= 0, place + 1, -1)[back], count[back]
        return ids, sizes + 1, counts

    def context_stats(self, ids: np.ndarray) -> np.ndarray:
        """For ascending ids: total, and words seen once, twice, more often."""
        out = np.zeros((len(ids), 4), np.int64)
        parts = self.context_part(np.maximum(ids, 0))
        for k in np.unique(parts[ids >= 0]).tolist():
            mine = (parts == k) & (ids >= 0)
            own, stats = self.open(f"context-{k}"), self.open(f"stats-{k}")
            if len(own):
                i = np.minimum(np.searchsorted(own, ids[mine]), len(own) - 1)
                out[mine] = np.where((own[i] == ids[mine])[:, None], stats[i], 0)
        hot, at = self.is_hot(ids)
        out[hot] = self.hot_stats[at[hot]]
        return out

    def open(self, name: str) -> np.ndarray:
        cache = self.__dict__.setdefault("_open", {})
        if name not in cache:
            cache[name] = self.arrays.load(name)
        return cache[name]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_open"}

    def backed(self, ids: np.ndarray) -> np.ndarray:
        """P(w) of ascending ids, from the numbers of contexts."""
        seen = np.zeros(len(ids), np.int64)
        parts = self.context_part(np.maximum(ids, 0))
        for k in np.unique(parts[ids >= 0]).tolist():
            mine = (parts == k) & (ids >= 0)
            seen[mine] = self.open(f"contexts-{k}")[ids[mine] - self.id_from(k)]
        d, total = self.low, self.low_total
        if not total:
            return np.full(len(ids), 1 / (self.distinct + 1))
        return np.maximum(seen - d[np.minimum(seen, 3)], 0) / total + self.low_left / total / (self.distinct + 1)

    def id_from(self, part: int) -> int:
        """The least id of the part of the contexts."""
        return -(-part * (int(self.words.first[-1]) + 1) // self.n)

    def log10(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """log10 P of each token given the one before it."""
        before = np.concatenate([[0], ids[:-1]])
        before[np.cumsum(sizes) - sizes] = 0
        keys = (np.maximum(before, 0).astype(np.uint64) << np.uint64(32)) | np.maximum(ids, 0).astype(np.uint64)
        known = (before >= 0) & (ids >= 0)
        distinct, back = np.unique(keys, return_inverse=True)
        parts = self.pair_part(distinct)
        order, count = np.argsort(parts, kind="stable"), np.empty(len(distinct), np.int64)
        count[order] = self.pairs.find(distinct[order], parts[order])[1]
        count = np.where(known, count[back], 0)
        contexts, at = np.unique(before, return_inverse=True)
        stats = self.context_stats(contexts)[at]
        words, where = np.unique(ids, return_inverse=True)
        low = self.backed(words)[where]
        total, left = stats[:, 0], (stats[:, 1:] * self.high[1:]).sum(axis=1)
        seen = np.maximum(total, 1)
        p = np.where(total > 0, np.maximum(count - self.high[np.minimum(count, 3)], 0) / seen + left / seen * low, low)
        return np.log10(p)


def _packed(gather, part_of, column: str = "text"):
    """A function for mapInArrow that adds up keys of texts and gives a blob for each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            keys, counts = added(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
            parts = part_of(keys)
            order = np.argsort(parts, kind="stable")
            parts, keys, counts = parts[order], keys[order], counts[order]
            cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                yield rows(BLOB, part=pa.array(parts[a : a + 1]), blob=[pack(keys[a:b], counts[a:b])])
            held.clear()

        for batch in slices(batches, column, SLICE):
            keys, counts = added(gather(byte_texts(batch.column(column))))
            held.append((keys, counts))
            size += len(keys)
            if size > GATHERED:
                merged = added(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
                held[:] = [merged]
                size = len(merged[0])
                if size > GATHERED // 2:
                    yield from out()
                    size = 0
        if size:
            yield from out()

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of blobs by ascending part: each part's distinct keys and counts."""
    part, held, size = None, [], 0

    def out() -> tuple[int, np.ndarray, np.ndarray]:
        return part, *added(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))

    for batch in batches:
        for k, blob in zip(batch.column("part").to_pylist(), batch.column("blob").to_pylist(), strict=True):
            if k != part and held:
                yield out()
                held.clear()
                size = 0
            part = k
            held.append(unpack(blob))
            size += len(held[-1][0])
            if len(held) > 1 and size > 2 * GATHERED:
                held[:] = [added(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))]
                size = len(held[0][0])
    if held:
        yield out()


def _stat(part: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    n = np.bincount(np.minimum(counts, 5), minlength=6)
    return rows(STATS, part=[part], size=[len(keys)], tokens=[int(counts.sum())], **{f"n{k}": [int(n[k])] for k in range(1, 5)})


def train(texts: DataFrame) -> Model:
    """The model of a column ``text``."""
    spark = texts.sparkSession
    model = Model(Arrays(new_folder(spark, "ngram")), partitions(spark))
    n, arrays = model.n, model.arrays
    blobs = "part int, blob binary"

    def store_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, keys, counts in _merged(batches):
            arrays.save(f"word-{part}", keys)
            arrays.save(f"count-{part}", counts.astype(np.int64))
            yield _stat(part, keys, counts)

    def by_part(df: DataFrame, store) -> list:
        stored = df.repartitionById(n, F.col("part")).sortWithinPartitions("part").mapInArrow(store, STATS_DDL)
        return stored.groupBy("part").agg(*(F.sum(c).alias(c) for c in STATS.names[1:])).collect()  # a row a part, and one a frequent context

    word_part = model.word_part
    found = {r.part: r for r in by_part(texts.mapInArrow(_packed(lambda t: word_hashes(t)[0], word_part), blobs), store_words)}
    model.words = Sorted(arrays, ("word", "count"), [found[k].size if k in found else 0 for k in range(n)])
    model.ends = texts.count()
    model.train_tokens = model.ends + sum(r.tokens for r in found.values())
    model.distinct = sum(r.size for r in found.values()) + (model.ends > 0)
    if model.distinct > MOST_WORDS:
        raise OverflowError(f"{model.distinct} distinct words: ids have room for {MOST_WORDS}")
    least = model.train_tokens / (4 * n)

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.column("part").to_pylist():
                ids = np.flatnonzero(arrays.load(f"count-{part}") > least) + int(model.words.first[part]) + 1
                yield rows(HOT, id=pa.array(ids.astype(np.int64)))

    if found:
        words_of = spark.createDataFrame([(k,) for k in sorted(found)], "part int").repartitionById(n, F.col("part"))
        hot = [r.id for r in words_of.mapInArrow(frequent, "id bigint").collect()]  # fewer than four times n
        model.hot = np.array(sorted([*hot, *([0] if model.ends > least else [])]), np.int64)

    def pairs(t: list[bytes]) -> np.ndarray:
        ids, sizes, _ = model.tokens(t)
        before = np.concatenate([[0], ids[:-1]])
        before[np.cumsum(sizes) - sizes] = 0
        return (before.astype(np.uint64) << np.uint64(32)) | ids.astype(np.uint64)

    def store_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, keys, counts in _merged(batches):
            arrays.save(f"pair-{part}", keys)
            arrays.save(f"pairs-{part}", narrow(counts))
            context = (keys >> np.uint64(32)).astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], np.diff(context) != 0]))
            stats = np.stack([np.add.reduceat(x.astype(np.int64), first) for x in (counts, counts == 1, counts == 2, counts > 2)], axis=1)
            arrays.save(f"context-{part}", context[first])
            arrays.save(f"stats-{part}", stats)
            yield _stat(part, keys, counts)
            is_hot, at = model.is_hot(context[first])
            for i, (total, *seen) in zip(at[is_hot].tolist(), stats[is_hot].tolist(), strict=True):
                yield rows(STATS, part=[-1 - i], size=[0], tokens=[total], **{f"n{k}": [x] for k, x in zip(range(1, 5), [*seen, 0], strict=True)})

    stored = by_part(texts.mapInArrow(_packed(pairs, model.pair_part), blobs), store_pairs)
    model.hot_stats = np.zeros((len(model.hot), 4), np.int64)
    for r in (r for r in stored if r.part < 0):
        model.hot_stats[-1 - r.part] = r.tokens, r.n1, r.n2, r.n3
    stored = [r for r in stored if r.part >= 0]
    there = {r.part: r.size for r in stored}
    model.pairs = Sorted(arrays, ("pair", "pairs"), [there.get(k, 0) for k in range(n)])
    for k in set(range(n)) - set(there):
        arrays.save(f"context-{k}", np.array([], np.int64))
        arrays.save(f"stats-{k}", np.zeros((0, 4), np.int64))
    model.high = discounts([sum(r[f"n{k}"] for r in stored) for k in range(1, 5)])

    # In how many contexts each word occurs: every part of the pairs gives one blob for each part of the ids.
    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.column("part").to_pylist():
                keys, counts = added((arrays.load(f"pair-{part}") & np.uint64(0xFFFFFFFF)).astype(np.uint64))
                parts = model.context_part(keys.astype(np.int64))
                cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(keys)]
                for a, b in zip(cuts, cuts[1:], strict=False):
                    yield rows(BLOB, part=pa.array(parts[a : a + 1]), blob=[pack(keys[a:b], counts[a:b])])

    def store_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, keys, counts in _merged(batches):
            dense = np.zeros(model.id_from(part + 1) - model.id_from(part), np.int64)
            dense[keys.astype(np.int64) - model.id_from(part)] = counts
            arrays.save(f"contexts-{part}", dense)
            yield _stat(part, keys, counts)

    own = spark.createDataFrame([(k,) for k in sorted(there)], "part int").repartitionById(n, F.col("part"))
    of = by_part(own.mapInArrow(contexts, blobs), store_contexts)
    for k in set(range(n)) - {r.part for r in of}:
        arrays.save(f"contexts-{k}", np.zeros(model.id_from(k + 1) - model.id_from(k), np.int64))
    seen = [sum(r[f"n{k}"] for r in of) for k in range(1, 5)]
    model.low, model.low_total = discounts(seen), sum(r.tokens for r in of)
    more = sum(r.size for r in of) - seen[0] - seen[1]
    model.low_left = float(model.low[1] * seen[0] + model.low[2] * seen[1] + model.low[3] * more)
    return model


def score(docs: DataFrame, model: Model, modulus: int = MODULUS) -> DataFrame:
    """A row for each document: the base score and the model's log10 probability of its text."""

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            ids, sizes, counts = model.tokens(byte_texts(batch.column("text")))
            first = np.cumsum(sizes) - sizes
            base = np.log10((counts + 0.1) / (model.train_tokens + 0.1 * (model.distinct + 1)))
            sums = [np.add.reduceat(x, first) for x in (base, model.log10(ids, sizes), (counts > 0).astype(np.int64))]
            yield rows(SCHEMA, doc_id=batch.column("doc_id"), held_out=batch.column("held_out"), n_tokens=pa.array(sizes), n_known=pa.array(sums[2]), train_tokens=[model.train_tokens] * len(sizes), base_score=pa.array(sums[0]), score=pa.array(sums[1]))

    own = text_of(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), (remainder(F.col("doc_id"), modulus) == 0).alias("held_out"), "text")
    return own.mapInArrow(rate, DDL)


def score_held_out(docs: DataFrame, modulus: int = MODULUS) -> DataFrame:
    """Train on the documents whose crc32(doc_id) mod modulus is not 0 and score all."""
    texts = text_of(docs, "doc_id", "text").where(remainder(F.col("doc_id"), modulus) != 0).select("text")
    return score(docs, train(texts), modulus)
