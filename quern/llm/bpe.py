"""Byte-level BPE encoding and decoding over a global table of distinct words.

Three steps:

1. Each text is split into pre-tokens in order of position. A task drops repeats before anything is shuffled; the
   words then meet by hash, and each distinct word of the corpus is encoded once.
2. The encoded words lie in the shared folder as sorted hash arrays, one set of files for each part of the hash
   range. The texts are split again and each position looks its ids up: the join back. A text's positions never
   leave its row, so nothing has to be shuffled to put them in order, and neither texts nor positions are
   shuffled or held on disk. (To shuffle each position with its word twice takes several times the input's size on
   disk.)
3. Decoding gathers each id's bytes from the token-byte table, whose size is the vocabulary's.

Null texts count as empty and have no ids. Repeated rows, texts and doc_ids each give a row of their own. The empty
table gives an empty result. Only the named columns are read, so other columns don't matter.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import Arrays, byte_texts, new_folder, partitions, rows, slices, text_of

#: Distinct units that a task gathers before it passes their words on, and pieces that a worker keeps at hand.
GATHERED, AT_HAND = 200_000, 150_000
#: Distinct words at which a task passes them on even if they came from few units, as in texts without spaces.
MOST_SEEN = 400_000
WORDS = pa.schema([("part", pa.int32()), ("word", pa.binary())])
DONE = pa.schema([("part", pa.int32()), ("words", pa.int64())])


def ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a file of ranks."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}


def encoding(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("quern", pat_str=pattern, mergeable_ranks=ranks(path), special_tokens={})


class Bytes:
    """The token-byte table: all tokens' bytes in one array, and where each token's start and how many they are."""

    def __init__(self, path: str) -> None:
        of = {i: b for b, i in ranks(path).items()}
        tokens = [of.get(i, b"") for i in range(max(of, default=-1) + 1)]
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def decode_all(self, rows_of_ids: list[bytes]) -> list[bytes]:
        """The bytes of each row's ids, by one gather for all rows."""
        ids = np.frombuffer(b"".join(rows_of_ids), "<u4")
        size = self.size[ids]
        ends = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.start[ids] - ends[:-1], size) + np.arange(ends[-1])
        out = self.data[at].tobytes()
        cuts = ends[np.concatenate([[0], np.cumsum([len(x) // 4 for x in rows_of_ids])]).astype(np.int64)].tolist()
        return [out[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def decode(self, ids: bytes) -> bytes:
        return self.decode_all([ids])[0]


def _hash(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _part(hashes: np.ndarray, n: int) -> np.ndarray:
    """The part of the hash range, in order."""
    return (((hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int32)


class Words:
    """Encoded words: for each part the sorted hashes, where each word's bytes and ids start, and the bytes and ids.

    Two words of one hash both stay, side by side, so the bytes decide.
    """

    def __init__(self, arrays: Arrays, n: int) -> None:
        self.arrays, self.n, self.open = arrays, n, {}

    @staticmethod
    def save(arrays: Arrays, part: int, words: list[bytes], encode) -> None:
        hashes = _hash(words)
        order = np.argsort(hashes, kind="stable")
        words = [words[i] for i in order]
        ids = [encode(w) for w in words]
        for name, value in {
            "hash": hashes[order],
            "at": np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64),
            "word": np.frombuffer(b"".join(words), np.uint8),
            "ids_at": np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64),
            "ids": np.fromiter((i for x in ids for i in x), np.uint32),
        }.items():
            arrays.save(f"{part}-{name}", value)

    def _of(self, part: int) -> list[np.ndarray]:
        if part not in self.open:
            self.open[part] = [self.arrays.load(f"{part}-{x}") for x in ("hash", "at", "word", "ids_at", "ids")]
        return self.open[part]

    def look_up(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word as little-endian unsigned 32-bit integers."""
        hashes = _hash(words)
        parts, out = _part(hashes, self.n), [b""] * len(words)
        order = np.argsort(hashes, kind="stable")
        cuts = [0, *(np.flatnonzero(np.diff(parts[order])) + 1).tolist(), len(words)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            mine = order[a:b]
            if not len(mine):
                continue
            sorted_hashes, at, text, ids_at, ids = self._of(int(parts[mine[0]]))
            places = np.searchsorted(sorted_hashes, hashes[mine])
            if not len(sorted_hashes) or places[-1] == len(sorted_hashes) or (sorted_hashes[places] != hashes[mine]).any():
                raise KeyError("a word was never encoded: the texts aren't those that the words were built from")
            after = np.minimum(places + 1, len(sorted_hashes) - 1)
            for j in np.flatnonzero((sorted_hashes[after] == hashes[mine]) & (after > places)).tolist():
                while text[at[places[j]] : at[places[j] + 1]].tobytes() != words[mine[j]]:  # words of one hash
                    places[j] += 1
            data = memoryview(ids).cast("B")
            for k, v, w in zip(mine.tolist(), (4 * ids_at[places]).tolist(), (4 * ids_at[places + 1]).tolist(), strict=True):
                out[k] = bytes(data[v:w])
        return out

    def encode(self, texts: list[str], find) -> list[bytes]:
        """The ids of each text. Pieces that aren't at hand are split into words, and these looked up, all at once."""
        kept, once = _kept(self.arrays.uri)
        heads, tails = [], []
        for text in texts:
            head, *tail = text.split(" ")
            heads.append(head)
            tails.append(tail)
        missing = set(itertools.chain.from_iterable(tails)).difference(kept)
        bad = {p for p in missing if opens_badly(p)}
        missing -= bad
        odd = {k: units(texts[k]) for k, (head, tail) in enumerate(zip(heads, tails, strict=True)) if tail and (opens_badly(head) or not bad.isdisjoint(tail))}
        alone = {head for k, head in enumerate(heads) if k not in odd}  # the head of an odd text needn't end where a word does
        wanted = [*map(" ".__add__, missing), *alone.union(*odd.values())]
        words = list(map(find, wanted))
        distinct = list(dict.fromkeys(itertools.chain.from_iterable(words)))
        ids = dict(zip(distinct, self.look_up([w.encode() for w in distinct]), strict=True))
        new = {u: b"".join(map(ids.__getitem__, w)) for u, w in zip(wanted, words, strict=True)}
        kept.update((p, new[" " + p]) for p in missing)
        out = [
            b"".join(map(new.__getitem__, odd[k])) if k in odd else b"".join([new[head], *map(kept.__getitem__, tail)])
            for k, (head, tail) in enumerate(zip(heads, tails, strict=True))
        ]
        # A piece stays at hand if it was missing in an earlier slice too, so that rare ones don't fill the room.
        stay = missing & once if len(kept) - len(missing) < AT_HAND else set()
        for piece in missing - stay:
            del kept[piece]
        if len(once) > AT_HAND:
            once.clear()
        once |= missing
        return out

    def __getstate__(self) -> dict:
        return self.__dict__ | {"open": {}}


@functools.lru_cache(maxsize=1)
def _kept(uri: str) -> tuple[dict[str, bytes], set[str]]:
    """The pieces that this worker has at hand, and those it missed once; they outlive a task, but not the table of words."""
    return {}, set()


_APART = regex.compile(r"(?<=\S)(?= \S)")


def opens_badly(piece: str) -> bool:
    """Whether a piece between spaces is empty or has white space at an end, so that no word need end there."""
    return not piece or piece[0].isspace() or piece[-1].isspace()


def units(text: str) -> list[str]:
    """The text cut before each lone space: a pre-token starts there, whatever stands before or behind.

    Few distinct units make up most of a corpus, so that the pattern has to run over each of these only.
    """
    return _APART.split(text) if text else []


def distinct_units(text: str, known: set[str]) -> set[str]:
    """The text's units that aren't known; for most texts these are its pieces between spaces."""
    first, *pieces = text.split(" ")
    new = set(map(" ".__add__, set(pieces).difference(known)))
    if any(opens_badly(u[1:]) for u in new) or pieces and opens_badly(first):
        return set(units(text))
    return new | {first}


def build(texts: DataFrame, column: str, path: str, pattern: str) -> Words:
    """Encode each distinct word of a column of texts once."""
    spark = texts.sparkSession
    n, arrays = partitions(spark), Arrays(new_folder(spark, "bpe"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, seen, done = regex.compile(pattern).findall, set(), set()

        def out() -> Iterator[pa.RecordBatch]:
            words = [w.encode() for w in seen]
            parts = _part(_hash(words), n)
            for a in range(0, len(words), 50_000):
                yield rows(WORDS, part=pa.array(parts[a : a + 50_000]), word=words[a : a + 50_000])
            seen.clear()
            done.clear()

        for batch in slices(batches, column):
            own = set().union(*(distinct_units(text or "", done) for text in batch.column(column).to_pylist()))
            seen.update(itertools.chain.from_iterable(map(find, own)))
            done.update(u[1:] for u in own if u[:1] == " " and not opens_badly(u[1:]))
            if len(done) > GATHERED or len(seen) > MOST_SEEN:
                yield from out()
        yield from out()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, set[bytes]] = {}
        for batch in batches:
            for part, word in zip(batch.column("part").to_pylist(), batch.column("word").to_pylist(), strict=True):
                own.setdefault(part, set()).add(word)
        if own:
            one = encoding(path, pattern).encode_ordinary
            for part, words in own.items():
                Words.save(arrays, part, list(words), lambda w: one(w.decode()))
            yield rows(DONE, part=list(own), words=[len(w) for w in own.values()])

    words = text_of(texts, column).mapInArrow(split, "part int, word binary")
    words.repartitionById(n, F.col("part")).mapInArrow(encode, "part int, words bigint").agg(F.sum("words")).collect()
    return Words(arrays, n)


def bpe_encode(docs: DataFrame, path: str, pattern: str, *, key: str = "doc_id", column: str = "text", ids_column: str = "ids") -> DataFrame:
    """Each row's key and its ids: little-endian unsigned 32-bit integers, as binary."""
    words = build(docs, column, path, pattern)
    schema = pa.schema([(key, pa.int64()), (ids_column, pa.binary())])

    def join_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        for batch in slices(batches, column):
            yield rows(schema, **{key: batch.column(key), ids_column: words.encode([t or "" for t in batch.column(column).to_pylist()], find)})

    return text_of(docs, key, column).withColumn(key, F.col(key).cast("bigint")).mapInArrow(join_back, f"`{key}` bigint, `{ids_column}` binary")


def bpe_decode(encoded: DataFrame, path: str, *, key: str = "doc_id", ids_column: str = "ids", column: str = "decoded") -> DataFrame:
    """Each row's key and the bytes of its ids; null ids give no bytes."""
    schema = pa.schema([(key, pa.int64()), (column, pa.binary())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Bytes(path)
        for batch in slices(batches, ids_column):
            yield rows(schema, **{key: batch.column(key), column: table.decode_all(byte_texts(batch.column(ids_column)))})

    return text_of(encoded, key, ids_column).mapInArrow(decode, f"`{key}` bigint, `{column}` binary")


def bpe_round_trip(docs: DataFrame, path: str, pattern: str, *, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and, from decoding those ids, decoded_sha256; the ids as array<int> if asked for.

    Encoding and decoding share one pass, so that ids needn't travel between two workers.
    """
    words = build(docs, "text", path, pattern)
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    schema = pa.schema([*fields, ("token_ids", pa.list_(pa.int32()))] if with_ids else fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, table = regex.compile(pattern).findall, Bytes(path)
        for batch in slices(batches, "text"):
            ids = words.encode([t or "" for t in batch.column("text").to_pylist()], find)
            more = {"token_ids": pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32), pa.array(np.frombuffer(b"".join(ids), "<i4")))} if with_ids else {}
            yield rows(schema, doc_id=batch.column("doc_id"), n_tokens=[len(x) // 4 for x in ids], ids_sha256=[hashlib.sha256(x).hexdigest() for x in ids], decoded_sha256=[hashlib.sha256(x).hexdigest() for x in table.decode_all(ids)], **more)

    own = text_of(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return own.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * with_ids)
