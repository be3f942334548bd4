"""Chat formatting by columnar byte assembly.

The template writes a turn as ``<turn>role``, a line feed, the text and ``</turn>`` with a line feed. Inside roles and
texts a backslash goes before each backslash and each ``<``, and a line feed in a role becomes ``\\n``; so the marks
can't be forged, and unescaping gives back the very text. The loss mask covers the texts of assistant turns.

Turns are dealt by ranges of conversation and turn, so a conversation of very many turns is spread over tasks like any
other. A batch of turns, sorted by conversation and turn, is assembled as a whole: the segments of all turns (mark, role,
line feed, text, end mark) get their lengths, the cumulative sums of these are the offsets, and gathers by
index arrays copy all bytes into one buffer that becomes the Arrow column; a segment of LONG bytes or more is copied as
a slice, so that its indices take no memory. A batch is cut into parts, a part being
turns of one conversation that stand together: a conversation of any length is a run of parts, so no row and no task
holds more than a batch of it. What needs a conversation as a whole (digests) reads its parts in order and keeps
only the state of the hash: a digest can't be split, but it takes constant memory.

Null texts and roles count as empty. Turns of equal number come in the order of role and text; null turns come first; repeated
rows are turns of their own; rows of null conv_id are one conversation. The empty table gives an empty result. Only
conv_id, turn, role and text are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import partitions, rows, slices, text_of

MARK, AFTER_ROLE, END = b"<turn>", b"\n", b"</turn>\n"
LEARNED = "assistant"
#: Bytes of a segment that is copied as a slice, segments gathered at once, and characters by which equal turns are dealt.
LONG, STEP, DEALT_BY = 1 << 16, 1 << 12, 32
PARTS = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.large_string()), ("loss", pa.list_(pa.int64()))])
PARTS_DDL = "conv_id bigint, part bigint, n_turns bigint, formatted string, loss array<bigint>"
DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
DIGEST_DDL = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
#: Runs are possessive: nothing is kept for going back, whatever the length.
_TURN = re.compile(rb"<turn>([^\\<\n]*+(?:\\.[^\\<\n]*+)*+)\n([^\\<]*+(?:\\.[^\\<]*+)*+)</turn>\n", re.DOTALL)


def _filled(column: pa.Array) -> pa.Array:
    return pc.fill_null(column.cast(pa.large_string()), "")


def escape(texts: pa.Array) -> pa.Array:
    return pc.replace_substring(pc.replace_substring(texts, "\\", "\\\\"), "<", "\\<")


def unescape(role: bytes) -> bytes:
    return _plain(role, {b"\\<": b"<", b"\\n": b"\n"})


def unescape_text(text: bytes) -> bytes:
    return _plain(text, {b"\\<": b"<"})


def _plain(text: bytes, escapes: dict[bytes, bytes]) -> bytes:
    """Pairs of backslashes come first; a byte that UTF-8 hasn't stands for them until the other escapes are gone."""
    if b"\\" not in text:
        return text
    text = text.replace(b"\\\\", b"\xff")
    for escaped, plain in escapes.items():
        text = text.replace(escaped, plain)
    return text.replace(b"\xff", b"\\")


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The data of a large_string column and the offsets of its values, with its own slice taken into account."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.array([], np.uint8)), at


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One buffer with all turns, the offsets of the turns in it, and start and end of each text in it."""
    n = len(roles)
    roles, texts = pc.replace_substring(escape(roles), "\n", "\\n"), escape(texts)
    (role_data, role_at), (text_data, text_at) = _bytes_of(roles), _bytes_of(texts)
    fixed = np.frombuffer(MARK + AFTER_ROLE + END, np.uint8)
    source = np.concatenate([fixed, role_data, text_data])
    # Five segments a turn: where each starts in source, and how long it is.
    first, length = np.empty((n, 5), np.int64), np.empty((n, 5), np.int64)
    first[:, 0], length[:, 0] = 0, len(MARK)
    first[:, 1], length[:, 1] = role_at[:-1] + len(fixed), np.diff(role_at)
    first[:, 2], length[:, 2] = len(MARK), len(AFTER_ROLE)
    first[:, 3], length[:, 3] = text_at[:-1] + len(fixed) + len(role_data), np.diff(text_at)
    first[:, 4], length[:, 4] = len(MARK) + len(AFTER_ROLE), len(END)
    offsets = np.concatenate([[0], np.cumsum(length.ravel())])
    out = np.empty(int(offsets[-1]), np.uint8)
    # Byte j of the output is byte j + shift of the source, where shift is constant over a segment.
    shift, sizes = first.ravel() - offsets[:-1], length.ravel()
    long = np.flatnonzero(sizes >= LONG).tolist()
    for a, b in zip([0, *(k + 1 for k in long)], [*long, n * 5], strict=True):
        for c in range(a, b, STEP):
            d = min(c + STEP, b)
            low, high = int(offsets[c]), int(offsets[d])
            out[low:high] = source[np.arange(low, high) + np.repeat(shift[c:d], sizes[c:d])]
    for k in long:
        out[offsets[k] : offsets[k + 1]] = source[first.ravel()[k] : first.ravel()[k] + sizes[k]]
    return out, offsets[::5], np.stack([offsets[3:-1:5], offsets[4::5]], axis=1)


def points_until(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """How many code points start before each of the places, which ascend and differ."""
    if not len(data):
        return np.zeros(len(places), np.int64)
    begins = ((data & 0xC0) != 0x80).view(np.uint8)  # a code point starts at each byte that isn't a continuation
    starts = np.concatenate([[0], places[(places > 0) & (places < len(data))]])
    counts = np.concatenate([[0], np.cumsum(np.add.reduceat(begins, starts, dtype=np.int64))])
    return counts[np.searchsorted(np.append(starts, len(data)), places)]


def format_chat(turns: DataFrame) -> DataFrame:
    """conv_id, part, n_turns, formatted and loss; a conversation's parts are in the order of part, with gaps.

    loss holds start, end, start, end and so on of what is learned, in code points of the part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId() << 32
        for batch in slices(batches, "text"):
            if not batch.num_rows:
                continue
            ids, roles = batch.column("conv_id").to_pylist(), _filled(batch.column("role"))
            out, at, texts = assemble(roles, _filled(batch.column("text")))
            learned = pc.equal(roles, LEARNED).to_numpy(zero_copy_only=False)
            cuts = [0, *(i for i in range(1, len(ids)) if ids[i] != ids[i - 1]), len(ids)]
            places = np.unique(np.concatenate([at[cuts], texts[learned].ravel()]))
            points = points_until(out, places)
            points_at = lambda x: points[np.searchsorted(places, x)]  # noqa: B023, E731
            parts, loss = [], []
            for a, b in zip(cuts, cuts[1:], strict=False):
                parts.append(part)
                part += 1
                loss.append((points_at(texts[a:b][learned[a:b]]) - points_at(at[a])).ravel().tolist())
            offsets = at[cuts].astype(np.int64)
            formatted = pa.LargeStringArray.from_buffers(len(parts), pa.py_buffer(offsets), pa.py_buffer(out))
            yield rows(PARTS, conv_id=[ids[a] for a in cuts[:-1]], part=parts, n_turns=[b - a for a, b in zip(cuts, cuts[1:], strict=False)], formatted=formatted, loss=loss)

    own = text_of(turns, "conv_id", "turn", "role", "text").select(F.col("conv_id").cast("bigint"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = own.repartitionByRange(partitions(turns.sparkSession), "conv_id", "turn", F.left("role", F.lit(DEALT_BY)), F.left("text", F.lit(DEALT_BY)))
    return dealt.sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text").mapInArrow(run, PARTS_DDL)


def parse(formatted: bytes) -> list[tuple[bytes, bytes]]:
    """Roles and texts of formatted turns, unescaped."""
    return [(unescape(role), unescape_text(text)) for role, text in _TURN.findall(formatted)]


def n_points(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def places_of(data: np.ndarray, points: list[int]) -> tuple[int, list[int]]:
    """How many code points there are, and the byte at which each of the ascending numbers of points starts."""
    begins = (data & 0xC0) != 0x80
    n = int(np.count_nonzero(begins))
    if n == len(data):
        return n, points
    out, at, block, seen = [], 0, 1 << 20, 0
    for p in points:
        while at < len(data) and seen + (here := int(np.count_nonzero(begins[at : at + block]))) <= p:
            seen, at = seen + here, at + block
        inside = np.flatnonzero(begins[at : at + block])
        out.append(at + int(inside[p - seen]) if p - seen < len(inside) else len(data))
    return n, out


def read_back(parts: DataFrame) -> DataFrame:
    """conv_id, n_turns and the digests of turns and of learned text, from formatted parts, read in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = object(), None

        def out() -> pa.RecordBatch:
            return rows(DIGEST, conv_id=[current], n_turns=[state[0]], turns_sha256=[state[1].hexdigest()], loss_chars=[state[2]], loss_sha256=[state[3].hexdigest()], formatted_chars=[state[4]])

        for batch in batches:
            done, formatted = [], batch.column("formatted").cast(pa.large_binary())
            for i, (conv_id, loss) in enumerate(zip(batch.column("conv_id").to_pylist(), batch.column("loss").to_pylist(), strict=True)):
                if conv_id != current or not state:
                    if state:
                        done.append(out())
                    current, state = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                text = formatted[i].as_py()
                for m in _TURN.finditer(text):
                    state[0] += 1
                    for piece in (unescape(m[1]), b"\n", unescape_text(m[2]), b"\n"):
                        state[1].update(piece)
                data = np.frombuffer(text, np.uint8)
                n, places = places_of(data, loss)
                for a, b in zip(places[::2], places[1::2], strict=True):
                    learned = unescape_text(text[a:b])
                    state[2] += n_points(np.frombuffer(learned, np.uint8))
                    state[3].update(learned)
                state[4] += n
            yield from done
        if state:
            yield out()

    own = parts.select("conv_id", "part", "formatted", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return own.mapInArrow(run, DIGEST_DDL)


def chat_digests(turns: DataFrame) -> DataFrame:
    return read_back(format_chat(turns))
