"""Secret scans: three base patterns, then windows of high Shannon entropy over candidate strings.

Base kinds: ``assign`` (a password-like name, a separator and a value of at least 6 characters), ``access`` (an
access key id of at least 20 characters) and ``hex`` (24 hex digits or more), each leftmost and non-overlapping.

The entropy scan takes candidate strings of at least WINDOW characters. For each character class it slides a window
over the candidate's runs of that class, keeps the counts of the characters in the window as it moves, and so the
entropy, in constant time a step. Windows at or above the class's threshold that no base span overlaps, each looked at by
itself, make the candidate, up to the nearest base spans, a span of kind ``entropy``, as half a secret left in a text
is still a leak.
A candidate that the allow-list knows is left alone. Spans count code points, the end is exclusive.

Null texts count as empty and have no spans. Repeated rows each get the same result. The empty table gives an empty
result. Only the named columns are read (``redact`` hands all others through).
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import rows, slices, text_of

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS, ACCESS_LEAST = re.compile(r"AKIA[A-Z0-9]+"), 20
HEX, HEX_LEAST = re.compile(r"[0-9a-f]+"), 24
ASSIGN_LEAST = 6
#: Runs of hex digits that are long enough: the same as the long ones among all runs.
LONG_HEX = re.compile(rf"[0-9a-f]{{{HEX_LEAST},}}")
WINDOW = 20
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}")
#: Character classes and the least entropy, in bits a character, of a window that is taken for random.
CLASSES = {
    "hex digits": (re.compile(rf"[0-9A-Fa-f]{{{WINDOW},}}"), 3.0),
    "letters and digits": (re.compile(rf"[A-Za-z0-9]{{{WINDOW},}}"), 3.8),
    "base64": (re.compile(rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}"), 4.0),
}
#: What looks random but is public: words of letters only, identifiers joined by - or _, numbers and UUIDs.
ALLOWED = [
    re.compile(r"[A-Za-z+/_=-]+"),
    re.compile(r"[0-9+/_=-]+"),
    re.compile(r"[A-Za-z]*[0-9]{0,4}(?:[-_/][A-Za-z]*[0-9]{0,4})+"),
    re.compile(r"[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}"),
]
MASK = "[REDACTED]"
SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())])
DDL = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
_CLOG = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]


def random_windows(text: str, least: float, bars: Sequence[tuple[int, int]] = ()) -> Iterator[tuple[int, int]]:
    """Windows of text, joined where they overlap, whose characters have at least that entropy; none that overlaps a bar.

    Bars are in order and don't overlap each other.
    Entropy of a window of w characters is log2 w - sum(c log2 c) / w; the sum changes by two terms a step.
    """
    counts: dict[str, int] = {}
    total, most, begun, end, bar = 0.0, (math.log2(WINDOW) - least) * WINDOW + 1e-9, -1, -1, 0
    for i, new in enumerate(text):
        c = counts.get(new, 0)
        counts[new] = c + 1
        if i >= WINDOW:
            old = text[i - WINDOW]
            total += _CLOG[c + 1] - _CLOG[c] if c < WINDOW else 0.0
            o = counts[old]
            counts[old] = o - 1
            total += _CLOG[o - 1] - _CLOG[min(o, WINDOW)] if o <= WINDOW else 0.0
        else:
            total += _CLOG[c + 1] - _CLOG[c]
        if i >= WINDOW - 1 and total <= most:
            first = i - WINDOW + 1
            while bar < len(bars) and bars[bar][1] <= first:
                bar += 1
            if bar < len(bars) and bars[bar][0] <= i:
                continue
            if begun >= 0 and first > end:
                yield begun, end
                begun = -1
            if begun < 0:
                begun = first
            end = i + 1
    if begun >= 0:
        yield begun, end


def merged(spans: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """The stretches that the spans cover, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((a, b) for a, b, _ in spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def scan(text: str) -> list[tuple[int, int, str]]:
    """Spans (start, end, kind) by start and then by kind as listed."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), m.end(), "hex") for m in LONG_HEX.finditer(text)]
    bars = merged(found)
    begins, ends = [x for x, _ in bars], [y for _, y in bars]
    for m in CANDIDATE.finditer(text):
        if any(p.fullmatch(m[0]) for p in ALLOWED):
            continue
        hits = set()
        for pattern, least in CLASSES.values():
            for run in pattern.finditer(m[0]):
                first, last = m.start() + run.start(), m.start() + run.end()
                near = bars[bisect_right(ends, first) : bisect_left(begins, last)]
                hits |= {(a + first, b + first) for a, b in random_windows(run[0], least, [(x - first, y - first) for x, y in near])}
        # A window is clear of bars, so the bar before it ends, and the one after it begins, outside of it.
        for a, b in hits:
            before, after = bisect_right(ends, a), bisect_left(begins, b)
            found.append((max(m.start(), ends[before - 1] if before else 0), min(m.end(), begins[after] if after < len(bars) else len(text)), "entropy"))
    found = list(dict.fromkeys(found))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def masked(text: str) -> str:
    """The text with each span, overlaps joined, replaced by MASK; nothing is found in the mask itself."""
    out, at = [], 0
    for a, b, _ in scan(text):
        if a >= at:
            out += [text[at:a], MASK]
        at = max(at, b)
    return "".join([*out, text[at:]])


def secret_scan(docs: DataFrame) -> DataFrame:
    """A row for each document: the counts of base spans, the digest of the base spans, and all spans."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            all_spans = [scan(x or "") for x in batch.column("text").to_pylist()]
            base = [[s for s in spans if s[2] != "entropy"] for spans in all_spans]
            counts = {f"n_{k}": [sum(s[2] == k for s in spans) for spans in base] for k in KINDS[:3]}
            yield rows(SCHEMA, doc_id=batch.column("doc_id"), base_sha256=[hashlib.sha256(listed(s).encode()).hexdigest() for s in base], spans=[listed(s) for s in all_spans], **counts)

    return text_of(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("bigint")).mapInArrow(find, DDL)


def redact(docs: DataFrame) -> DataFrame:
    """docs with the spans of its text masked and, if there is such a column, n_chars counted anew; null texts stay."""

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [x if x is None else masked(x) for x in batch.column("text").to_pylist()]
            for name, values in (("text", texts), ("n_chars", [x if x is None else len(x) for x in texts])):
                if (i := batch.schema.get_field_index(name)) >= 0:
                    batch = batch.set_column(i, batch.schema.field(i), pa.array(values, batch.schema.field(i).type))
            yield batch

    return docs.mapInArrow(mask, docs.schema)
