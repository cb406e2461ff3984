"""Secret scans with multipart credential linking.

Three strict kinds of span are always reported. Weaker ones (access
identifiers, opaque secrets, endpoints) are common in harmless text, so a weak
span counts only if a complementary part stands within its scope: an interval
join of the parts of a document, sorted by place, that looks for the nearest
complement on either side and so stays linear after sorting.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm._common import slices

#: Code points between two parts of one credential at most.
SCOPE = 300

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Words without one of which ASSIGN cannot match.
ASSIGN_HINTS = ("passw", "secret", "token", "api")

WEAK_ACCESS = re.compile(r"""\b(?:client|user|account|login|access)[_-]?(?:id|name|key)?["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{4,})""", re.ASCII | re.IGNORECASE)
WEAK_SECRET = re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[a-z0-9+/_-]*[A-Z])[A-Za-z0-9+/_-]{20,}={0,2}", re.ASCII)
URL = re.compile(r"""\b(?:https?|postgres(?:ql)?|mysql|mongodb|redis|amqp|ftp)://[^\s"'<>]+""", re.ASCII)
#: A chain of three labels at least, matched once as a whole; then its end is looked for.
CHAIN = re.compile(r"(?<![a-z0-9-])[a-z0-9-]++(?:\.[a-z0-9-]++){2,}+")
TOP = re.compile(r"(?:com|net|org|io|internal|local)(?::[0-9]{2,5})?\b", re.ASCII)
BEGIN = re.compile(r"\b[a-z0-9-]", re.ASCII)

KINDS = ("assign", "access", "hex", "weak_access", "weak_secret", "endpoint")


class Span(NamedTuple):
    start: int
    rank: int
    end: int

    def __str__(self) -> str:
        return f"{KINDS[self.rank]}:{self.start}:{self.end}"


def strict_spans(text: str) -> list[Span]:
    """The three strict kinds: leftmost non-overlapping matches of each, too short ones dropped."""
    found = []
    lowered = text.lower()
    if any(h in lowered for h in ASSIGN_HINTS):
        found += [Span(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [Span(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [Span(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def hosts(text: str, low: int, high: int) -> Iterator[tuple[int, int]]:
    """(start, end) of host names in a part of a text: labels, two at least, before the last top level of their chain. Linear in the part."""
    for m in CHAIN.finditer(text, low, high):
        starts = [m.start()]
        while (dot := text.find(".", starts[-1], m.end())) >= 0:
            starts.append(dot + 1)
        for k in range(len(starts) - 1, 1, -1):
            if top := TOP.match(text, starts[k], high):
                begin = BEGIN.search(text, m.start(), starts[k - 1])
                # Two whole labels must lie between the begin and the top level.
                if begin and begin.start() < starts[k - 1]:
                    yield begin.start(), top.end()
                break


def endpoints(text: str) -> list[tuple[int, int]]:
    """URLs, and host names between them."""
    urls = [m.span() for m in URL.finditer(text)]
    found = list(urls)
    at = 0
    for start, end in [*urls, (len(text), len(text))]:
        found += hosts(text, at, start)
        at = end
    return found


def weak_spans(text: str) -> list[Span]:
    """Candidates that need a complementary part nearby."""
    found = []
    if "=" in text or ":" in text:
        found += [Span(m.start(1), 3, m.end(1)) for m in WEAK_ACCESS.finditer(text)]
    found += [Span(m.start(), 4, m.end()) for m in WEAK_SECRET.finditer(text)]
    if "://" in text or ".com" in text or ".net" in text or ".org" in text or ".io" in text or ".internal" in text or ".local" in text:
        found += [Span(start, 5, end) for start, end in endpoints(text)]
    return found


#: Which part of a credential each kind is, and which parts complete a weak one.
ROLE = ("secret", "access", "secret", "access", "secret", "endpoint")
NEEDS = {3: ("secret",), 4: ("access", "endpoint"), 5: ("secret",)}


def linked(strict: list[Span], weak: list[Span], scope: int = SCOPE) -> list[Span]:
    """The weak spans with a complementary part within ``scope``; overlapping parts don't complete each other."""
    by_role: dict[str, list[Span]] = {"access": [], "secret": [], "endpoint": []}
    for s in sorted(strict + weak):
        by_role[ROLE[s.rank]].append(s)
    starts = {role: [s.start for s in own] for role, own in by_role.items()}
    ends = {role: sorted(s.end for s in own) for role, own in by_role.items()}

    def near(span: Span, role: str) -> bool:
        after = bisect_left(starts[role], span.end)
        if after < len(starts[role]) and starts[role][after] - span.end <= scope:
            return True
        # Of the parts that don't run into this one, the furthest end before it; their lengths don't matter.
        before = bisect_right(ends[role], span.start)
        return before > 0 and span.start - ends[role][before - 1] <= scope

    return [s for s in weak if any(near(s, role) for role in NEEDS[s.rank])]


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked) for each row of ``docs``.

    Spans are kind:start:end in code points, end exclusive, by start and then
    kind. ``spans`` holds the strict ones and the weak ones that linking
    confirmed. Nulls: a null text is empty; a null doc_id keeps its row.
    Repeated rows repeat. Only doc_id and text are read.
    """
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_linked long"

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts, digests, spans, confirmed = [], [], [], []
            for text in batch.column("text").to_pylist():
                text = text or ""
                strict = strict_spans(text)
                weak = weak_spans(text)
                more = linked(strict, weak, scope) if weak else []
                counts.append([sum(s.rank == k for s in strict) for k in range(3)])
                digests.append(hashlib.sha256(",".join(map(str, strict)).encode()).hexdigest())
                spans.append(",".join(map(str, sorted(strict + more))))
                confirmed.append(len(more))
            columns = [batch.column("doc_id"), *(pa.array([c[k] for c in counts], pa.int64()) for k in range(3)), pa.array(digests), pa.array(spans), pa.array(confirmed, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in schema.split(", ")])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(find, schema)
