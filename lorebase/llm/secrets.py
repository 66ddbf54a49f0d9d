"""Secret scans with linking of credentials that come in several parts.

Strong findings stand for themselves: assignments to a secret's name, access key ids, and long runs of hex digits. Weak candidates
are parts that mean nothing alone: identifiers (a user, client or account name that is assigned), secrets (short assigned values
and tokens that mix letters and digits), and endpoints (URLs, and hosts that are assigned). They are reported only where parts
that complement each other stand in one scope, a stretch without a blank line, and belong together there: at most REACH characters
apart, or, whatever the distance, in one structure, which is a run of `name: value` lines or an object in braces with all it
holds. These are an identifier and a secret, and the endpoints that belong to one of the two.

Linking is an interval join within a document: the parts of a scope are sorted by place, and each looks for the nearest
complementary interval before (by the furthest end so far) and after it by bisection, and whether its line run, an object around it or one
inside its own object holds a complement is a flag of that structure; so many parts cost n log n and no pairs are listed. Strong findings
take part as complements (an access key id as an identifier, the others as secrets). A document is one row, and rows don't
meet, so nothing is shuffled and no key can be hot.

Cases: a null or empty text has no findings; findings of one kind don't overlap; a weak candidate that overlaps a strong
finding is part of it and not reported; all other columns are kept by `redacted` and ignored by `scan`; repeated rows
and null ids are scanned one by one; an empty table gives an empty table.
"""

from __future__ import annotations

import bisect
import itertools
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lorebase.llm.common import Batches, by_runs, in_batches, map_batches, rows_of

# The strong kinds and what they match.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16

#: All kinds in the order in which findings of one place are listed.
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
REACH = 300
IDENTIFIER = re.compile(
    r"""\b(?:user(?:_?name|_?id)?|login|account(?:_?id)?|(?:client|tenant|access_?key|key)_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{3,})""",
    re.IGNORECASE | re.ASCII,
)
SHORT_SECRET = re.compile(r"""\b(?:pass(?:wd|word)?|pwd|pin|secret|token|auth|key)["']?\x20*[:=]\x20*["']?([^\s"',;]{4,})""", re.IGNORECASE | re.ASCII)
MIXED_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}={0,2}", re.ASCII)
ENDPOINT = re.compile(
    r"""\b[a-z][a-z0-9+.-]{1,9}://[^\s"'<>]+|\b(?:host(?:_?name)?|endpoint|server|base_?url|url)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.:/-]{4,})""",
    re.IGNORECASE | re.ASCII,
)
#: Lines that hold a name and a short value; other text on a line ends a run.
NAMED_LINE = re.compile(r"""^[\x20\t]*(?:[-*#]\x20|export\x20)?["']?[A-Za-z_][\w.-]{0,60}["']?[\x20\t]*[:=][\x20\t]*\S[^\n]{0,120}$""", re.MULTILINE | re.ASCII)
BRACE = re.compile(r"[{}]")
BLANK_LINE = re.compile(r"\n[\x20\t\r]*\n")


class Finding(NamedTuple):
    start: int
    kind: int
    end: int
    #: Where the part to be hidden starts: after the name in an assignment.
    value: int


def strong(text: str) -> list[Finding]:
    """Leftmost, non-overlapping matches of each kind; those that are too short are dropped afterwards."""
    found = [Finding(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [Finding(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [Finding(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(found)


def weak(text: str, taken: list[Finding]) -> list[Finding]:
    """Candidates outside of strong findings; of overlapping ones of a kind the leftmost and longest stays."""
    covered, ends = [f.start for f in taken], []
    for finding in taken:
        ends.append(max(finding.end, ends[-1] if ends else 0))

    def free(start: int, end: int) -> bool:
        before = bisect.bisect_left(covered, end)
        return before == 0 or ends[before - 1] <= start

    found = []
    for kind, patterns in ((3, (IDENTIFIER,)), (4, (SHORT_SECRET, MIXED_TOKEN)), (5, (ENDPOINT,))):
        spans = [
            (m.start(), -m.end(), m.start(1) if m.re.groups and m[1] is not None else m.start())
            for pattern in patterns
            for m in pattern.finditer(text)
        ]
        last = 0
        for start, end, value in sorted(spans):
            if start >= last and free(start, -end):
                found.append(Finding(start, kind, -end, value))
                last = -end
    return found


def furthest(intervals: list[Finding]) -> list[int]:
    """The largest end among the intervals up to each one; those of different kinds may overlap."""
    return list(itertools.accumulate((f.end for f in intervals), max))


def near(intervals: list[Finding], ends: list[int], part: Finding) -> bool:
    """Whether one of the intervals, in order and with their `furthest` ends, lies within reach of the part."""
    place = bisect.bisect_left(intervals, part)
    after = place < len(intervals) and intervals[place].start - part.end <= REACH
    return after or place > 0 and part.start - ends[place - 1] <= REACH


class Structure:
    """The line runs and the objects in braces of a scope."""

    def __init__(self, text: str, start: int, end: int):
        self.lines: list[tuple[int, int]] = []
        for match in NAMED_LINE.finditer(text, start, end):
            if self.lines and match.start() == self.lines[-1][1] + 1:
                self.lines[-1] = self.lines[-1][0], match.end()
            else:
                self.lines.append(match.span())
        opened, objects = [], []
        for match in BRACE.finditer(text, start, end):
            if match[0] == "{":
                opened.append(match.start())
            elif opened:
                objects.append((opened.pop(), match.end()))
        self.objects = sorted(objects)
        # The next larger object around each one; they come in the order of their starts.
        self.parents, around = [], []
        for place, (first, _) in enumerate(self.objects):
            while around and self.objects[around[-1]][1] <= first:
                around.pop()
            self.parents.append(around[-1] if around else -1)
            around.append(place)

    def line_run(self, part: Finding) -> int | None:
        place = bisect.bisect_right(self.lines, (part.start, 1 << 60)) - 1
        return place if place >= 0 and part.start < self.lines[place][1] else None

    def innermost(self, part: Finding) -> int:
        place = bisect.bisect_right(self.objects, (part.start, 1 << 60)) - 1
        while place >= 0 and self.objects[place][1] <= part.start:
            place = self.parents[place]
        return place

    def shared_with(self, others: list[Finding]) -> Callable[[Finding], bool]:
        """Whether a part shares a line run, or an object, with one of the others."""
        if not self.lines and not self.objects:
            return lambda part: False
        runs = {self.line_run(part) for part in others} - {None}
        direct = {self.innermost(part) for part in others} - {-1}
        above, inside = [], [place in direct for place in range(len(self.objects))]
        for place, parent in enumerate(self.parents):
            above.append(place in direct or (parent >= 0 and above[parent]))
        for place in range(len(self.objects) - 1, -1, -1):
            if inside[place] and self.parents[place] >= 0:
                inside[self.parents[place]] = True

        def shares(part: Finding) -> bool:
            own = self.innermost(part)
            return self.line_run(part) in runs or (own >= 0 and (above[own] or inside[own]))

        return shares


def linked(text: str, base: list[Finding]) -> list[Finding]:
    """The weak candidates with a complement within their scope and reach."""
    candidates = weak(text, base)
    if not candidates:
        return []
    borders = [m.end() for m in BLANK_LINE.finditer(text)]
    scopes: dict[int, list[Finding]] = {}
    for part in [*base, *candidates]:
        scopes.setdefault(bisect.bisect_right(borders, part.start), []).append(part)
    edges = [0, *borders, len(text)]
    found = []
    for scope, parts in scopes.items():
        identifiers = sorted(p for p in parts if p.kind in (1, 3))
        secrets = sorted(p for p in parts if p.kind in (0, 2, 4))
        if not identifiers or not secrets:
            continue
        structure = Structure(text, edges[scope], edges[scope + 1])

        def belonging(some: list[Finding], others: list[Finding]) -> list[Finding]:
            ends, shares = furthest(others), structure.shared_with(others)
            return [p for p in some if near(others, ends, p) or shares(p)]

        chosen = sorted([*belonging(identifiers, secrets), *belonging(secrets, identifiers)])
        if chosen:
            found += [p for p in chosen if p.kind > 2]
            found += belonging([p for p in parts if p.kind == 5], chosen)
    return found


def scan_text(text: str | None) -> tuple[list[Finding], list[Finding]]:
    """(strong findings, linked weak ones)."""
    base = strong(text or "")
    return base, linked(text or "", base)


def spans(findings: list[Finding]) -> str:
    return ",".join(f"{KINDS[f.kind]}:{f.start}:{f.end}" for f in sorted(findings))


def scan_step(row, schema: pa.Schema):
    def rows(batches: Batches) -> Iterator[tuple]:
        for key, text in rows_of(batches):
            yield row(key, *scan_text(text))

    return lambda batches: in_batches(rows(batches), schema)


def scan(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, findings): kind, start, end, value and whether it is strong, in order; characters, end exclusive."""
    finding = pa.struct([("kind", pa.string())] + [(n, pa.int64()) for n in ("start", "end", "value")] + [("strong", pa.bool_())])
    schema = pa.schema([("doc_id", pa.int64()), ("findings", pa.list_(finding))])

    def row(doc_id, base, more):
        ordered = sorted([*base, *more])
        return doc_id, [(KINDS[f.kind], f.start, f.end, f.value, f.kind < 3) for f in ordered]

    fields = "STRUCT<kind: STRING, start: BIGINT, end: BIGINT, value: BIGINT, strong: BOOLEAN>"
    texts = df.select(F.col(key).cast("long"), F.col(text))
    return map_batches(texts, f"doc_id BIGINT, findings ARRAY<{fields}>", scan_step(row, schema))


def hidden(text: str, mark: str) -> str:
    """The text with the value of every finding replaced by a mark; findings that touch or overlap become one."""
    base, more = scan_text(text)
    ranges: list[list[int]] = []
    for start, end in sorted((f.value, f.end) for f in [*base, *more]):
        if ranges and start <= ranges[-1][1]:
            ranges[-1][1] = max(ranges[-1][1], end)
        else:
            ranges.append([start, end])
    parts, last = [], 0
    for start, end in ranges:
        parts += [text[last:start], mark]
        last = end
    return "".join(parts) + text[last:]


def redacted(df: DataFrame, text: str = "text", length: str | None = None, mark: str = "[SECRET]") -> DataFrame:
    """`df` with the findings in `text` replaced by a mark, and the column `length`, if given, set to the new length.

    A text without findings, null included, stays as it is, and so does its length.
    """
    place, size = df.columns.index(text), df.columns.index(length) if length else None

    def step(batches: Batches) -> Batches:
        for batch in by_runs(batches, place):
            before = batch.column(place).to_pylist()
            after = [hidden(value, mark) if value else value for value in before]
            columns = list(batch.columns)
            columns[place] = pa.array(after, type=columns[place].type)
            if size is not None:
                old = columns[size].to_pylist()
                new = [o if a == b else len(a) for o, a, b in zip(old, after, before)]
                columns[size] = pa.array(new, type=columns[size].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return map_batches(df, df.schema, step)
