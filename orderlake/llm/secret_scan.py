"""Secrets in texts: known shapes, and stretches of high entropy in candidate strings.

A candidate is a maximal run of one character class. A window slides over it,
and the counts of its characters change by one that enters and one that leaves;
the window's Shannon entropy follows from a running sum of ``c * log2(c)``, held
as whole millionths, so that it is the same whatever way a window was reached.
Hot windows that overlap or touch are one span. Spans that the allow list knows
are suppressed, and those inside a span of a known shape add nothing.

Rows are scanned where they lie: no shuffle, and time and memory are linear in
the text, however long a candidate is.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import only

#: Kinds of known shapes, in order; a match fails if its group is shorter than told.
SHAPES = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
)


@dataclass(frozen=True)
class CharacterClass:
    """Candidates: runs of ``characters``. Hot: windows of ``window`` code points with ``bits`` of entropy or more a character."""

    kind: str
    characters: str
    window: int
    bits: float

    @property
    def limit(self) -> int:
        """The running sum up to which a window is hot."""
        return math.floor(self.window * (math.log2(self.window) - self.bits) * 1_000_000)


def weight(c: int) -> int:
    """What ``c`` equal characters add to the running sum."""
    return round(c * math.log2(c) * 1_000_000) if c > 1 else 0


#: Random strings of these classes have some 3.6 and 4.2 bits in windows of 24; words and names run together have less.
CLASSES = (
    CharacterClass("hex_entropy", "0-9A-Fa-f", 24, 3.2),
    CharacterClass("base64_entropy", "A-Za-z0-9+/_=-", 24, 4.0),
)

#: A span whose whole text is one of these shapes is suppressed: numbers, names joined by signs, UUIDs.
ALLOW_WHOLE = (r"[0-9+/_=-]+", r"[A-Za-z]+([+/_=-]+[A-Za-z]+)+", r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
#: So is one that holds one of these: fill-ins and the alphabet.
ALLOW_INSIDE = (r"(?i:example|sample|dummy|placeholder|changeme|xxxxxx|your_|abcdefghij|0123456789)",)
#: So is one whose candidate string stands after one of these: addresses, checksums, embedded files.
ALLOW_BEFORE = (r"://[^ \t\r\n]*", r"(?i:sha1|sha224|sha256|sha384|sha512|md5)[ ]?[:=-][ ]?", r";base64,")
#: So is one whose candidate string begins with one of these: checksums.
ALLOW_START = (r"(?i:sha1|sha224|sha256|sha384|sha512|md5)[=_-]",)
#: As many code points before a candidate are looked at.
BEFORE = 200


def hot_spans(text: str, size: int, limit: int) -> list[tuple[int, int]]:
    """Where windows of ``size`` characters have a running sum of at most ``limit``; overlapping and touching ones as one."""
    counts: dict[str, int] = {}
    weights = [weight(c) for c in range(size + 1)]
    spans: list[tuple[int, int]] = []
    total = 0
    for i, c in enumerate(text):
        if i >= size:
            n = counts[text[i - size]]
            counts[text[i - size]] = n - 1
            total += weights[n - 1] - weights[n]
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += weights[n + 1] - weights[n]
        if i >= size - 1 and total <= limit:
            start = i - size + 1
            if spans and start <= spans[-1][1]:
                spans[-1] = spans[-1][0], i + 1
            else:
                spans.append((start, i + 1))
    return spans


class Scanner:
    """Finds the spans (kind, start, end) of one text, in code points, by start and then kind as listed."""

    def __init__(self, classes=CLASSES, whole=ALLOW_WHOLE, inside=ALLOW_INSIDE, before=ALLOW_BEFORE, start=ALLOW_START):
        self._classes = [(c, re.compile(f"[{c.characters}]{{{c.window},}}")) for c in classes]
        self._whole = re.compile("|".join(f"(?:{p})" for p in whole)) if whole else None
        self._inside = re.compile("|".join(f"(?:{p})" for p in inside)) if inside else None
        self._before = re.compile("(?:" + "|".join(f"(?:{p})" for p in before) + r")\Z") if before else None
        self._start = re.compile("|".join(f"(?:{p})" for p in start)) if start else None
        self._order = {k: i for i, k in enumerate([s[0] for s in SHAPES] + [c.kind for c in classes])}

    def _allowed(self, found: str, before: str) -> bool:
        return bool(
            (self._whole and self._whole.fullmatch(found)) or (self._inside and self._inside.search(found)) or (self._before and self._before.search(before))
        )

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        base = []
        for kind, pattern, group, least in SHAPES:
            base += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if len(m[group]) >= least]
        out = list(base)
        for one, pattern in self._classes:
            for run in pattern.finditer(text):
                before = None
                if self._start and self._start.match(run[0]):
                    continue
                for start, end in hot_spans(run[0], one.window, one.limit):
                    start, end = start + run.start(), end + run.start()
                    if any(s <= start and end <= e for _, s, e in base):
                        continue
                    if before is None:
                        before = text[max(0, run.start() - BEFORE) : run.start()]
                    if not self._allowed(text[start:end], before):
                        out.append((one.kind, start, end))
        return sorted(out, key=lambda x: (x[1], self._order[x[0]]))


def find_secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **lists) -> DataFrame:
    """The id column and ``spans``: an array of (kind, start, end, text) for each row, empty if nothing is found.

    Whole texts are scanned; a null text is an empty one. Rows stay as they lie:
    null and repeated ids and texts give rows of their own, further columns of
    any name are left out. ``lists``: the parameters of ``Scanner``.
    """
    schema = f"`{id_column}` {dict(docs.dtypes)[id_column]}, spans array<struct<kind:string,start:int,end:int,text:string>>"

    def run(batches):
        import pyarrow as pa

        scanner = Scanner(**lists)
        spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())]))
        for batch in batches:
            found = []
            for text in batch.column(1):
                text = text.as_py() or ""
                found.append([{"kind": k, "start": s, "end": e, "text": text[s:e]} for k, s, e in scanner.spans(text)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, spans_type)], [id_column, "spans"])

    return only(docs, id_column, text_column).mapInArrow(run, schema)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_digests(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Numbers of spans of the known shapes, a digest of these spans, and all spans as text."""
    kinds = [s[0] for s in SHAPES]
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return found.select(
        id_column, *[number(k).alias(f"n_{k}") for k in kinds], F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans")
    )
