"""Secret scans (operator 5): fixed patterns plus sliding-window entropy.

Candidate strings are the maximal runs of token characters. In each run, every window of a
character class gets its Shannon entropy, computed by incremental counts: the character that enters
and the one that leaves change two terms of the sum. Windows that reach the class's threshold, hold
what the class asks for and touch no allow-listed part are joined into spans. Spans that lie inside
a pattern's span or one of an earlier class are suppressed. Patterns' spans always stay.

Whole texts are read; null texts are empty and have no spans. Offsets are code points. Rows do not
depend on one another, so ties, repeats and skew need no care; other columns pass through. All steps
are linear in the text but for sorting its spans.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import LOWER, UPPER

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
NAMES = ("passw", "secret", "token", "api")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")
WIDTH = 20
#: Entropy classes: (characters of a candidate, sets of which each window holds a character, least bits per character).
#: Thresholds: random strings of a class reach them in most windows, words and identifiers of several words seldom do.
_DIGIT, _LOW, _UP = "0123456789", LOWER, UPPER
CLASSES = {
    "hex_entropy": (re.compile(r"[0-9a-fA-F]{20,}"), (_DIGIT,), 2.9),
    "lower_entropy": (re.compile(r"[a-z0-9]{20,}"), (_DIGIT, _LOW), 3.6),
    "upper_entropy": (re.compile(r"[A-Z0-9]{20,}"), (_DIGIT, _UP), 3.5),
    "letters_entropy": (re.compile(r"[A-Za-z]{20,}"), (_LOW, _UP), 3.9),
    "mixed_entropy": (RUN, (_DIGIT, _LOW, _UP), 3.6),
}
#: Kinds of spans as listed; the first three are the patterns.
KINDS = ("assign", "access", "hex", *CLASSES)
#: Parts that mark placeholders, sample keys and counting strings.
ALLOWED = ["example", "sample", "placeholder", "changeme", "your_", "xxxx", "0000000", "1234567", "abcdefg", "sha256-", "sha512-"]


def window_entropies(run: str, width: int) -> list[float]:
    """Shannon entropy in bits of every window of width characters."""
    cost = [0.0] + [c * math.log2(c) for c in range(1, width + 1)]
    counts: dict[str, int] = {}
    total, out = 0.0, []
    for i, ch in enumerate(run):
        c = counts.get(ch, 0)
        counts[ch] = c + 1
        total += cost[c + 1] - cost[c]
        if i >= width:
            old = run[i - width]
            c = counts[old]
            counts[old] = c - 1
            total += cost[c - 1] - cost[c]
        if i >= width - 1:
            out.append(math.log2(width) - total / width)
    return out


def allowed_places(run: str, allowed: list[str]) -> tuple[list[int], list[int]]:
    """Starts of the allow-listed parts in a run, in whatever case, and for each the largest end up to it."""
    low, found = run.lower(), []
    for part in allowed:
        at = low.find(part)
        while at >= 0:
            found.append((at, at + len(part)))
            at = low.find(part, at + 1)
    found.sort()
    return [s for s, _ in found], list(accumulate((e for _, e in found), max))


def joined_windows(part: str, needs: tuple[str, ...], bits: float, starts: list[int], ends: list[int], width: int = WIDTH) -> list[list[int]]:
    """Spans of part: the windows that pass, joined where they overlap or touch. starts, ends: places that no window may touch, both ascending."""
    last, spans, k = [-1] * len(needs), [], 0
    entropies = window_entropies(part, width)
    for i, ch in enumerate(part):
        for n, chars in enumerate(needs):
            if ch in chars:
                last[n] = i
        start = i - width + 1
        if start < 0 or entropies[start] < bits or min(last) < start:
            continue
        while k < len(ends) and ends[k] <= start:
            k += 1
        if k < len(starts) and starts[k] <= i:
            continue
        if spans and start <= spans[-1][1]:
            spans[-1][1] = i + 1
        else:
            spans.append([start, i + 1])
    return spans


def entropy_spans(run: str, at: int, allowed: list[str]) -> list[tuple[str, int, int]]:
    """(kind, start, end) by class; run begins at at."""
    found, places = [], None
    for kind, (chars, needs, bits) in CLASSES.items():
        for m in chars.finditer(run):
            part = m[0]
            if any(not set(part) & set(x) for x in needs):
                continue
            if places is None:
                places = allowed_places(run, allowed)
            a, b = bisect_right(places[1], m.start()), bisect_left(places[0], m.end())
            own = [[p - m.start() for p in x[a:b]] for x in places]
            found += [(kind, at + m.start() + s, at + m.start() + e) for s, e in joined_windows(part, needs, bits, *own)]
    return found


def outside(spans: list[tuple[str, int, int]], others: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The spans that lie in none of the others, by one sweep over both."""
    others, kept, k, reach = sorted(o[1:] for o in others), [], 0, -1
    for span in sorted(spans, key=lambda x: x[1]):
        while k < len(others) and others[k][0] <= span[1]:
            reach = max(reach, others[k][1])
            k += 1
        if span[2] > reach:
            kept.append(span)
    return kept


def find_secrets(text: str, allowed: list[str] = ALLOWED) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all spans, by start, then kind as listed."""
    found, more = [], []
    low = text.lower()
    if any(n in low for n in NAMES):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    for run in RUN.finditer(text):
        part, at = run[0], run.start()
        found += [("access", at + m.start(), at + m.end()) for m in ACCESS.finditer(part) if len(m[0]) >= 20]
        found += [("hex", at + m.start(), at + m.end()) for m in HEX.finditer(part) if len(m[0]) >= 24]
        more += entropy_spans(part, at, allowed)
    for kind in CLASSES:
        if own := [x for x in more if x[0] == kind]:
            found += outside(own, found)
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


SPANS = "array<struct<kind:string,start:int,end:int>>"
_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def scan(docs: DataFrame, text: str = "text", allowed: list[str] = ALLOWED) -> DataFrame:
    """docs with a column spans (kind, start, end)."""

    @F.arrow_udf(SPANS)
    def spans(column: pa.Array) -> pa.Array:
        return pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in find_secrets(t.as_py() or "", allowed)] for t in column], _TYPE)

    return docs.withColumn("spans", spans(F.col(text).cast("string")))


def redact(docs: DataFrame, text: str = "text", allowed: list[str] = ALLOWED) -> DataFrame:
    """docs with every span of text replaced by [kind]; overlapping spans are replaced once, under the first one's kind."""

    @F.arrow_udf("string")
    def clean(column: pa.Array) -> pa.Array:
        out = []
        for t in column:
            t, parts, at = t.as_py(), [], 0
            for kind, s, e in find_secrets(t or "", allowed):
                if s >= at:
                    parts += [t[at:s], f"[{kind}]"]
                at = max(at, e)
            out.append("".join([*parts, t[at:]]) if parts else t)
        return pa.array(out, pa.string())

    return docs.withColumn(text, clean(F.col(text).cast("string")))
