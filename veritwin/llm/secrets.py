"""Secret scan: three shapes of secrets, and windows of high Shannon entropy.

The entropy of a window is log2(W) - S / W, where S is the sum of c * log2(c) over the counts c of its
characters. Sliding the window by one character changes two counts, so S is updated, never recomputed.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame

from .common import scan

ASSIGN = re.compile(
    r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
#: A text without any of these has no assignment; looked up before the pattern runs.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the maximal runs of 24 and more; shorter runs would be dropped anyway
KINDS = {"assign": 0, "access": 1, "hex": 2, "entropy": 3}


class CharClass(NamedTuple):
    """An alphabet, the window over it and the bits a window must reach."""

    name: str
    run: str
    window: int
    bits: float


#: Random characters reach about 3.4 (hex), 3.8 (base32) and 4.05 bits (base64) in 20 characters.
CLASSES = (
    CharClass("hex", r"[0-9A-F]{20,}|[0-9a-f]{20,}", 20, 3.0),
    CharClass("base32", r"[A-Z2-7]{20,}", 20, 3.4),
    CharClass("base64", r"[A-Za-z0-9+/_=-]{20,}", 20, 3.6),
)
#: A word or short number. It is never empty and nothing of it is given back, so a run of separators is read in one way.
WORD = r"(?:[A-Za-z]++|[0-9]{1,4}(?![0-9]))"
#: Strings that look random and are not secrets; each must match the whole candidate.
ALLOW = (
    r"[0-9]+",  # numbers
    rf"(?:{WORD})?(?:[+/_=-]++{WORD})*+[+/_=-]*+",  # words, paths, identifiers, dates, rules
    r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}",  # UUIDs
    r"(.{1,8}?)\1+.{0,7}",  # one short string again and again
    r"(?i:[a-z0-9+/_=-]*(?:example|placeholder|changeme|dummy|xxxx)[a-z0-9+/_=-]*)",
    r"(?i:sha(?:1|256|384|512)[-=][a-z0-9+/=]+)",  # digests that name themselves
)


def windows(text: str, size: int, bits: float) -> list[tuple[int, int]]:
    """Merged windows of ``size`` characters whose entropy is ``bits`` or more."""
    gain = [0.0] + [c * math.log2(c) for c in range(1, size + 1)]
    limit = size * (math.log2(size) - bits) + 1e-9  # entropy >= bits is the same as sum <= limit
    counts: dict[str, int] = {}
    total, out = 0.0, []
    for n, ch in enumerate(text):
        c = counts.get(ch, 0)
        if n >= size:
            old = text[n - size]
            k = counts[old]
            counts[old] = k - 1
            total += gain[k - 1] - gain[k]
            c = counts.get(ch, 0)
        counts[ch] = c + 1
        total += gain[c + 1] - gain[c]
        if n >= size - 1 and total <= limit:
            start = n - size + 1
            if out and start <= out[-1][1]:
                out[-1] = (out[-1][0], n + 1)
            else:
                out.append((start, n + 1))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches per kind; failing matches are dropped and not tried again."""
    out = []
    folded = text.lower()
    if any(w in folded for w in ASSIGN_WORDS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return out + [("hex", *m.span()) for m in HEX.finditer(text)]


class Scanner:
    """Compiled classes and allow-list; ``allow`` adds patterns to the built-in ones."""

    def __init__(self, classes: Iterable[CharClass] = CLASSES, allow: Iterable[str] = ()):
        self.classes = [(re.compile(c.run), c) for c in classes]
        self.allow = re.compile("|".join(f"(?:{p})" for p in _numbered((*ALLOW, *allow))))

    def entropy_spans(self, text: str) -> list[tuple[int, int]]:
        """Merged over all classes, in order."""
        found = []
        for run, c in self.classes:
            for m in run.finditer(text):
                word = m[0]
                if not self.allow.fullmatch(word):
                    found += [(m.start() + a, m.start() + b) for a, b in windows(word, c.window, c.bits)]
        out: list[tuple[int, int]] = []
        for a, b in sorted(found):
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], max(b, out[-1][1]))
            else:
                out.append((a, b))
        return out

    def spans(self, text: str) -> tuple[list, list]:
        """Base spans, and those with the entropy spans that no base span contains."""
        base = sorted(base_spans(text), key=lambda s: (s[1], KINDS[s[0]]))
        more = [
            ("entropy", a, b) for a, b in self.entropy_spans(text) if not any(s <= a and b <= e for _, s, e in base)
        ]
        return base, sorted(base + more, key=lambda s: (s[1], KINDS[s[0]]))


def _numbered(patterns: tuple[str, ...]) -> list[str]:
    """Back references of joined patterns point at their own groups."""
    out, groups = [], 0
    for p in patterns:
        out.append(re.sub(r"\\([1-9])", lambda m, g=groups: f"\\{int(m[1]) + g}", p))
        groups += re.compile(p).groups
    return out


def find_secrets(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    classes: Iterable[CharClass] = CLASSES,
    allow: Iterable[str] = (),
) -> DataFrame:
    """One row per row of ``docs``: doc_id and the spans of its secrets, base and all, in code points.

    A null text is empty and has no spans. Repeated rows get a row each, null ids stay null, an
    empty table gives an empty result, other columns are ignored. A text is scanned whole; no
    state outlives a document.
    """
    scanner = Scanner(classes, allow)
    span = "array<struct<kind:string,start:int,end:int>>"

    def fn(batches):
        for ids, texts in batches:
            both = [scanner.spans(t or "") for t in texts]
            yield ids, *([[dict(zip(("kind", "start", "end"), s)) for s in b[k]] for b in both] for k in (0, 1))

    kind = docs.schema[doc_id].dataType.simpleString()
    return scan(docs, {"doc_id": doc_id, "text": text}, fn, f"doc_id {kind}, base {span}, spans {span}")

