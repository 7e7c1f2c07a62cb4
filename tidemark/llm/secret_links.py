"""Secrets in texts: strong patterns, and weak parts that count only together.

Strong spans stand alone: assigned secrets (``assign``), access keys (``access``) and long
hexadecimal runs (``hex``). Weak parts are identifiers (``ident``), unnamed keys (``key``) and
endpoints (``endpoint``). Within a scope (a block of lines without a blank line between them) the
parts are interval-joined: a pair links if at most ``REACH`` characters lie between them. Reported
are a weak identifier with a secret in reach, a weak key with an identifier in reach, and an
endpoint in reach of both. Strong access keys serve as identifiers and strong assigned or
hexadecimal spans as secrets, and all strong spans stay. A weak part inside a strong span is part
of it and not reported.

The join runs per text over sorted intervals with one binary search a part, so one text with very
many parts is no hot key. A null text is empty. Rows are independent, so repeated
rows give repeated results and an empty table an empty one. A very long text is searched whole in one
task, with memory in proportion to its length. Columns other than doc_id, text and n_chars may have any name.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows

REACH = 200
BASE = ("assign", "access", "hex")
WEAK = ("ident", "key", "endpoint")
ORDER = {kind: i for i, kind in enumerate(BASE + WEAK)}
PLACEHOLDER = "[secret]"

_A = re.ASCII | re.IGNORECASE
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", _A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
IDENT = re.compile(
    r"""\b(?:access|account|client|tenant|user|app)[_-]?(?:key[_-]?)?(?:id|name)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{4,}|\bAKIA[A-Z0-9]{8,13}\b""",
    _A,
)
KEY = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(
    r"""\bhttps?://[^\s"'<>]{4,}|\b(?:host|endpoint|server|region)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{4,}""", _A
)
_BLANK = re.compile(r"\n[ \t\r\f\v]*\n")
_NAMES = ("passw", "secret", "token", "api_key", "apikey")
_PARTS = ("id", "name")

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """Strong spans: leftmost, non-overlapping per kind, short ones dropped."""
    found: list[Span] = []
    low = text.lower()
    if any(name in low for name in _NAMES):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def _mixed(value: str) -> bool:
    """Looks drawn at random: digits and both cases, and many different characters."""
    return (
        any(c.isdigit() for c in value) and any(c.islower() for c in value) and any(c.isupper() for c in value)
        and len(set(value)) >= 12
    )


def _furthest(ends: list[int]) -> list[int]:
    """Running maxima."""
    return list(accumulate(ends, max))


def _outside(spans: list[Span], taken: list[tuple[int, int]]) -> list[Span]:
    """The spans that overlap none of the taken intervals, which come sorted."""
    starts, reached = [s for s, _ in taken], _furthest([e for _, e in taken])
    out = []
    for span in spans:
        i = bisect_left(starts, span[1])
        if not i or reached[i - 1] <= span[0]:
            out.append(span)
    return out


class _Near:
    """Intervals of one kind, asked whether one lies within reach of another kind's in its scope.

    Of the intervals of a scope that start early enough, the one that ends last decides.
    """

    def __init__(self, spans: list[Span], scope) -> None:
        self.scope = scope
        self.starts: dict[int, list[int]] = defaultdict(list)
        ends: dict[int, list[int]] = defaultdict(list)
        for start, end, kind in sorted(spans):
            place = scope((start, end, kind))
            self.starts[place].append(start)
            ends[place].append(end)
        self.reached = {place: _furthest(e) for place, e in ends.items()}

    def __call__(self, span: Span) -> bool:
        place = self.scope(span)
        if place not in self.reached:
            return False
        i = bisect_right(self.starts[place], span[1] + REACH)
        return i > 0 and self.reached[place][i - 1] + REACH >= span[0]


def linked_spans(text: str, base: list[Span]) -> list[Span]:
    """Weak parts whose complements lie in reach within their scope."""
    low = text.lower()
    idents = [(m.start(), m.end(), "ident") for m in IDENT.finditer(text)] if "akia" in low or any(f"{p}" in low for p in _PARTS) and ("=" in low or ":" in low) else []
    keys = [(m.start(), m.end(), "key") for m in KEY.finditer(text) if _mixed(m[0])]
    if not idents and not keys and len(base) < 2:
        return []
    strong = sorted((s, e) for s, e, _ in base)
    idents, keys = _outside(idents, strong), _outside(keys, strong)
    keys = _outside(keys, sorted((s, e) for s, e, _ in idents))
    all_idents = idents + [b for b in base if b[2] == "access"]
    all_secrets = keys + [b for b in base if b[2] != "access"]
    if not all_idents or not all_secrets:
        return []
    breaks = [m.start() for m in _BLANK.finditer(text)]

    def scope(span: Span) -> int:
        return bisect_right(breaks, span[0])

    near_secret, near_ident = _Near(all_secrets, scope), _Near(all_idents, scope)
    out = [i for i in idents if near_secret(i)] + [k for k in keys if near_ident(k)]
    ends = _outside([(m.start(), m.end(), "endpoint") for m in ENDPOINT.finditer(text)], strong) if ":" in low or "=" in low else []
    ends = _outside(ends, sorted((s, e) for s, e, _ in idents + keys))
    return out + [e for e in ends if near_secret(e) and near_ident(e)]


def all_spans(text: str | None) -> tuple[list[Span], list[Span]]:
    """(strong spans, all spans), each by start and then kind as listed."""
    text = text or ""
    base = base_spans(text)
    place = lambda s: (s[0], ORDER[s[2]])
    return sorted(base, key=place), sorted(base + linked_spans(text, base), key=place)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def redact(text: str | None, spans: list[Span]) -> str | None:
    """Overlapping spans become one placeholder."""
    if not spans:
        return text
    out, at = [], 0
    for s, e, _ in sorted(spans):
        if s >= at:
            out += [text[at:s], PLACEHOLDER]
        at = max(at, e)
    return "".join([*out, text[at:]])


def _scanner():
    def work(columns: list) -> list:
        doc_id, texts = columns
        found = [all_spans(t) for t in texts]
        count = lambda k: [sum(s[2] == k for s in b) for b, _ in found]
        digest = [hashlib.sha256(joined(b).encode()).hexdigest() for b, _ in found]
        return [doc_id, *map(count, BASE), digest, [joined(a) for _, a in found]]

    return work


def scan(docs: DataFrame) -> DataFrame:
    """Counts, digest of the strong spans and all spans of every text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_rows(
        rows, _scanner,
        "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    )


def redacted(docs: DataFrame) -> DataFrame:
    """All rows and columns, spans replaced in ``text`` and ``n_chars`` brought up to date."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    place = docs.columns.index("text")

    def redactor():
        def work(columns: list) -> list:
            columns[place] = [redact(t, all_spans(t)[1]) for t in columns[place]]
            return columns

        return work

    inner = docs.toDF(*names)
    out = map_rows(inner, redactor, inner.schema)
    if "n_chars" in docs.columns:
        n, text = names[docs.columns.index("n_chars")], F.col(names[place])
        out = out.withColumn(n, F.when(text.isNotNull(), F.length(text)).otherwise(F.col(n)).cast(docs.schema["n_chars"].dataType))
    return out.toDF(*docs.columns)
