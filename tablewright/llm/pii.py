"""Personal data in text: patterns propose spans, checksums confirm them, context adjusts a score.

Base kinds and their rules are fixed: email, ip, card, phone (see `BASE`).  Leftmost matches that do
not overlap one of their kind; a match that fails its check is dropped and not tried again.  Base spans
stay whatever their score.  Further kinds (`EXTRA`) are kept when their score reaches `THRESHOLD`:
a pattern starts with its own score, a passing checksum (mod 97 for IBANs) adds to it, and so do words
nearby that name such data (`CONTEXT`); a failing checksum drops the match.  An extra span is not
reported where a base span already covers it, nor where another extra span covers all its letters and digits;
other overlaps are reported, and masked as one.

Spans count code points, end exclusive.  Null and empty texts have none.  Repeated rows are each
searched; an empty table gives an empty result; other columns pass through `masked` unchanged.

Each pattern is linear in the text: emails are found from their `@` outwards, ip matches begin where a
run of digits begins (a match can begin nowhere else), and the others consume a run once.  Extra spans find
the spans they may repeat by bisection.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import arrow_stage
from .words import slices

# The base kinds in the order in which spans are listed.
BASE = ("email", "ip", "card", "phone")
# Words near a span that make personal data likelier.
CONTEXT = {
    "email": ("mail", "contact", "write", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "adresse"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta", "pay"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "anruf"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security"),
    "secret": ("token", "secret", "password", "passwd", "api", "key", "auth", "bearer", "credential"),
}
REACH = 40  # code points on either side in which context words count
THRESHOLD = 0.6

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_NEAR = re.compile(r"[^\W\d_]+")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 13616: first four characters to the end, letters as 10 to 35, remainder 1."""
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            done = match.end()
            yield start, done
        else:
            # the run was looked at once; what follows the @ cannot reach back over it
            done = max(done, at + 1) if start == at else done
        at = text.find("@", max(at + 1, done))


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            yield m.span()


FINDERS: dict[str, Callable[[str], Iterator[tuple[int, int]]]] = {"email": emails, "ip": ips, "card": cards, "phone": phones}
CHECKED = {"email": 0.6, "ip": 0.6, "card": 0.9, "phone": 0.6}  # score without context

# pattern (its last group is the span), score on its own, and checksum
EXTRA: list[tuple[str, re.Pattern, float, Callable[[str], bool] | None]] = [
    ("iban", re.compile(r"(?<![A-Za-z0-9])([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])"), 0.4, lambda s: mod97(s.replace(" ", ""))),
    ("ssn", re.compile(r"(?<![0-9-])((?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4})(?![0-9-])"), 0.4, None),
    ("secret", re.compile(r"(?<![A-Za-z0-9])(AKIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,}|[0-9a-f]{32,})(?![A-Za-z0-9])"), 0.4, None),
]
# a value behind a name for secrets needs a digit, but no shape of its own
_ASSIGNED = ("secret", re.compile(r"(?:password|passwd|secret|token|api[_-]?key)[\"']?[ ]{0,3}[:=][ ]{0,3}[\"']?([^\s\"']{6,})", re.I), 0.2,
             lambda s: _HAS_DIGIT.search(s) is not None)
_HAS_DIGIT = re.compile(r"[0-9]")
_HEX_LETTERS = re.compile(r"[a-f]{32}")
_MARK = re.compile(r"[^\W_]")
_OWN_PREFIX = ("AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-")
_EXTRA_ORDER = ("iban", "ssn", "secret")


def context(text: str, kind: str, start: int, end: int) -> float:
    near = text[max(0, start - REACH) : start] + " " + text[end : end + REACH]
    words = CONTEXT[kind]
    return 0.3 if any(w.lower().startswith(words) for w in _NEAR.findall(near)) else 0.0


def repeats(text: str, start: int, end: int, taken: tuple[list[int], list[int]]) -> bool:
    """Whether one of the spans taken, apart and in order, covers all letters and digits from `start` to `end`."""
    mark = _MARK.search(text, start, end)
    first = mark.start() if mark else end
    k = bisect_right(taken[1], start)
    # a span that begins behind the first of them cannot cover it
    while k < len(taken[0]) and taken[0][k] < end and taken[0][k] <= first:
        if _MARK.search(text, max(start, taken[1][k]), end) is None:
            return True
        k += 1
    return False


def find(text: str) -> list[Span]:
    """All spans of a text, base kinds first, each kind by start."""
    spans = []
    for kind in BASE:
        for start, end in FINDERS[kind](text):
            spans.append(Span(kind, start, end, min(1.0, CHECKED[kind] + context(text, kind, start, end))))
    base = sorted((s.start, s.end) for s in spans)
    starts = [a for a, _ in base]
    reach = list(accumulate((b for _, b in base), max))  # the furthest end up to here
    # all of these hold a digit, a prefix of their own or a long run of hexadecimal letters
    likely = _HAS_DIGIT.search(text) or any(p in text for p in _OWN_PREFIX) or _HEX_LETTERS.search(text)
    rules = [*(EXTRA if likely else ()), *([_ASSIGNED] if "=" in text or ":" in text else ())]
    taken: list[tuple[list[int], list[int]]] = []  # starts and ends by rule; those of one rule are apart and in order
    for kind, pattern, score, check in rules:
        own: tuple[list[int], list[int]] = ([], [])
        for m in pattern.finditer(text):
            start, end = m.span(m.lastindex)
            value = text[start:end]
            worth = score + (0.3 if value.startswith(_OWN_PREFIX) else 0.0)
            if check is not None:
                if not check(value):
                    continue
                worth += 0.5
            worth = min(1.0, worth + context(text, kind, start, end))
            before = bisect_right(starts, start)
            if worth < THRESHOLD or before and end <= reach[before - 1]:
                continue
            if not any(repeats(text, start, end, spans_of) for spans_of in taken):
                spans.append(Span(kind, start, end, worth))
                own[0].append(start)
                own[1].append(end)
        taken.append(own)
    extra = len(base)
    spans[extra:] = sorted(spans[extra:], key=lambda s: (_EXTRA_ORDER.index(s.kind), s.start))
    return spans


def listed(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def _texts(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    for lo, hi, _ in slices(column):
        yield lo, [t or "" for t in column.slice(lo, hi - lo).to_pylist()]


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and spans of every row."""

    def search(batch: pa.RecordBatch) -> Iterator[dict]:
        keys, column = batch.columns
        for lo, texts in _texts(column):
            found = [find(t) for t in texts]
            base = [[s for s in f if s.kind in FINDERS] for f in found]
            yield {
                "doc_id": keys.slice(lo, len(texts)),
                **{f"n_{k}": [sum(s.kind == k for s in f) for f in base] for k in BASE},
                "base_sha256": [hashlib.sha256(listed(f).encode()).hexdigest() for f in base],
                "spans": [listed(f) for f in found],
                "n_extra": [len(f) - len(b) for f, b in zip(found, base, strict=True)],
                "top_score": [max((s.score for s in f), default=0.0) for f in found],
            }

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_extra long, top_score double"
    return arrow_stage(docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")), schema, search)


def mask(text: str) -> str:
    """The text with every span replaced by its kind; spans that touch the same place become one."""
    out, done = [], 0
    for s in sorted(find(text), key=lambda s: (s.start, -s.end)):
        if s.start >= done:
            out += [text[done : s.start], f"<{s.kind.upper()}>"]
        done = max(done, s.end)
    out.append(text[done:])
    return "".join(out)


def masked(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """`docs` with masked texts; null stays null, and `length` (where there is one) is made to fit."""
    names = docs.columns
    at = names.index(text)
    size = names.index(length) if length in names else -1

    def rewrite(batch: pa.RecordBatch) -> Iterator[dict]:
        for lo, texts in _texts(batch.column(at)):
            part = batch.slice(lo, len(texts))
            columns = dict(zip(names, part.columns, strict=True))
            there = part.column(at).is_valid().to_pylist()
            new = [mask(t) if ok else None for t, ok in zip(texts, there, strict=True)]
            columns[text] = new
            if size >= 0:
                columns[names[size]] = [len(t) if t is not None else old for t, old in zip(new, part.column(size).to_pylist(), strict=True)]
            yield columns

    return arrow_stage(docs, docs.schema, rewrite)
