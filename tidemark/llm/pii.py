"""Personal data in whole texts: patterns propose, checksums confirm, words nearby adjust the score.

A pattern proposes a span, a validator (digit counts, part sizes, Luhn, mod 97) confirms or
drops it, and words within reach of it raise or lower its score. Kinds in ``BASE`` are
found whatever their score; the others need ``least``. All patterns take linear time:
digit runs are never entered in their middle, and addresses are found from their ``@``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import fresh, whole
from tidemark.llm.words import slices

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
SPANS = "array<struct<kind:string,start:long,end:long,score:double>>"
_ANY = r"[0-9@]"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}+")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
# Score without context, words that raise it, words that lower it.
_CONTEXT = {
    "email": (0.9, ("mail", "contact", "write", "address"), ()),
    "ip": (0.6, ("ip", "host", "server", "login", "address"), ("version", "release", "section", "chapter")),
    "card": (0.7, ("card", "visa", "credit", "payment", "cvv"), ("isbn", "order", "serial")),
    "phone": (0.7, ("phone", "tel", "call", "mobile", "fax"), ("serial", "version")),
    "iban": (0.9, ("iban", "account", "bank", "transfer"), ()),
    "ssn": (0.4, ("ssn", "social", "security", "taxpayer"), ("serial", "order", "part")),
}
_STEP, _REACH = 0.2, 40


@dataclass(frozen=True)
class Settings:
    """``least``: the score that kinds outside ``BASE`` need."""

    least: float = 0.5


def luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


def mod97(account: str) -> bool:
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def _digits(span: str) -> str:
    return re.sub(r"[^0-9]", "", span)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", at + 1)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 38 and 13 <= len(digits := _digits(m[0])) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            yield m.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while m := _IBAN.search(text, at):
        span, at = m[0], m.start() + 1  # an account may begin within a rejected proposal
        while len(span.replace(" ", "")) >= 15:  # a word behind may look like a part of it
            end = m.start() + len(span)
            if mod97(span.replace(" ", "")) and not text[end : end + 1].isalnum():
                yield m.start(), end
                at = end
                break
            span = span.rpartition(" ")[0]


def _ssns(text: str) -> Iterator[tuple[int, int]]:
    for m in _SSN.finditer(text):
        if m[1] not in ("000", "666") and m[1][0] != "9" and m[2] != "00" and m[3] != "0000":
            yield m.span()


_FINDERS = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones, "iban": _ibans, "ssn": _ssns}


def score(kind: str, text: str, start: int, end: int) -> float:
    found, raising, lowering = _CONTEXT[kind]
    near = set(re.findall(r"[a-z]+", f"{text[max(0, start - _REACH) : start]} {text[end : end + _REACH]}".lower()))
    found += _STEP * any(w in near for w in raising) - _STEP * any(w in near for w in lowering)
    return round(min(1.0, max(0.0, found)), 3)


def find(text: str, settings: Settings = Settings()) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by kind, then start; places are code points, ends exclusive."""
    spans = []
    for kind in KINDS:
        for start, end in _FINDERS[kind](text):
            found = score(kind, text, start, end)
            if kind in BASE or found >= settings.least:
                spans.append((kind, start, end, found))
    return spans


def _each(texts: pa.Array, function, plain):
    """``function`` of each text that may hold something, ``plain`` of the others, a few megabytes at a time."""
    hit = pc.match_substring_regex(texts, _ANY).to_pylist()
    for a, b in slices(texts):
        for i in range(a, b):
            yield function(texts[i].as_py()) if hit[i] else plain(i)


def spans(text: str | Column, settings: Settings = Settings()) -> Column:
    """The spans of a text as ``SPANS``; none for a null or empty one."""

    @F.arrow_udf(SPANS)
    def of(texts: pa.Array) -> pa.Array:
        names = ("kind", "start", "end", "score")
        rows = [[dict(zip(names, s)) for s in found] for found in _each(texts, lambda t: find(t, settings), lambda i: [])]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        return pa.array(rows, kind)

    return of.asNondeterministic()(whole(text))


def mask(text: str, found: list[tuple[str, int, int, float]]) -> str:
    """The text with ``<KIND>`` for each span; of spans that overlap, the one that starts first names the whole."""
    out, end, last = [], 0, 0
    for kind, start, stop, _ in sorted(found, key=lambda s: (s[1], -s[2], KINDS.index(s[0]))):
        if start >= end:
            out += [text[last:start], f"<{kind.upper()}>"]
        end = last = max(end, stop)
    return "".join([*out, text[last:]])


def redact(documents: DataFrame, text: str = "text", length: str | None = None, settings: Settings = Settings()) -> DataFrame:
    """Replace the spans in the column ``text``; ``length``: a column that gets the new number of characters.

    All rows and columns stay. Null and empty texts, and texts without spans, stay as they are.
    """

    @F.arrow_udf("string")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(list(_each(pc.fill_null(texts, ""), lambda t: mask(t, find(t, settings)), lambda i: texts[i].as_py())), pa.string())

    done = fresh(documents, "redacted")
    named = documents.withColumn(done, of.asNondeterministic()(F.col(text)))
    changed = {text: F.col(done)}
    if length:
        new = F.length(done).cast(documents.schema[length].dataType)
        changed[length] = F.when(F.col(done).eqNullSafe(F.col(text)), F.col(length)).otherwise(new)
    return named.withColumns(changed).select(*documents.columns)
