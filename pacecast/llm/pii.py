"""Personal data: patterns propose, checksums confirm, context adjusts (operator 8).

Regular expressions propose spans of eight kinds. Validators then decide: Luhn
for card numbers, mod 97 for account numbers (IBAN), ranges for addresses,
digit counts for phones, entropy for secrets (keys and tokens). A span's score is its kind's prior, raised by a
checksum and by a fitting word among the ``WINDOW`` characters before or after it. The four
base kinds are kept whatever their context; the kinds the method adds (``iban``,
``short_card``, ``local_phone`` and ``secret``) are kept from ``KEEP`` on, which the latter
three only reach with a context word, and but for ``iban`` only where no base span overlaps them.

Offsets are code points, ends exclusive. A null text has no spans; repeated
rows are searched repeatedly; an empty table gives an empty table. Every
pattern runs in time proportional to the text, also on long runs of digits or
letters: local parts of addresses are found backwards from their ``@``.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, StringType, StructField,
                               StructType)

from .common import beside, map_arrow, others, slices

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "short_card", "local_phone", "secret")
#: Characters before a span, and after it, that are searched for context words.
WINDOW = 40
#: Score from which a span of an added kind is kept.
KEEP = 0.7
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.5, "phone": 0.6, "iban": 0.4, "short_card": 0.3,
         "local_phone": 0.3, "secret": 0.3}
CHECKSUM = 0.35
CONTEXT = 0.4
CONTEXT_WORDS = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "credit", "debit", "payment"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "transfer"),
    "short_card": ("card", "visa", "credit", "debit", "payment"),
    "local_phone": ("phone", "call", "tel", "mobile", "fax"),
    "secret": ("token", "key", "apikey", "secret", "password", "passwd", "credential", "credentials", "bearer", "auth"),
}
#: A secret is at least this long, and its characters tell at least so many bits each.
SECRET_LENGTH, SECRET_BITS = 20, 3.0
# Lengths of account numbers by country.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22,
    "BR": 29, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20,
    "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27,
    "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30,
    "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22,
    "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29,
    "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27,
    "TN": 24, "TR": 26, "UA": 29, "VG": 24, "XK": 20,
}

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])([A-Z]{2})[0-9]{2}(?= ?[A-Z0-9])")
IBAN_REST = {n: re.compile(rf"(?: ?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])") for n in {*IBAN_LENGTH.values()}}
LOCAL_PHONE = re.compile(r"(?<![0-9+(.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])")
SECRET = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{SECRET_LENGTH},}}+={{0,2}}(?![A-Za-z0-9])")
NOT_DIGIT = re.compile(r"[^0-9]+")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(map(int, reversed(digits))):
        double = digit * 2 if i % 2 else digit
        total += double - 9 if double > 9 else double
    return total % 10 == 0


def mod_97(account: str) -> bool:
    """Country and check digits moved to the end, letters as 10 to 35: 1 modulo 97."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def random_like(value: str) -> bool:
    """Letters and digits mixed with the entropy of a made-up key."""
    if value.isalpha() or not any(map(str.isdigit, value)) or not any(map(str.isalpha, value)):
        return False
    counts = Counter(value).values()
    return sum(n * math.log2(len(value) / n) for n in counts) >= SECRET_BITS * len(value)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", at + 1)


def _digits(text: str) -> str:
    return NOT_DIGIT.sub("", text)


def propose(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """Confirmed spans (kind, start, end) and whether a checksum stands behind them."""
    for start, end in _emails(text):
        yield "email", start, end, False
    if not re.search("[0-9]", text):
        return
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.groups()):
            yield "ip", *m.span(), False
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _digits(m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield "card", *m.span(), True
            elif len(digits) == 13 and luhn(digits):
                yield "short_card", *m.span(), True
    for m in SECRET.finditer(text):
        if random_like(m[0]):
            yield "secret", *m.span(), False
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                yield "phone", *m.span(), False
    for m in IBAN.finditer(text):
        rest = m[1] in IBAN_LENGTH and IBAN_REST[IBAN_LENGTH[m[1]]].match(text, m.end())
        if rest and mod_97((m[0] + rest[0]).replace(" ", "")):
            yield "iban", m.start(), rest.end(), True
    for m in LOCAL_PHONE.finditer(text):
        yield "local_phone", *m.span(), False


def find(text: str | None) -> list[Span]:
    """All spans of a text by start, then kind as listed."""
    out, added, covered = [], [], []
    for kind, start, end, checked in propose(text) if text else ():
        near = text[max(0, start - WINDOW):start].lower()
        # one character more after the span: a word that reaches it is cut, and no word
        after = text[end:end + WINDOW + 1].lower()
        words = set(re.findall("[a-z]+", near)) | set(
            re.findall("[a-z]+" if len(after) <= WINDOW else r"[a-z]++(?!\Z)", after))
        score = PRIOR[kind] + CHECKSUM * checked + CONTEXT * any(w in words for w in CONTEXT_WORDS[kind])
        span = Span(kind, start, end, min(1.0, score))
        if kind in BASE:
            out.append(span)
            covered.append((start, end))
        elif score >= KEEP:
            added.append(span)
    # what base spans cover, as disjoint intervals in order
    starts, ends = [], []
    for start, end in sorted(covered):
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    for span in added:
        # the last interval that begins before the span's end is the only one that can reach into it
        at = bisect_left(starts, span.end) - 1
        if span.kind == "iban" or at < 0 or ends[at] <= span.start:
            out.append(span)
    return sorted(out, key=lambda s: (s.start, KINDS.index(s.kind)))


def redact_text(text: str | None) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping spans make one."""
    if text is None:
        return None
    out, done = [], 0
    for span in find(text):
        if span.start >= done:
            out += [text[done:span.start], f"[{span.kind.upper()}]"]
        done = max(done, span.end)
    return "".join([*out, text[done:]])


SPANS = ArrayType(StructType([StructField("kind", StringType()), StructField("start", IntegerType()),
                              StructField("end", IntegerType()), StructField("score", DoubleType())]))


def detect(docs: DataFrame, text_col: str = "text", to: str = "pii") -> DataFrame:
    """All rows and columns but the text, with an array of (kind, start, end, score).

    An old column named ``to`` gives way to it.
    """
    kept = others(docs, text_col, to)
    source, fields = beside(docs, kept, text_col)
    schema = StructType(fields + [StructField(to, SPANS)])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                               ("score", pa.float64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, len(kept)):
            found = [[s._asdict() for s in find(t)] for t in texts]
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + [pa.array(found, kind)],
                                             names=schema.names)

    return map_arrow(source, work, schema)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The same rows and columns with the texts redacted."""
    names, at = docs.columns, docs.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, at):
            clean = pa.array([redact_text(t) for t in texts], batch.column(at).type)
            new = [*batch.columns[:at], clean, *batch.columns[at + 1:]]
            yield pa.RecordBatch.from_arrays(new, names=names)

    return map_arrow(docs, work, docs.schema)
