"""Personal data in texts: patterns propose spans, checks confirm them, context scores them."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from content_signals.llm.common import as_bytes, slices

#: Patterns of the kinds, in the order in which spans at one place are listed.
#: Fixed values; quantifiers that can never give back what they took are
#: possessive, so that no text makes the search quadratic.
EMAIL_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
EMAIL_NAME = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
#: Words that make a kind likelier when they stand within ``CONTEXT`` characters. Fixed values.
WORDS = {
    "email": re.compile(r"e-?mail|contact|write|mailto", re.I),
    "ip": re.compile(r"\bip\b|address|server|host|login", re.I),
    "card": re.compile(r"card|credit|visa|payment|tarjeta|carte|karte", re.I),
    "phone": re.compile(r"phone|\btel\b|call|mobile|fax|tel[ée]fono|telefon", re.I),
    "iban": re.compile(r"iban|account|bank|konto|cuenta|compte", re.I),
}
#: A kind's score without context: stronger checks give more. Context adds the bonus.
SCORES = {"email": 0.8, "ip": 0.5, "card": 0.7, "phone": 0.5, "iban": 0.9}
CONTEXT, BONUS = 40, 0.3
KINDS = tuple(SCORES)
BASE_KINDS = ("email", "ip", "card", "phone")

Spans = Iterator[tuple[int, int]]
_SLICE_BYTES = 4 << 20
_SCHEMA = "doc_id long, spans array<struct<kind:string,start:int,end:int,score:double>>"
_TYPE = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> Spans:
    """Grown to the left from each ``@``, which gives the leftmost matches in linear time."""
    last = 0
    at = text.find("@")
    while at >= 0:
        if at >= last and (domain := EMAIL_DOMAIN.match(text, at)):
            start = at
            while start > last and ord(text[start - 1]) < 128 and ord(text[start - 1]) in EMAIL_NAME:
                start -= 1
            if start < at:
                yield start, domain.end()
                last = domain.end()
        at = text.find("@", at + 1)


def ips(text: str) -> Spans:
    for m in IP.finditer(text):
        parts = [part.lstrip("0") or "0" for part in m[0].split(".")]
        if all(len(part) <= 3 and int(part) <= 255 for part in parts):
            yield m.span()


def cards(text: str) -> Spans:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Spans:
    for m in PHONE.finditer(text):
        if 10 <= sum(map(m[0].count, "0123456789")) <= 15:
            yield m.span()


def ibans(text: str) -> Spans:
    for m in IBAN.finditer(text):
        number = m[0].replace(" ", "")
        if 15 <= len(number) <= 34 and mod97(number):
            yield m.span()


FINDERS: dict[str, Callable[[str], Spans]] = {
    "email": emails,
    "ip": ips,
    "card": cards,
    "phone": phones,
    "iban": ibans,
}


def score(text: str, kind: str, start: int, end: int) -> float:
    """The kind's own score, and more if a context word stands near."""
    near = text[max(0, start - CONTEXT) : start] + "\n" + text[end : end + CONTEXT]
    return min(1.0, SCORES[kind] + (BONUS if WORDS[kind].search(near) else 0.0))


def find(text: str, kinds: tuple[str, ...] = KINDS) -> list[dict]:
    """Confirmed spans by start, then kind; offsets are code points, the end is exclusive."""
    spans = [(s, kinds.index(k), e, k) for k in kinds for s, e in FINDERS[k](text)]
    return [
        {"kind": k, "start": s, "end": e, "score": score(text, k, s, e)} for s, _, e, k in sorted(spans)
    ]


def find_pii(docs: DataFrame, kinds: tuple[str, ...] = KINDS, min_score: float = 0.0) -> DataFrame:
    """(doc_id, spans) for every row of ``docs``, which holds ``doc_id`` and ``text``.

    Per kind the leftmost non-overlapping matches are taken and those that fail the
    kind's check are dropped: parts of an address up to 255, Luhn's sum and 14 to 19
    digits of a card, 10 to 15 digits of a phone number, mod-97 of an account number.
    Spans of different kinds may overlap. ``min_score`` leaves out spans without
    enough support from their context. A null or empty text has no span; a null
    ``doc_id`` stays null; repeated rows give repeated results; other columns are
    not read. Rows are independent: nothing is shuffled.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SLICE_BYTES):
            texts = (t.decode() for t in as_bytes(batch.column("text")))
            spans = [[s for s in find(t, kinds) if s["score"] >= min_score] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(spans, _TYPE)], names=["doc_id", "spans"]
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(search, _SCHEMA)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
