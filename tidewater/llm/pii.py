r"""Personal data: patterns propose spans, checksums confirm them, context adjusts the score.

Kinds, in order: ``email``, ``ip``, ``card``, ``phone`` (the base kinds) and ``iban``, ``id``, ``tel`` (added).

* Base kinds follow the contract: leftmost non-overlapping matches per kind; matches that fail their
  check (octets over 255, Luhn, number of digits) are dropped without a retry. They always stay.
* ``iban`` is confirmed by mod 97; ``id`` (three-two-four digit groups) and ``tel`` (ten digits in groups,
  no leading +) have no checksum and need a context word nearby to reach ``THRESHOLD``. An added span
  that overlaps a base span or an earlier added one is not reported.
* The score starts from the kind's prior, gains by a confirmed checksum and by a context word within
  ``NEAR`` characters before the span, and loses by a word that speaks against it.

Positions are code points, the end is exclusive. Null texts are empty; a text without a match gives
empty results; rows are independent, so ties, repeated rows, empty tables and other columns do not
matter. Every search is linear in the text: emails are found from their @ signs, ip addresses from
whole runs of digits and dots.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import documents

KINDS = ("email", "ip", "card", "phone", "iban", "id", "tel")
BASE = KINDS[:4]
THRESHOLD, NEAR = 0.5, 48

#: character classes and patterns of the contract (fixed values)
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
ID = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
TEL = re.compile(r"(?<![0-9+(-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])")
DIGITS = re.compile(r"[^0-9]+")

PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.5, "phone": 0.6, "iban": 0.4, "id": 0.3, "tel": 0.3}
CHECKED = {"card": 0.4, "iban": 0.5}
FOR = {
    "email": ("mail", "contact", "@"), "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "credit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "fax", "mobile", "telefon"),
    "iban": ("iban", "account", "bank", "konto"), "id": ("ssn", "social security", "id number"),
    "tel": ("phone", "call", "tel", "fax", "mobile", "telefon"),
}
AGAINST = {"ip": ("version", "release", "build"), "id": ("order", "part no", "isbn"), "tel": ("order", "part no", "isbn"),
           "card": ("serial", "tracking", "isbn")}


def luhn(digits: str) -> bool:
    doubled = sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[ord(c) - 48] for c in digits[-2::-2])
    return (doubled + sum(ord(c) - 48 for c in digits[::-2])) % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(done, at + 1))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for m in DOTTED.finditer(text):
        parts = m.group().split(".")
        at = m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(v) <= 3 and int(v or "0") <= 255 for v in (p.lstrip("0") for p in four)):
                yield at, end
            at = end + 1


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = DIGITS.sub("", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(DIGITS.sub("", m.group())) <= 15:
                yield m.span()


def ibans(text: str) -> Iterator[tuple[int, int]]:
    for m in IBAN.finditer(text):
        plain = m.group().replace(" ", "")
        if 15 <= len(plain) <= 34 and mod97(plain):
            yield m.span()


FINDERS = {"email": emails, "ip": addresses, "card": cards, "phone": phones, "iban": ibans,
           "id": lambda t: (m.span() for m in ID.finditer(t)), "tel": lambda t: (m.span() for m in TEL.finditer(t))}
NUMERIC = re.compile(r"[0-9]")


def score(text: str, kind: str, start: int) -> float:
    before = text[max(0, start - NEAR):start].lower()
    s = PRIOR[kind] + CHECKED.get(kind, 0.0)
    if any(w in before for w in FOR[kind]):
        s += 0.3
    if any(w in before for w in AGAINST.get(kind, ())):
        s -= 0.3
    return min(1.0, max(0.0, s))


def merged(found) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that the spans cover, in order."""
    starts, ends = [], []
    for a, b in sorted(found):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def spans(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by start, then kind."""
    out = []
    if "@" in text:
        out = [("email", a, b) for a, b in emails(text)]
    if NUMERIC.search(text):
        for kind in BASE[1:]:
            out += [(kind, a, b) for a, b in FINDERS[kind](text)]
        for kind in KINDS[4:]:
            starts, ends = merged((a, b) for _, a, b in out)
            for a, b in FINDERS[kind](text):                     # spans of one kind never overlap
                i = bisect_left(starts, b)
                if (i == 0 or ends[i - 1] <= a) and score(text, kind, a) >= THRESHOLD:
                    out.append((kind, a, b))
    out.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return [(k, a, b, score(text, k, a)) for k, a, b in out]


RESULT = "array<struct<kind:string,start:int,end:int,score:double>>"


def with_pii(docs: DataFrame, text: str = "text", name: str = "pii") -> DataFrame:
    """``docs`` with an array column of the spans found in ``text``."""
    @F.pandas_udf(RESULT)
    def find(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield s.map(lambda t: [{"kind": k, "start": a, "end": b, "score": x} for k, a, b, x in spans(t or "")])

    return docs.withColumn(name, find(F.col(text)))


def masked(text: str, least: float = THRESHOLD) -> str:
    """The text with every span of at least this score replaced by its kind in brackets."""
    out, done = [], 0
    for kind, a, b, x in spans(text or ""):
        if x >= least and a >= done:
            out += [text[done:a], f"[{kind}]"]
            done = b
    return "".join(out) + (text or "")[done:]




def op4_pii(spark, sf_dir: str) -> DataFrame:
    out = with_pii(documents(spark, sf_dir).select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE))
    return out.select("doc_id", *[count(k) for k in BASE],
                      F.sha2(F.array_join(F.transform(base, one), ","), 256).alias("base_sha256"),
                      F.array_join(F.transform("pii", one), ",").alias("spans"),
                      F.transform("pii", lambda s: s["score"]).alias("span_scores"))
