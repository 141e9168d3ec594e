"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Offsets are code points, ends exclusive. Kinds ``email, ip, card, phone`` follow fixed patterns and
are found from left to right without overlap per kind; a match that fails its check is dropped and
the search goes on behind it. The method adds ``iban`` (mod 97) and ``shortcard`` (13 to 15 digits
that pass Luhn, only where a context word stands near).

Defined cases: a null or empty text has no spans; texts of any length take time in proportion to
their length (each pattern begins only where a match can begin); repeated rows are judged one by
one. Other input columns are not used and not returned.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "shortcard")

# The stated patterns. Possessive repeats and a look-behind keep them linear; they
# match the same text, because the next part can never begin inside the run before it.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_NOT_DIGIT = re.compile(r"[^0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

#: Words that raise the score of a kind when they stand within CONTEXT code points.
CONTEXT_WORDS = {
    "email": ("mail", "contact", "write", "courriel", "correo"),
    "ip": ("ip", "address", "server", "host", "adresse"),
    "card": ("card", "visa", "credit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "mobile", "telefon", "fax"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
    "shortcard": ("card", "visa", "amex", "credit", "payment", "karte", "carte", "tarjeta"),
}
CONTEXT = 40
#: Score of a confirmed span without context, and what a context word adds.
BASE_SCORE = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "shortcard": 0.4}
CONTEXT_GAIN = 0.15


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Every match holds one ``@`` after its local part, so the search goes from ``@`` to ``@``."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", done)


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """A match may run on into capitals and numbers behind it, so its ends at spaces are tried, the longest first."""
    m = _IBAN.search(text)
    while m:
        whole, done = m.group(), m.start() + 1
        ends = [len(whole), *[i for i in range(len(whole) - 1, 14, -1) if whole[i] == " "]]
        for end in ends:
            plain = whole[:end].replace(" ", "")
            if 15 <= len(plain) <= 34 and mod97(plain):
                done = m.start() + end
                yield m.start(), done
                break
        m = _IBAN.search(text, done)


def _near(text: str, kind: str, start: int, end: int) -> bool:
    around = f"{text[max(0, start - CONTEXT):start]} {text[end:end + CONTEXT]}".lower()
    words = set(re.findall(r"[^\W\d_]+", around))
    return any(w in words for w in CONTEXT_WORDS[kind])


def find_spans(text: str | None) -> list[Span]:
    """All confirmed spans, by kind in the order of ``KINDS`` and then by start."""
    if not text:
        return []
    found: list[tuple[str, int, int]] = [("email", a, b) for a, b in _emails(text)]
    found += [("ip", m.start(), m.end()) for m in _IP.finditer(text)
              if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split("."))]
    cards, short = [], []
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 13:
            continue
        digits = _NOT_DIGIT.sub("", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            cards.append(("card", m.start(), m.end()))
        elif 13 <= len(digits) <= 15 and luhn(digits) and _near(text, "shortcard", m.start(), m.end()):
            short.append(("shortcard", m.start(), m.end()))
    found += cards
    found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text)
              if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    found += [("iban", a, b) for a, b in _ibans(text)]
    found += short
    return [Span(k, a, b, round(BASE_SCORE[k] + CONTEXT_GAIN * _near(text, k, a, b), 2)) for k, a, b in found]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def redact(text: str | None, spans: list[Span]) -> str | None:
    """``text`` with every span replaced by its kind in brackets; overlapping spans become one."""
    if not text or not spans:
        return text
    out, done = [], 0
    merged: list[list] = []
    for s in sorted(spans, key=lambda s: (s.start, -s.end)):
        if merged and s.start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], s.end)
        else:
            merged.append([s.start, s.end, s.kind])
    for start, end, kind in merged:
        out += [text[done:start], f"[{kind.upper()}]"]
        done = end
    return "".join([*out, text[done:]])


def detect(docs: DataFrame) -> DataFrame:
    """One row per document: counts and digest of the base spans, all spans and their scores."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for doc_id, text in zip(part["doc_id"], part["text"], strict=True):
                spans = find_spans(text if isinstance(text, str) else None)
                base = [s for s in spans if s.kind in BASE_KINDS]
                rows.append((
                    doc_id, *(sum(s.kind == k for s in base) for k in BASE_KINDS),
                    hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans),
                    ",".join(f"{s.score:.2f}" for s in spans)))
            out = pd.DataFrame(rows, columns=["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans", "scores"])
            yield out.astype({"doc_id": "Int64"})

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, scores string"
    return docs.select("doc_id", "text").mapInPandas(run, schema)


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with spans in ``text`` masked and every other column unchanged."""
    names = docs.columns

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(lambda t: redact(t, find_spans(t)) if isinstance(t, str) else None)

    mask = F.pandas_udf(run, "string")
    return docs.select(*[mask("text").alias("text") if n == "text" else docs[n] for n in names])
