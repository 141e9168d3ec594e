import hashlib
import random
import re

import pytest
from hypothesis import given, settings, strategies as st

from tidedesk.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    """The stated patterns and checks, applied as they are written."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    luhn = lambda d: sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    tests = [("email", EMAIL, lambda s: True), ("ip", IP, lambda s: all(int(p) <= 255 for p in s.split("."))),
             ("card", CARD, lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))), ("phone", PHONE, lambda s: 8 <= len(digits(s)) <= 15)]
    return [(k, m.start(), m.end()) for k, p, ok in tests for m in p.finditer(text) if ok(m.group())]


def base(text):
    return [tuple(s[:3]) for s in pii.find_spans(text) if s.kind in pii.BASE_KINDS]


@given(st.text(alphabet="ab@.-+ ()0123456789%é\n", max_size=60))
@settings(max_examples=500, deadline=None)
def test_base_spans(text):
    assert base(text) == brute(text)


def test_dense_random_texts():
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice(["4111 1111 1111 1111", "10.0.0.255", "a.b@c-d.ef", "+49 (30) 123-4567", "@", ".", " ", "-", "7", "x", "256.1.1.1"]) for _ in range(12))
        assert base(text) == brute(text)


@pytest.mark.parametrize("text,kinds", [
    ("IBAN DE89370400440532013000 ok", ["iban"]), ("IBAN DE89370400440532013001", []), ("GB82 WEST 1234 5698 7654 32", ["iban"]),
    ("amex card 378282246310005", ["shortcard"]), ("number 378282246310005", []), ("378282246310006 card", []), (None, []), ("", []),
])
def test_added_kinds(text, kinds):
    assert [s.kind for s in pii.find_spans(text)] == kinds


def test_context_raises_the_score():
    a, = pii.find_spans("call me: +49 30 1234567")
    b, = pii.find_spans("number: +49 30 1234567")
    assert a.score > b.score


@pytest.mark.parametrize("text", ["1" * 400_000, "a" * 400_000 + "@", "@" * 200_000, "+1 " * 100_000, "1." * 200_000, "a@b" * 100_000, "AB12 " * 80_000])
def test_very_long_texts(text):
    pii.find_spans(text)


def test_table(make_docs, tuples):
    text = "é mail a@b.co, 10.0.0.1"
    got = tuples(pii.detect(make_docs((1, text), (1, text), (None, None), (2, ""))), "doc_id", "n_email", "n_ip", "base_sha256", "spans")
    spans = "email:7:13,ip:15:23"
    full, none = hashlib.sha256(spans.encode()).hexdigest(), hashlib.sha256(b"").hexdigest()
    assert got == [(1, 1, 1, full, spans), (1, 1, 1, full, spans), (2, 0, 0, none, ""), (None, 0, 0, none, "")]
    masked = pii.redacted(make_docs((1, text), (2, None), (3, "")))
    assert tuples(masked, "doc_id", "text", "copy") == [(1, "é mail [EMAIL], [IP]", 1), (2, None, 1), (3, "", 1)]
    assert pii.detect(make_docs()).count() == 0


def test_overlapping_spans_mask_once():
    spans = pii.find_spans("x +4111 1111 1111 1111 y 1.2.3.4")
    assert pii.redact("x +4111 1111 1111 1111 y 1.2.3.4", spans).count("[") == 2


@pytest.mark.parametrize("text,ibans", [
    ("DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX", ["DE89 3704 0044 0532 0130 00"]),
    ("GB82WEST12345698765432 100 EUR", ["GB82WEST12345698765432"]),
    ("REF AB12 DE89370400440532013000 GB82 WEST 1234 5698 7654 32 OK", ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"]),
])
def test_ibans_before_capitals_and_numbers(text, ibans):
    found = [s for s in pii.find_spans(text) if s.kind == "iban"]
    assert [text[s.start:s.end] for s in found] == ibans
    assert not any(i in pii.redact(text, found) for i in ibans)
