import hashlib
import random
import re

import numpy as np
import pytest

from tidedesk.llm import infill

SENT = ("<P>", "<S>", "<M>")


def brute(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(text)
    if not text or any(s in text for s in SENT) or h3 % 100 >= 90:
        return (doc_id, n, "plain", None, None, text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return (doc_id, n, "spm", a, b - a, "<S>" + s + "<P>" + p + "<M>" + m)
    return (doc_id, n, "psm", a, b - a, "<P>" + p + "<S>" + s + "<M>" + m)


@pytest.mark.parametrize("n", [0, 1, 2, 31, 33, 1000, 70_000, 600_000])
def test_skip_list_reaches_every_rank(n):
    widths = np.random.default_rng(n).integers(0, 9, n)
    cuts = infill.SkipList(widths)
    at = np.concatenate([[0], np.cumsum(widths)])
    ranks = range(n + 1) if n <= 1000 else [0, 1, n - 1, n, *random.Random(n).sample(range(n), 300)]
    assert [cuts.locate(r) for r in ranks] == [int(at[r]) for r in ranks]
    for lane in range(len(cuts.units)):
        assert cuts.units[lane].sum() == n and cuts.points[lane].sum() == at[-1]
    assert n < 33 or len(cuts.units) > 1
    assert len(cuts.units[-1]) <= 32


def test_descent_is_short():
    cuts = infill.SkipList(np.broadcast_to(np.int64(1), 1 << 20))
    assert 4 <= len(cuts.units) <= 8 and all(len(a) > 4 * len(b) for a, b in zip(cuts.units, cuts.units[1:]))


DOCS = [(i, f"text {i} with ümläut, 漢字 and 🙂 " * (i % 7)) for i in range(60)] + [
    (None, "no id"), (None, None), (100, None), (101, ""), (102, "a<P>b"), (103, "a<S>b<M>"), (104, "<" * 9 + "P<S" * 3), (105, "x"),
    (7, "same id, other text"), (7, "same id, other text"), (106, "é ‍\n\t " * 40_000)]


def test_against_brute_force(make_docs, tuples):
    got = tuples(infill.transform(make_docs(*DOCS)), "doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
    assert got == sorted((brute(*d) for d in DOCS), key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_exact_round_trip(make_docs):
    df = infill.transform(make_docs(*DOCS), plain=100, spm=50)
    back = [r["t"] for r in df.select(infill.restored(df["form"], df["output"]).alias("t")).collect()]
    assert sorted(back) == sorted(t or "" for _, t in DOCS)
    shown = infill.digests(df).collect()
    assert sorted(r["restored_sha256"] for r in shown) == sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t in DOCS)


def test_word_units(make_docs):
    pattern = r"\S+"
    assert infill.unit_widths("  ab cd  e ", re.compile(pattern)).tolist() == [2, 2, 1, 2, 2, 1, 1]
    df = infill.transform(make_docs(*DOCS), plain=100, unit=pattern).filter("form <> 'plain'")
    for r in df.collect():
        text = r["output"]
        tail = text.split("<M>")[1]
        assert len(tail) == r["middle_chars"]
        assert not (tail and re.match(r"\S", tail) and re.search(r"\S$", text.split("<P>")[1].split("<S>")[0].split("<M>")[0]))


def test_empty_table(make_docs):
    assert infill.digests(infill.transform(make_docs())).count() == 0
