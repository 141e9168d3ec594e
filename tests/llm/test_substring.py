import hashlib
import random

import pytest
from hypothesis import given, settings, strategies as st

from tidedesk.llm import substring


def brute(docs, window):
    """``{(id, text): (n, removed, kept)}`` by comparing every window with every document."""
    words = [(i, (t or "").encode().split()) for i, t in docs]
    first = {}
    for i, w in words:
        for a in range(len(w) - window + 1):
            key = tuple(w[a:a + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        for a in range(len(w) - window + 1):
            if i is not None and first[tuple(w[a:a + window])] < i:
                gone.update(range(a, a + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return sorted(out, key=str)


def corpus(seed, n=40):
    rng = random.Random(seed)
    passages = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(9)) for _ in range(rng.randrange(5, 40))) for _ in range(12)]
    docs = [(i * 3 % 101, rng.choice([" ", "\n", "\t "]).join(rng.choice(passages) for _ in range(rng.randrange(1, 6)))) for i in range(n)]
    return docs + [(500, ""), (501, None), (None, docs[0][1]), (0, docs[0][1]), docs[3], (600, "w " * 300), (601, "w " * 20)]


@pytest.mark.parametrize("most", [20_000, 1])
def test_against_brute_force(spark, make_docs, tuples, most):
    docs = corpus(most)
    got = tuples(substring.deduplicate(make_docs(*docs), window=6, anchor=3, most=most), "doc_id", "n_words", "n_removed", "kept_sha256", "kept")
    assert got == brute(docs, 6)


def test_empty_table(make_docs):
    assert substring.deduplicate(make_docs()).count() == 0


@given(st.lists(st.lists(st.integers(0, 3), max_size=12), min_size=1, max_size=6), st.integers(1, 4))
@settings(max_examples=60, deadline=None)
def test_automaton(sequences, least):
    a = substring.SuffixAutomaton()
    for doc, s in enumerate(sequences):
        a.add(s, doc)
    a.close()
    for s in sequences:
        want = []
        for end in range(least, len(s) + 1):
            part = s[end - least:end]
            want.append((end, min(d for d, t in enumerate(sequences) if any(t[i:i + least] == part for i in range(len(t))))))
        assert list(a.stream(s, least)) == want


def test_a_very_long_text(make_docs, tuples):
    """A passage of 60 words in the middle of 200,000 others, which an earlier document holds."""
    passage = " ".join(f"p{i}" for i in range(60))
    filler = " ".join(f"f{i}" for i in range(100_000)), " ".join(f"g{i}" for i in range(100_000))
    docs = make_docs((1, f"start {passage} end"), (2, f"{filler[0]} {passage} {filler[1]}"), (3, f"{filler[0]} lone"))
    got = tuples(substring.deduplicate(docs), "doc_id", "n_words", "n_removed", "kept_sha256")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == [(1, 62, 0, sha(f"start {passage} end")), (2, 200_060, 60, sha(" ".join(filler))), (3, 100_001, 100_000, sha("lone"))]
