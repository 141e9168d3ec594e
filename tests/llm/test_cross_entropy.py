import math
from collections import Counter

import pytest

from tidedesk.llm import cross_entropy


def brute(docs, target, weight=0.6):
    toks = lambda t: (t or "").lower().split()
    count = Counter(w for t in target for w in toks(t))
    vocab = {w for w, n in count.items() if n >= 2}
    sym = lambda t: [w if w in vocab else None for w in toks(t)]

    def model(texts):
        big = Counter()
        for t in texts:
            s = sym(t)
            if s:
                big.update(zip(["|", *s], [*s, "|"], strict=True))
        return big

    def loss(m, h, s):
        ch = sum(n for (a, _), n in m.items() if a == h)
        uni = (sum(n for (_, b), n in m.items() if b == s) + 1) / (sum(m.values()) + len(vocab) + 2)
        w = weight if ch else 0
        return -math.log(w * (m[h, s] / ch if ch else 0) + (1 - w) * uni)

    models = model(target), model([t for _, t in docs])
    out = []
    for i, t in docs:
        s = sym(t)
        if not s:
            out.append((i, 0, None, None, None))
            continue
        a, b = (sum(loss(m, h, x) for h, x in zip(["|", *s], [*s, "|"], strict=True)) / (len(s) + 1) for m in models)
        out.append((i, len(s), pytest.approx(a, abs=1e-6), pytest.approx(b, abs=1e-6), pytest.approx(a - b, abs=2e-6)))
    return sorted(out, key=str)


def test_against_brute_force(spark, make_docs, tuples):
    docs = [(1, "the cat sat"), (2, "THE cat\tate the dog"), (3, ""), (4, None), (5, "unseen words only"), (1, "the cat sat"), (None, "dog " * 40)]
    target = ["the cat sat on the mat", "a dog", "the dog sat", None, ""]
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate(target)], "item_id long, text string, word string")
    got = tuples(cross_entropy.score(make_docs(*docs), bench), "doc_id", "n_tokens", "target_loss", "background_loss", "score")
    for a, b in zip(got, sorted(brute(docs, target), key=lambda r: next(i for i, g in enumerate(got) if g[:2] == r[:2])), strict=True):
        assert a[:2] == b[:2]
    want = {(r[0], r[1]): r for r in brute(docs, target)}
    assert all(r == want[r[:2]] for r in got) and len(got) == len(docs)
    by = {r[0]: r[4] for r in got}
    assert by[1] < by[5]


def test_empty_tables(spark, make_docs, tuples):
    none = spark.createDataFrame([], "item_id long, text string")
    assert cross_entropy.score(make_docs(), none).count() == 0
    assert tuples(cross_entropy.score(make_docs((1, "a b")), none), "doc_id", "n_tokens")[0] == (1, 2)


def brute_both(docs, target, weight=0.6):
    toks = lambda t: (t or "").lower().split()
    texts = [t for _, t in docs]
    width = len({w for t in [*texts, *target] for w in toks(t)}) + 2
    models = []
    for side in (target, texts):
        pairs, words = Counter(), Counter()
        for t in side:
            if s := toks(t):
                pairs.update(zip(["|", *s], [*s, "|"], strict=True))
                words.update([*s, "|"])
        models.append((pairs, words))
    out = []
    for i, t in docs:
        s = toks(t)
        both = []
        for pairs, words in models:
            total = 0.0
            for h, w in zip(["|", *s], [*s, "|"], strict=True):
                share = weight if words[h] else 0
                total -= math.log(share * (pairs[h, w] / words[h] if words[h] else 0) + (1 - share) * (words[w] + 1) / (sum(words.values()) + width))
            both.append(total / (len(s) + 1))
        a, b = both
        out.append((i, len(s), *(pytest.approx(x, abs=2e-6) if s else None for x in (a, b, a - b))))
    return out


def test_every_word_counts(spark, make_docs, monkeypatch):
    """Words that the target lacks have counts of their own, and nothing depends on how texts fall into chunks."""
    target = ["the cat sat on the mat", "a dog", None, ""]
    docs = [(i, t) for i, t in enumerate(
        ["the cat sat", "zebra yak zebra yak", "quartz onyx opal", "", None, *(f"w{j} w{j + 1} the w{j}" for j in range(6000))])]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    want = {r[0]: r for r in brute_both(docs, target)}
    for size in (cross_entropy.CHUNK, 1):
        monkeypatch.setattr(cross_entropy, "CHUNK", size)
        got = [tuple(r) for r in cross_entropy.score(make_docs(*docs), bench, words="both").collect()]
        assert len(got) == len(docs) and all(r == want[r[0]] for r in got)
    by = {r[0]: r for r in got}
    assert by[1][3] < by[2][3]


def test_no_tables_in_both(spark, make_docs, tuples):
    none = spark.createDataFrame([], "item_id long, text string")
    assert cross_entropy.score(make_docs(), none, words="both").count() == 0
    got = tuples(cross_entropy.score(make_docs((1, "a b"), (2, "")), none, words="both"), "doc_id", "n_tokens", "score")
    assert [r[:2] for r in got] == [(1, 2), (2, 0)] and got[0][2] > 0 and got[1][2] is None


def test_a_very_long_text(spark, make_docs):
    """A text of more symbols than a chunk holds is scored whole."""
    text = " ".join(f"v{i % 5000}" for i in range(1_200_000))
    bench = spark.createDataFrame([(1, "v1 v2 v3"), (2, "alpha beta")], "item_id long, text string")
    got = {r.doc_id: r for r in cross_entropy.score(make_docs((1, text), (2, "v1 v2 v3"), (3, "gamma")), bench, words="both").collect()}
    assert got[1].n_tokens == 1_200_000 and got[2].n_tokens == 3 and got[2].target_loss < got[3].target_loss


def test_a_target_vocabulary_has_a_bound(spark, make_docs, monkeypatch):
    monkeypatch.setattr(cross_entropy, "MAX_VOCABULARY", 2)
    bench = spark.createDataFrame([(1, "a b c a b c")], "item_id long, text string")
    with pytest.raises(ValueError, match="over 2 words"):
        cross_entropy.score(make_docs((1, "a")), bench, words="target")
