import random
from itertools import combinations

import numpy as np
import pytest

from tidedesk.llm import ngram_join
from tidedesk.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k=5):
    w = (text or "").translate(LOWER).encode().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def brute(docs):
    """Components by comparing all pairs; rows without id are not among them."""
    sets = [(i, shingles(t)) for i, t in docs]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, x), (b, y) in combinations(sets, 2):
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return sorted(((i, len(s), find(i)) for i, s in sets), key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(60))
    line = " ".join(word() for _ in range(30))
    docs = []
    for _ in range(12):
        base = [word() for _ in range(rng.randrange(1, 80))]
        for _ in range(rng.randrange(1, 7)):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            docs.append(" ".join(copy).upper() if rng.random() < 0.3 else " ".join(copy))
    docs += [line + " " + " ".join(word() for _ in range(20)) for _ in range(12)] + [line] * 3
    docs += ["", " \n", None, "a", "A", "a b", "b a", "a b c d e", "a b c d e f g h"]
    # a chain: each like the next, the ends unlike
    long = [word() for _ in range(100)]
    for i in range(6):
        docs.append(" ".join(long[i * 4:i * 4 + 60]))
    ids = rng.sample(range(1000), len(docs))
    return list(zip(ids, docs, strict=True))


@pytest.mark.parametrize("seed,block", [(1, 200), (2, 2), (3, 200)])
def test_against_brute_force(make_docs, tuples, monkeypatch, seed, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    docs = corpus(seed)
    assert tuples(ngram_join.join(make_docs(*docs)), "doc_id", "n_shingles", "component_id") == brute(docs)


def test_repeated_and_null_ids(make_docs, tuples):
    text = " ".join(f"w{i}" for i in range(30))
    docs = make_docs((3, text), (3, text), (None, text), (7, text + " x"), (None, "other words"))
    got = tuples(ngram_join.join(docs), "doc_id", "n_shingles", "component_id")
    assert got == [(3, 26, 3), (3, 26, 3), (7, 27, 3), (None, 1, None), (None, 26, 3)]
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    # rows without an id are judged like others: the copy without one goes, the unrelated one stays
    assert tuples(kept, "doc_id", "text") == [(3, text), (None, "other words")]


def test_keep_one_judges_rows_not_ids(make_docs, tuples):
    a, b = "one two three four five six seven eight", "alpha beta gamma delta epsilon zeta eta theta"
    kept = ngram_join.keep_one(make_docs((1, a), (1, b), (2, "some words of another kind altogether here")))
    assert kept.count() == 3
    rows = [(5, a), (4, a + " nine"), (4, b), (9, a), (None, b + " iota"), (None, "lone words stand here by themselves now"), (None, None), (None, None), (7, ""), (8, "")]
    kept = ngram_join.keep_one(make_docs(*rows))
    assert tuples(kept, "doc_id", "text") == sorted(
        [(4, a + " nine"), (4, b), (None, "lone words stand here by themselves now"), (None, None), (7, ""), (8, "")], key=str)


def test_passages_in_common_make_no_blocks(make_docs, tuples, monkeypatch):
    """Pairs of near copies in a ring: each pair has passages in common with its neighbours, but links with none."""
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    rows, deal = [], ngram_join._unit_links
    monkeypatch.setattr(ngram_join, "_unit_links", lambda units, *a: rows.append(units.count()) or deal(units, *a))
    docs = []
    for g in range(40):
        passages = [" ".join(f"p{x % 40}_{i}" for i in range(10)) for x in (g, g + 1, g + 2)]
        own = [f"g{g}_{i}" for i in range(60)]
        for copy in range(2):
            docs.append((2 * g + copy, " ".join([passages[0], *own[:30], passages[1], *own[30:59], f"c{copy}" if copy else own[59], passages[2]])))
    assert tuples(ngram_join.join(make_docs(*docs)), "doc_id", "n_shingles", "component_id") == brute(docs)
    assert sum(rows) <= 3 * len(docs)


def test_layers_of_sizes_and_several_pivots(make_docs, tuples, monkeypatch):
    """A cluster that its sizes divide, with a large group in it whose sets often do not link with each other."""
    monkeypatch.setattr(ngram_join, "BLOCK", 6)
    rng = random.Random(5)
    base, docs = [f"b{i}" for i in range(60)], []
    for _ in range(40):
        copy = list(base)
        for i in rng.sample(range(60), rng.randrange(0, 3)):
            copy[i] = f"x{rng.randrange(4)}"
        docs.append(" ".join(copy))
    docs += [" ".join(base[:n] + [f"y{n}"]) for n in range(8, 60, 4)] + [" ".join(base * 2 + base[:n]) for n in range(0, 60, 12)]
    docs = list(zip(rng.sample(range(1000), len(docs)), docs, strict=True))
    assert tuples(ngram_join.join(make_docs(*docs)), "doc_id", "n_shingles", "component_id") == brute(docs)


def test_equal_sets_are_written_once(make_docs, tuples, monkeypatch):
    sizes, write = [], ngram_join.materialize

    def measured(df, label):
        out = write(df, label)
        if "keys" in out.columns and label in ("join-sets", "join-classes"):
            sizes.append(out.selectExpr("sum(octet_length(keys))").first()[0])
        return out

    monkeypatch.setattr(ngram_join, "materialize", measured)
    text = " ".join(f"w{i}" for i in range(104))
    got = tuples(ngram_join.join(make_docs(*[(i, text) for i in range(30)], (None, text))), "component_id")
    assert got == [(0,)] * 31
    assert sizes == [800]


def test_keep_one_moves_few_whole_rows(make_docs, tuples, monkeypatch):
    """Whole rows move only where filters cannot tell: repeated rows and false hits."""
    moved, tell = [], ngram_join._membership
    monkeypatch.setattr(ngram_join, "_membership", lambda *a: moved.append(tell(*a)) or moved[-1])
    texts = [" ".join(f"t{i}_{j}" for j in range(30)) for i in range(40)]
    docs = make_docs(*enumerate(texts), *[(100 + i, t + " x") for i, t in enumerate(texts)], (None, texts[5]), (None, None), (None, None))
    assert tuples(ngram_join.keep_one(docs), "doc_id", "text") == sorted([*enumerate(texts), (None, None)], key=str)
    assert 2 <= moved[0].filter("kept = 2").count() <= 10


def test_order_tells_rarer_shingles_apart(spark):
    """Counts below those that are broadcast one by one still order shingles."""
    keys = [np.array(sorted(random.Random(i).sample(range(1 << 62), 50)), np.uint64) for i in range(4)]
    sets = [(j, keys[i]) for i, times in enumerate((2, 3, 5, 20)) for j in range(times)]
    table = spark.createDataFrame([(j, k.tobytes()) for j, k in sets], "id long, keys binary")
    counts = ngram_join.materialize(ngram_join.key_counts(table), "test-counts")
    order = ngram_join.frequent_order(counts)
    got = [order.count(k) for k in keys]
    assert (got[3] == 20).all() and (got[2] == 4).all()
    assert np.mean(got[0] == 0) > 0.8 and np.mean(got[1] == 0) > 0.8


def test_empty_table(make_docs):
    assert ngram_join.join(make_docs()).count() == 0
    assert ngram_join.keep_one(make_docs()).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_tree_spans_all_components(seed):
    rng = random.Random(seed)
    base = [rng.sample(range(200), rng.randrange(1, 60)) for _ in range(8)]
    sets = []
    for _ in range(60):
        s = set(rng.choice(base))
        for _ in range(rng.randrange(0, 6)):
            s ^= {rng.randrange(200)}
        sets.append(np.array(sorted(s or {0}), np.uint64))
    counts = {}
    for s in sets:
        for x in s.tolist():
            counts[x] = counts.get(x, 0) + 1
    keys = np.array(sorted(counts), np.uint64)
    order = ngram_join.Order(keys, np.array([counts[int(x)] for x in keys]))
    links = ngram_join.tree_links(list(range(60)), [len(s) for s in sets], sets, order, 75)

    def label(pairs):
        parent = list(range(60))
        for a, b in pairs:
            while parent[a] != a:
                a = parent[a]
            while parent[b] != b:
                b = parent[b]
            parent[max(a, b)] = min(a, b)
        out = []
        for x in range(60):
            while parent[x] != x:
                x = parent[x]
            out.append(x)
        return out

    as_sets = [set(s.tolist()) for s in sets]
    true = [(a, b) for a, b in combinations(range(60), 2) if 100 * len(as_sets[a] & as_sets[b]) >= 75 * len(as_sets[a] | as_sets[b])]
    assert set(links) <= {(a, b) for a, b in true} | {(b, a) for a, b in true}
    assert label(links) == label(true)


def test_components_of_a_long_chain(spark, tuples):
    edges = [(i, i + 1) for i in range(10, 80)] + [(200, 100), (100, 300), (5, 5)]
    random.Random(0).shuffle(edges)
    got = dict(tuples(components(spark.createDataFrame(edges, "a long, b long")), "id", "label"))
    assert got == {**{i: 10 for i in range(10, 81)}, 100: 100, 200: 100, 300: 100}


def test_very_long_texts(make_docs, tuples):
    a = [f"a{i}" for i in range(120_000)]
    near = a[:100_000] + [f"z{i}" for i in range(20_000)]
    far = a[:70_000] + [f"y{i}" for i in range(50_000)]
    got = tuples(ngram_join.join(make_docs((3, " ".join(a)), (1, " ".join(near)), (2, " ".join(far)), (4, "short text"))), "doc_id", "n_shingles", "component_id")
    # 99,996 of 139,996 shared is below 0.75; of the long pair with 110,000 in common it is not
    assert [r[2] for r in got] == [1, 2, 3, 4]
    close = a[:110_000] + [f"z{i}" for i in range(10_000)]
    got = tuples(ngram_join.join(make_docs((3, " ".join(a)), (1, " ".join(close)))), "doc_id", "n_shingles", "component_id")
    assert got == [(1, 119_996, 1), (3, 119_996, 1)]
