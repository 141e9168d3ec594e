import hashlib
import random
import re

from tidedesk.llm import decontaminate
from tidedesk.session import materialize

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, width):
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for item, text in items:
            v = words(text)
            n = min(width, len(v))
            for a in range(len(v) - n + 1 if v else 0):
                for b in range(len(w) - n + 1):
                    if w[b:b + n] == v[a:a + n]:
                        hit.update(range(b, b + n))
                        if item is not None:
                            found.add(str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


ITEMS = [(1, "The quick, brown FOX jumps over the lazy dog"), (2, "é-è alpha beta"), (10, "one two three four five six"), (3, None), (4, "?!"),
         (None, "null item words here now"), (1, "again the same item id"), (12, "one two three four five six")]
DOCS = [(1, "a quick brown fox jumps over the lazy cat"), (2, "É-È alpha; é è Alpha... beta"), (3, None), (4, ""), (5, "zero one two three four five"),
        (6, "one two three four five six one two three four five six"), (7, "NULL item words here, now"), (6, "repeated id"), (6, "repeated id"),
        (None, "again the same item"), (8, "one " * 50 + "two three four " * 3), (9, "the the the quick quick brown")]
COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def items(spark, rows=ITEMS):
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id long, text string, term string")


def test_against_brute_force(spark, make_docs, tuples):
    got = tuples(decontaminate.scan(make_docs(*DOCS), items(spark), width=4), *COLUMNS)
    assert got == brute(DOCS, ITEMS, 4)
    kept = decontaminate.keep_uncontaminated(make_docs(*DOCS), items(spark), width=4)
    assert tuples(kept, "doc_id", "text") == sorted(
        ((i, t) for (i, t), r in zip(DOCS, [brute([d], ITEMS, 4)[0] for d in DOCS], strict=True) if not r[-1]), key=str)


def test_without_broadcast(spark, make_docs, tuples, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", -1)
    assert tuples(decontaminate.scan(make_docs(*DOCS), items(spark), width=4), *COLUMNS) == brute(DOCS, ITEMS, 4)


def test_empty_tables(spark, make_docs, tuples):
    assert decontaminate.scan(make_docs(), items(spark)).count() == 0
    assert tuples(decontaminate.scan(make_docs((1, "a b")), items(spark, [])), "n_words", "n_hit", "contaminated") == [(2, 0, False)]


def test_proximity(spark, make_docs, tuples):
    docs = make_docs((1, "rare1 x x rare2"), (2, "rare1 " + "x " * 30 + "rare2"), (3, "rare1 rare2 x x"), (4, "x"))
    index, anchors = decontaminate.build(docs, items(spark, [(1, "rare1 rare2 x")]), width=3, reach=8)
    got = tuples(decontaminate.proximity_matches(index, anchors, slop=2).select("doc_id", "pos", "pos2"), "doc_id", "pos", "pos2")
    assert got == [(1, 0, 3), (3, 0, 1)]
    exact = materialize(decontaminate.phrase_matches(index, anchors), "m")
    assert tuples(exact, "doc_id", "start", "length") == [(3, 0, 3)]


def test_no_python_in_plan(spark, make_docs):
    plan = decontaminate.scan(make_docs(*DOCS), items(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def brute_near(docs, items, width, slop):
    windows = {tuple(w[a:a + min(width, len(w))]) for _, t in items for w in [words(t)] if w for a in range(max(len(w) - width, 0) + 1)}
    out = []
    for i, t in docs:
        w, n = words(t), 0
        for v in windows:
            if any(tuple(w[b:b + len(v)]) == v for b in range(len(w))):
                continue
            needed = -(-len(set(v)) * 4 // 5)
            n += any(len(set(v) & set(w[b:b + len(v) + slop])) >= needed for b in range(len(w)))
        out.append((i, n))
    return sorted(out, key=str)


def texts(rng, n):
    vocabulary = [f"w{i}" for i in range(30)] + ["the", "of"] * 4
    return [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 60))) for _ in range(n)]


def test_near_matches_against_brute_force(spark, make_docs, tuples, monkeypatch):
    rng = random.Random(11)
    bench = list(enumerate([*texts(rng, 4), "one two", "solo", None, "a a b b c"]))
    docs = [(i, t) for i, t in enumerate(texts(rng, 25))]
    for k, (_, t) in enumerate(bench[:4]):  # copies with words changed, left out, put in or moved
        w = words(t)
        for j in (2, 7):
            docs.append((100 + 10 * k + j, " ".join([*w[:j], "other", *w[j + 1:]])))
            docs.append((101 + 10 * k + j, " ".join([*w[:j], *w[j + 1:], "end"])))
            docs.append((102 + 10 * k + j, " ".join([*w[:j], "put", "in", "words", *w[j:]])))
    docs += [(5, "two x y z q one"), (None, "b c a"), (None, None), (900, ""), (901, "two one"), (901, "two one"), (902, "solo")]
    want = brute_near(docs, bench, 10, decontaminate.SLOP)
    assert sum(n for _, n in want) > 30
    assert tuples(decontaminate.scan(make_docs(*docs), items(spark, bench)), "doc_id", "n_near") == want
    assert tuples(decontaminate.scan(make_docs(*docs), items(spark, bench)), *COLUMNS) == brute(docs, bench, 10)
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", -1)
    assert tuples(decontaminate.scan(make_docs(*docs), items(spark, bench)), "doc_id", "n_near") == want


def test_the_rarest_word_changed_is_found(spark, make_docs, tuples):
    item = "the rarest zyzzyva of all words stands in this item here"
    docs = make_docs((1, item.replace("zyzzyva", "aardvark")), (2, "zyzzyva alone"), (3, "the of all words in this"), (4, item))
    got = tuples(decontaminate.scan(docs, items(spark, [(1, item)])), "doc_id", "n_hit", "n_near")
    assert [(i, h > 0, n > 0) for i, h, n in got] == [(1, False, True), (2, False, False), (3, False, False), (4, True, False)]


def test_long_text_without_broadcast(spark, make_docs, monkeypatch):
    """Tokens take the words around them through the shuffle, not their document."""
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", -1)
    docs = make_docs((1, " ".join(f"w{i % 5000}" for i in range(100_000))), (2, "w1 w2 w3"))
    terms = spark.createDataFrame([("w7",), ("w4999",)], "term string")
    index = decontaminate.postings(docs, terms, 14)
    assert index.count() == 40 and index.filter("size(around) > 29").count() == 0
    plan = spark._jvm.PythonSQLUtils.explainString(index._jdf.queryExecution(), "formatted")
    for part in re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", plan):
        assert "around" in part or "term" in part
        assert not re.search(r"\bw#", part)


def test_a_very_long_text(spark, make_docs, tuples):
    filler = " ".join(f"x{i % 977}" for i in range(300_000))
    docs = make_docs((1, f"{filler} one two three four five six seven eight nine ten {filler}"))
    got = tuples(decontaminate.scan(docs, items(spark, [(1, "one two three four five six seven eight nine ten eleven")])), "n_words", "n_hit", "n_items", "n_near")
    assert got == [(600_010, 10, 1, 1)]


def test_texts_are_split_once_for_the_index_and_not_for_the_report(spark, make_docs):
    """Spark's filter for ``posexplode`` split each text again, and the report a third time to count its words."""
    docs = make_docs(*DOCS)
    terms = spark.createDataFrame([("one",), ("fox",)], "term string")
    index = decontaminate.postings(docs, terms, 14)
    assert index._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    assert "split(" not in decontaminate.scan(docs, items(spark))._jdf.queryExecution().optimizedPlan().toString()


def test_lengths_come_from_the_ends(spark, make_docs, tuples, monkeypatch):
    docs = make_docs(*DOCS)
    terms = spark.createDataFrame([("one",), ("fox",)], "term string")
    want = sorted(((i, len(words(t))) for i, t in DOCS), key=str)
    plain = decontaminate.postings(docs, terms, 14).count()
    for rows in (decontaminate.BROADCAST_ROWS, -1):
        monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", rows)
        index = decontaminate.postings(docs, terms, 14, ends=True)
        assert tuples(decontaminate.text_lengths(index), "doc_id", "n_words") == want
        assert index.count() == plain + len(DOCS)


def test_only_postings_beside_another_rare_word_are_counted(spark, make_docs, tuples):
    """Others are what a match must hold one of; windows that need one word have no others."""
    df = spark.createDataFrame([("solo", 1), ("a", 2), ("b", 3), ("c", 4), ("d", 5), ("e", 6)], "term string, df long")
    win = spark.createDataFrame([(["solo"],), (["c", "a"],), (["e", "d", "c", "b", "a"],)], "window array<string>")
    got = {(" ".join(w), t): sorted(o) for w, t, o in tuples(decontaminate.near_anchors(win, df), "window", "term", "others")}
    assert got == {("solo", "solo"): [], ("c a", "a"): ["c"], ("e d c b a", "a"): ["b", "c"], ("e d c b a", "b"): ["a", "c"]}


def test_postings_without_a_companion_are_not_written(spark, make_docs, tuples, monkeypatch):
    docs = make_docs((1, "a x x b"), (2, "a x x x"), (3, "solo"), (4, "c x x x x x x x b"), (5, "b"))
    anchors = spark.createDataFrame([(["a", "b"], "a", 0, "b", 1), (["solo"], "solo", 0, "solo", 0)],
                                    "window array<string>, term string, offset int, term2 string, offset2 int")
    near = spark.createDataFrame([(["a", "b"], ["a", "b"], 2, "a", ["b"]), (["c", "b"], ["c", "b"], 2, "c", ["b"]), (["b"], ["b"], 1, "b", [])],
                                 "window array<string>, terms array<string>, needed int, term string, others array<string>")
    kept = decontaminate.companions(anchors, near)
    assert dict(tuples(kept, "term", "beside")) == {"a": ["b"], "b": None, "c": ["b"], "solo": None}
    want = [("a", 1), ("b", 1), ("b", 4), ("b", 5), ("solo", 3)]
    assert tuples(decontaminate.postings(docs, kept, 4), "term", "doc_id") == want
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", -1)
    assert tuples(decontaminate.postings(docs, kept, 4), "term", "doc_id") == want
    monkeypatch.setattr(decontaminate, "COMPANIONS", 0)
    assert {b for _, b in tuples(decontaminate.companions(anchors, near), "term", "beside")} == {None}
