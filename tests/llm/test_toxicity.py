import random

import numpy as np
import pytest

from tidedesk.llm import toxicity


def labelled(spark, n=600, seed=3):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice("aeinorst") for _ in range(rng.randrange(2, 8))) for _ in range(60)]
        bad = i % 4 == 0
        if bad:
            for w in rng.sample(["blorgh", "zukking", "framble"], 2):
                words.insert(rng.randrange(60), w)
        docs.append((i, " ".join(words), 1, bad))
        labels.append((i, int(bad)))
    docs += [(1000, None, 1, False), (1001, "", 1, False), (1002, "blorgh zukking " + "nice words " * 5000, 1, True), (None, "framble blorgh", 1, True), (3, "x", 1, False)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, score int, bad boolean")
    return frame, spark.createDataFrame([*labels, (None, 1), (5, None), (8, 1), (8, 0), (99999, 1)], "doc_id long, toxic int")


def test_learns_and_scores_whole_texts(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit(docs, labels, toxicity.Settings(min_docs=3))
    got = toxicity.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == (r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 600]
    right = [(r.score > 0.5) == (r.doc_id % 4 == 0) for r in held]
    assert len(held) > 100 and np.mean(right) > 0.97
    by = {r.doc_id: r.score for r in got}
    assert by[1002] > 0.5 > by[1001] == by[1000]
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and kept.filter("doc_id = 1002").count() == (by[1002] < 0.7)


def test_held_out_labels_are_not_used(spark):
    docs, labels = labelled(spark)
    s = toxicity.Settings(min_docs=3)
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 3 = 1, 1 - toxic, toxic) AS toxic")
    a, b = toxicity.fit(docs, labels, s), toxicity.fit(docs, flipped, s)
    assert np.array_equal(a.buckets, b.buckets) and np.allclose(a.weights, b.weights)


@pytest.mark.parametrize("rows,share", [([], 0.0), ([(0, 1), (2, 1)], 1.0), ([(0, 0)], 0.0)])
def test_one_class_or_none(spark, rows, share):
    docs, _ = labelled(spark, 20)
    labels = spark.createDataFrame(rows, "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert all(r.score == pytest.approx(share, abs=1e-9) for r in got)


def test_empty_table(spark):
    docs, labels = labelled(spark, 20)
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), labels)).count() == 0


def test_ngrams():
    s = toxicity.Settings(orders=(2, 3), bits=20)
    assert len(toxicity.ngram_buckets("abcd", s)) == 3 + 2
    assert np.array_equal(toxicity.ngram_buckets("ABcd", s), toxicity.ngram_buckets("abCD", s))
    assert len(toxicity.ngram_buckets("a", s)) == len(toxicity.ngram_buckets(None, s)) == 0


def test_ratios_and_scores_against_plain_python(spark):
    """Counts, the choice of buckets and every score recomputed from the definition."""
    docs, labels = labelled(spark, 300, seed=5)
    s = toxicity.Settings(min_docs=3, keep=200)
    model = toxicity.fit(docs, labels, s)
    toxic = {}
    for r in labels.collect():
        if r.doc_id is not None and r.toxic is not None:
            toxic[r.doc_id] = max(r.toxic, toxic.get(r.doc_id, 0))
    import zlib

    train = [(r.text, toxic[r.doc_id]) for r in docs.collect()
             if r.doc_id in toxic and zlib.crc32(str(r.doc_id).encode()) % 3 != 1]
    n, n_pos = len(train), sum(t for _, t in train)
    counts = {}
    for text, t in train:
        for b in set(toxicity.ngram_buckets(text, s).tolist()):
            counts.setdefault(b, [0, 0])[t > 0] += 1
    ranked = []
    for b, (neg, pos) in counts.items():
        if pos + neg >= s.min_docs:
            p, q = pos + 1, neg + 1
            ratio = np.log(p / (n_pos + 2)) - np.log(q / (n - n_pos + 2))
            ranked.append((-abs(ratio) / np.sqrt(1 / p + 1 / q), b, ratio))
    ranked.sort(key=lambda x: (round(x[0], 12), x[1]))
    assert set(model.buckets.tolist()) == {b for _, b, _ in ranked[:200]}
    # the fitted weights are coefficients times ratios: of one sign with the ratio wherever the coefficient is positive
    ratios = {b: r for _, b, r in ranked}
    same = [np.sign(w) == np.sign(ratios[int(b)]) for b, w in zip(model.buckets, model.weights, strict=True) if abs(w) > 1e-9]
    assert np.mean(same) > 0.9
    weight = dict(zip(model.buckets.tolist(), model.weights.tolist(), strict=True))
    got = {(r.doc_id, r.score) for r in toxicity.score(docs, model).collect()}
    want = [(r.doc_id, 1 / (1 + np.exp(-(model.intercept + sum(weight.get(b, 0.0) for b in set(toxicity.ngram_buckets(r.text, s).tolist()))))))
            for r in docs.collect()]
    assert sorted(x for _, x in got) == pytest.approx(sorted({x for _, x in want}), abs=1e-9) or len(got) == len(set(want))
    by = {}
    for i, x in want:
        by.setdefault(i, []).append(x)
    for i, x in got:
        assert min(abs(x - y) for y in by[i]) < 1e-9
