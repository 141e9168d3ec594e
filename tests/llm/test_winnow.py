import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidedesk.llm import winnow


def texts(seed, n=25):
    rng = random.Random(seed)
    return [(i * 7 % 97, rng.choice([" ", "\n "]).join(rng.choice("abcdé") * rng.randrange(1, 3) for _ in range(rng.randrange(0, 60)))) for i in range(n)]


def kept(hashes, w):
    """Winnowing as defined: the rightmost smallest hash of each window of ``w``."""
    if not hashes:
        return []
    spans = [range(len(hashes))] if len(hashes) < w else [range(i, i + w) for i in range(len(hashes) - w + 1)]
    return sorted({min(s, key=lambda i: (hashes[i], -i)) for s in spans})


@pytest.mark.parametrize("k,w", [(3, 4), (2, 1), (5, 8)])
def test_selection_against_definition(spark, k, w):
    docs = spark.createDataFrame([*texts(k), (200, None), (201, " "), (202, "a"), (203, "a " * 90)], "doc_id long, text string")
    words = F.transform(F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), ""), lambda x: F.xxhash64(x))
    df = winnow.with_fingerprint(docs, "text", "f", k, w).withColumn("w", words)
    rows = df.select(winnow.as_string(F.col("f")).alias("s"), "w").collect()

    def polynomial(run):
        """Each word's hash turned left by the number of words after it."""
        out = 0
        for j, h in enumerate(run):
            n, h = (len(run) - 1 - j) % 64, h % 2**64
            out ^= (h << n | h >> (64 - n)) % 2**64 if n else h
        return out - 2**64 if out >= 2**63 else out

    raw = [[polynomial(r.w[i:i + k]) for i in range(len(r.w) - k + 1)] if len(r.w) >= k else [polynomial(r.w)] if r.w else [] for r in rows]
    flat = spark.createDataFrame([(x,) for x in {h for g in raw for h in g}], "x long").select("x", F.xxhash64("x").alias("m"))
    mixed = {r.x: (r.m % 2**64) >> 21 for r in flat.collect()}
    for r, g in zip(rows, raw, strict=True):
        hashes = [mixed[h] for h in g]
        assert r.s == ",".join(f"{hashes[i]:x}:{i}" for i in kept(hashes, w))


def test_positions_of_a_very_long_text(spark):
    """Beyond 2**20 words: positions are whole and ties still go to the right."""
    n = 2**20 + 40
    docs = spark.range(1).select(F.lit(1).alias("doc_id"), F.array_join(F.concat(
        F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.concat(F.lit("w"), i.cast("string"))), F.array_repeat(F.lit("same"), 30)), " ").alias("text"))
    last = winnow.with_fingerprint(docs, "text", "f").select(F.slice(F.transform("f", lambda v: v["p"]), -40, 40).alias("p"), F.size("f").alias("n")).first()
    assert last.p == sorted(last.p) and last.p[-1] == n + 30 - winnow.K and last.p[0] > 2**20 - 400 and last.n > n / winnow.W
    tail = [p for p in last.p if p >= n]
    assert tail == list(range(min(tail), n + 30 - winnow.K + 1))


def test_edits_and_neighbours(make_docs):
    docs = dict(texts(9)) | {300: "", 301: "x", 302: "one two three four five six seven eight nine ten", 303: "one two three four five six seven eight nine ten"}
    got = {r.doc_id: r for r in winnow.compare_with_edits(make_docs(*docs.items())).collect()}
    ids = sorted(docs, reverse=True)
    assert sorted(got) == sorted(ids)
    for i, nxt in zip(ids, [*ids[1:], ids[0]], strict=True):
        t, cut = docs[i], len(docs[i]) // 3
        edited = t[:len(t) - cut] + docs[nxt][:cut]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b = ({x.split(":")[0] for x in got[j].fingerprint.split(",") if x} for j in (i, nxt))
        e = {x.split(":")[0] for x in got[i].edited_fingerprint.split(",") if x}
        for value, other in ((got[i].near_next, b), (got[i].near_edited, e)):
            assert value == pytest.approx(len(a & other) / len(a | other) if a | other else 1.0)
    assert got[302].fingerprint == got[303].fingerprint and got[303].near_next == 1.0


def test_shared_run_shares_a_hash(spark):
    rng = random.Random(1)
    run = " ".join(str(rng.random()) for _ in range(winnow.K + winnow.W - 1))
    rows = [(i, " ".join(str(rng.random()) for _ in range(20)) + f" {run} " + " ".join(str(rng.random()) for _ in range(i))) for i in range(20)]
    df = winnow.with_fingerprint(spark.createDataFrame(rows, "doc_id long, text string"), "text", "f")
    sets = [set(r.h) for r in df.select(winnow.kept_hashes(F.col("f")).alias("h")).collect()]
    assert set.intersection(*sets)


def test_odd_rows(make_docs):
    def result(*pairs):
        return sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in winnow.compare_with_edits(make_docs(*pairs)).collect()), key=str)

    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert result() == []
    assert result((1, "abcdef")) == [(1, 6, sha("abcdab"))]
    assert result((1, None)) == [(1, 0, sha(""))]
    assert result((1, "abc"), (None, "xyz")) == sorted([(1, 3, sha("abx")), (None, 3, sha("xya"))], key=str)
    assert result((5, "abc"), (5, "abc"), (1, "xyz")) == sorted([(1, 3, sha("xya")), (5, 3, sha("aba")), (5, 3, sha("abx"))], key=str)


def test_null_ids_are_dealt_by_text(make_docs, spark):
    pairs = [(None, f"text number {i} of many") for i in range(60)] + [(i, f"known {i}") for i in range(10)]
    dealt = winnow.with_next(make_docs(*pairs))
    assert dealt.filter("doc_id is null and not guest").select("bucket").distinct().count() > 8
    order = [t for _, t in sorted(((-i, t) for i, t in pairs if i is not None))]
    hashed = spark.createDataFrame([(t,) for i, t in pairs if i is None], "t string").orderBy(F.xxhash64("t")).collect()
    order += [r.t for r in hashed]
    want = sorted(hashlib.sha256((t[:len(t) - len(t) // 3] + n[:len(t) // 3]).encode()).hexdigest() for t, n in zip(order, [*order[1:], order[0]], strict=True))
    assert sorted(r.edited_sha256 for r in winnow.compare_with_edits(make_docs(*pairs)).collect()) == want


def test_no_python_in_plan(make_docs):
    plan = winnow.compare_with_edits(make_docs((1, "a b"), (2, "c")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
