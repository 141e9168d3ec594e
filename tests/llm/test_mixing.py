import math

from tidedesk.llm import mixing


def test_shares_and_order(spark, tuples):
    rows = [(i, "x" * 10, f"src{i % 3}", i) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, shuffle_key long")
    out = mixing.mix(docs, {"src0": 6.0, "src1": 3.0, "src2": 1.0}).collect()
    assert abs(len(out) - 6000) < 4 * math.sqrt(6000)
    share = [sum(r.source == f"src{k}" for r in out) / len(out) for k in range(3)]
    assert all(abs(a - b) < 0.03 for a, b in zip(share, (0.6, 0.3, 0.1), strict=True))
    ids = [r.doc_id for r in out]
    assert sum(a < b for a, b in zip(ids, ids[1:], strict=False)) < 0.6 * len(ids)
    again = tuples(mixing.mix(docs.repartition(3), {"src0": 6.0, "src1": 3.0, "src2": 1.0}), "doc_id", "copy", "shuffle_key")
    assert again == sorted(((r.doc_id, r.copy, r.shuffle_key) for r in out), key=str)


def test_large_means_are_poisson(spark):
    docs = spark.createDataFrame([(i, "x", "rare") for i in range(400)] + [(i, "x", "rest") for i in range(400, 12400)],
                                 "doc_id long, text string, source string")
    counts = mixing.mix(docs, {"rare": 1.0, "rest": 1.0}).filter("source = 'rare'").groupBy("doc_id").count().collect()
    n = [r["count"] for r in counts] + [0] * (400 - len(counts))
    mean = sum(n) / 400
    assert abs(mean - 15.5) < 1 and 0.7 < sum((x - mean) ** 2 for x in n) / 400 / mean < 1.3


def test_odd_rows(spark, tuples):
    schema = "doc_id long, text string, source string"
    docs = spark.createDataFrame([(1, None, "a"), (2, "t", None), (None, "t", "b"), (None, "t", "b"), (4, "t", "other")], schema)
    out = mixing.mix(docs, {"a": 1.0, "b": 3.0})
    assert set(tuples(out, "source")) <= {("b",)}
    assert len([r for r in out.collect() if r.copy == 1]) in (0, 2)
    assert mixing.mix(spark.createDataFrame([], schema), {"a": 1.0}).count() == 0


def test_unlisted_sources_share_a_weight(spark, tuples):
    rows = [(i, "x" * 10, ("a", "wiki", None, "zero")[i % 4]) for i in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = {"a": 3.0, "zero": 0.0, "absent": 2.0}
    out = mixing.mix(docs, weights, others=5.0).collect()
    assert {r.source for r in out} == {"a", "wiki", None}
    listed = sum(r.source == "a" for r in out) / len(out)
    assert abs(listed - 3 / (3 + 5)) < 0.03 and abs(len(out) - 6000) < 4 * 6000 ** 0.5
    rates = {r.source: (r.rows, r.mass, r.weight, round(r.rate, 6)) for r in mixing.rates(docs, weights, others=5.0).collect()}
    total = 60_000
    assert rates == {"a": (2000, 20_000, 3.0, round(3 / 8 * total / 20_000, 6)), None: (4000, 40_000, 5.0, round(5 / 8 * total / 40_000, 6)),
                     "zero": (2000, 20_000, 0.0, 0.0)}
    gone = mixing.rates(docs, weights).filter("rate = 0").collect()
    assert sorted((str(r.source), r["rows"]) for r in gone) == [("None", 4000), ("zero", 2000)]
    assert tuples(mixing.mix(docs.filter("source = 'wiki'"), weights, others=1.0).select("source").distinct(), "source") == [("wiki",)]


def test_null_ids_are_not_one_key(spark):
    docs = spark.createDataFrame([(None, f"text {i}", "a") for i in range(300)], "doc_id long, text string, source string")
    out = mixing.mix(docs, {"a": 1.0})
    assert out.select("shuffle_key").distinct().count() > 100 and out.select("text").distinct().count() < 300


def test_a_very_long_text(spark):
    docs = spark.createDataFrame([(1, "x" * 3_000_000, "a"), (2, "y", "a"), (3, "z", "b")], "doc_id long, text string, source string")
    rates = {r.source: r.mass for r in mixing.rates(docs, {"a": 1.0, "b": 1.0}).collect()}
    assert rates == {"a": 3_000_001, "b": 1}


def test_no_python_in_plan(spark, make_docs):
    plan = mixing.mix(make_docs((1, "a")), {"src1": 1.0})._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan.split("== Physical Plan ==")[1]
