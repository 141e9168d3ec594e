import json

from pyspark.sql import functions as F

from tidedesk.operators import enrich as e
from tidedesk.operators.keyed import attach_by_key

FULL = {"sentiment": "positive", "sentiment_confidence": 0.9, "entities": {"error_codes": ["E1"]},
        "summary": "s", "urgency_score": 0.7, "urgency_reason": "u"}
SIMPLE = {"sentiment": "negative", "summary": "short"}


def replies(spark, *rows):
    return spark.createDataFrame(
        [(i, json.dumps(t) if isinstance(t, dict) else t, stop, 10, 2, 1) for i, t, stop in rows],
        "row_seq long, raw_text string, stop_reason string, input_tokens long, output_tokens long, cache_read_tokens long")


def some(spark):
    full = replies(spark, (0, FULL, "end_turn"), (1, "bad", "end_turn"), (2, "bad", "end_turn"),
                   (3, FULL, "refusal"), (4, None, "end_turn"))
    simple = replies(spark, (1, SIMPLE, "end_turn"), (2, {"sentiment": "negative"}, "end_turn"),
                     (3, SIMPLE, "end_turn"), (4, SIMPLE, "end_turn"))
    return e.enrichment_results(full, simple)


def test_fallback(spark, make_tickets):
    out = e.merge_enrichment(make_tickets(*[{}] * 6), some(spark)).orderBy("row_seq").collect()
    assert [r.enrichment_failed for r in out] == [False, False, True, True, True, True]
    assert [r.sentiment for r in out] == ["positive", "negative", None, None, None, None]
    assert [r.sentiment_confidence for r in out[:3]] == [0.9, 0.5, None]
    assert [r.urgency_score for r in out] == [0.7] + [0.5] * 5
    assert out[1].urgency_reason == out[5].urgency_reason == "Classification failed; manual review required"


def test_entities_text_is_always_json(spark, make_tickets):
    out = e.merge_enrichment(make_tickets(*[{}] * 2), some(spark).filter("row_seq = 0")).orderBy("row_seq")
    text = [json.loads(r[0]) for r in out.select(e.entities_json(F.col("entities"))).collect()]
    assert text == [{"product_names": [], "error_codes": ["E1"], "account_ids": []},
                    {"product_names": [], "error_codes": [], "account_ids": []}]
    assert [tuple(r) for r in e.entity_counts(out).collect()] == [("error_codes", "E1", 1)]


def test_usage(spark):
    got = {r.model: (r.replies, r.input_tokens, r.cache_read_tokens) for r in e.usage_by_model(some(spark)).collect()}
    assert got == {"small": (1, 10, 1), "large": (1, 10, 0)}


def test_resume(spark, make_tickets):
    base = make_tickets(*[{}] * 6)
    prev = e.repeat_contact(e.merge_enrichment(base, some(spark)))
    again = e.enrichment_results(replies(spark, (0, {**FULL, "summary": "never"}, "end_turn"), (2, {**FULL, "summary": "new"}, "end_turn"),
                                         (3, "bad", "end_turn")), replies(spark, (3, "bad", "end_turn")))
    out = e.resume(prev, again).orderBy("row_seq").collect()
    assert [r.summary for r in out] == ["s", "short", "new", None, None, None]
    assert [r.enrichment_failed for r in out] == [False, False, False, True, True, True]
    assert all(r.repeat_contact for r in out)


def test_repeat_contact(make_tickets):
    df = make_tickets(*[{"customer_id": c} for c in ("a", "a", "a", "b", "b", None, None, None, "c")])
    got = [r.repeat_contact for r in e.repeat_contact(df).orderBy("row_seq").collect()]
    assert got == [True] * 3 + [False] * 6


def test_report(spark, make_tickets):
    out = e.repeat_contact(e.merge_enrichment(make_tickets(*[{}] * 6), some(spark)))
    rep = {(r.section, r.name): r.value for r in e.enrichment_report(out).collect()}
    assert rep[("totals", "failed")] == 4 and rep[("totals", "enrichment_failed_pct")] == 0.6667
    assert rep[("sentiment_distribution", "frustrated")] == 0 and rep[("sentiment_distribution", "positive")] == 1
    assert rep[("urgency_distribution", "medium (0.4-0.6)")] == 5 and rep[("totals", "repeat_contacts")] == 6
    none = {(r.section, r.name): r.value for r in e.enrichment_report(out.limit(0)).collect()}
    assert none[("totals", "enrichment_failed_pct")] == 0.0


def test_hot_and_null_keys_are_spread(spark):
    """A third of the rows under one key and a third under null, far more keys than the heavy limit."""
    n = 30_000
    rows = spark.range(n).select(
        F.col("id").alias("row_seq"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 5000)).alias("key"))
    per_key = rows.filter("key is not null").groupBy("key").agg(F.min("row_seq").alias("first"))
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
             "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        out = attach_by_key(rows, "key", per_key, ["first"])
        parts = out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.sum("first"))
        sizes = [r.n for r in parts.collect()]
        plain = rows.join(per_key, "key", "left").select("row_seq", "first")
        assert out.select("row_seq", "first").exceptAll(plain).count() == 0 and out.count() == n
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert max(sizes) < 1.3 * n / 16
