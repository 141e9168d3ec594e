import json

import pytest
from pyspark.sql import functions as F

from tidedesk.functions import replies as r
from tidedesk.functions.text import strip_fences

GOOD = {"category": "billing", "priority": "low", "confidence": 0.9}


def parse(spark, contract, *texts, stop="end_turn"):
    rows = [(i, t if t is None or isinstance(t, str) else json.dumps(t), stop) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, raw_text string, stop_reason string")
    return [x.reply for x in r.parse_replies(df, contract).orderBy("i").collect()]


def ok(spark, contract, *texts, **kw):
    return [x is not None for x in parse(spark, contract, *texts, **kw)]


@pytest.mark.parametrize("text, want", [
    ('{"a": 1}', '{"a": 1}'),
    ('```json\n{"a": 1}\n```', '{"a": 1}'),
    ('  ```\n{"a": 1}\n  ```  ', '{"a": 1}'),
    ('```json\n{"a": 1}', '{"a": 1}'),
    ('```json\r\n{"a": 1}\r\n```', '{"a": 1}'),
    ('```json\n{"a":\n 1}\n\n```', '{"a":\n 1}'),
    ('``` {"a": 1} ```', ""),
    ("```", ""),
    ("```\n```", ""),
    ('{"a": "```"}', '{"a": "```"}'),
])
def test_fences(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(strip_fences(F.col("t"))).first()[0] == want


def test_classification_values(spark):
    got = parse(spark, r.CLASSIFICATION, GOOD, {**GOOD, "confidence": "0.12345"}, {**GOOD, "confidence": 1, "x": []},
                '```json\n{"category": "other", "priority": "critical", "confidence": 0}\n```')
    assert [(x.category, x.priority, x.confidence) for x in got] == [
        ("billing", "low", 0.9), ("billing", "low", 0.123), ("billing", "low", 1.0), ("other", "critical", 0.0)]


def test_classification_rejects(spark):
    bad = [{**GOOD, "category": "refund"}, {**GOOD, "priority": 3}, {**GOOD, "confidence": 1.01}, {**GOOD, "confidence": -0.1},
           {**GOOD, "confidence": None}, {**GOOD, "confidence": "high"}, {"category": "billing"}, [GOOD], "not json", "",
           json.dumps(GOOD) + " thanks", json.dumps(GOOD) + "," + json.dumps(GOOD), json.dumps(GOOD) + "] x",
           json.dumps(GOOD) + "} x", str(GOOD), '{"category": "billing", "priority": "low", "confidence": NaN}', None]
    assert ok(spark, r.CLASSIFICATION, *bad) == [False] * len(bad)


def test_the_last_of_repeated_keys_counts(spark):
    got = parse(spark, r.CLASSIFICATION, '{"category": "refund", "priority": "low", "confidence": 0.1, "category": "billing", "confidence": 0.9}',
                '{"category": "billing", "priority": "low", "confidence": 0.9, "category": "refund"}')
    assert got[1] is None and (got[0].category, got[0].confidence) == ("billing", 0.9)
    full = json.dumps(FULL).replace('"product_names": ["a"]', '"product_names": [1], "product_names": ["b"]')
    x, = parse(spark, r.ENRICHMENT, full[:-1] + ', "summary": "Later."}')
    assert x.summary == "Later." and x.entities.product_names == ["b"]


def test_refusal(spark):
    assert ok(spark, r.CLASSIFICATION, GOOD, stop="refusal") == [False]
    assert ok(spark, r.CLASSIFICATION, GOOD, stop=None) == [True]


FULL = {"sentiment": "neutral", "sentiment_confidence": "0.8765", "entities": {"product_names": ["a"]},
        "summary": " It broke. ", "urgency_score": 0.456, "urgency_reason": "r"}


def test_enrichment_values(spark):
    x, = parse(spark, r.ENRICHMENT, FULL)
    assert (x.sentiment_confidence, x.summary, x.urgency_score) == (0.877, "It broke.", 0.46)
    assert x.entities.asDict() == {"product_names": ["a"], "error_codes": [], "account_ids": []}
    empty, = parse(spark, r.ENRICHMENT, {**FULL, "entities": {}})
    assert empty.entities.product_names == []
    listed, = parse(spark, r.ENRICHMENT, {**FULL, "entities": {"account_ids": []}})
    assert listed.entities.account_ids == []


def test_enrichment_rejects(spark):
    bad = [{**FULL, "summary": "  "}, {**FULL, "summary": 5}, {**FULL, "urgency_reason": ""}, {**FULL, "entities": None},
           {**FULL, "entities": []}, {**FULL, "entities": {"error_codes": [1]}}, {**FULL, "entities": {"error_codes": "E1"}},
           {**FULL, "entities": {"error_codes": ["a", None]}}, {**FULL, "entities": {"error_codes": [None]}},
           {**FULL, "entities": {"error_codes": None}}, {**FULL, "urgency_score": 1.5}, {**FULL, "sentiment": "angry"},
           {k: v for k, v in FULL.items() if k != "entities"}]
    assert ok(spark, r.ENRICHMENT, *bad) == [False] * len(bad)


def test_verdict(spark):
    good = {"anomaly_type": "potential_incident", "severity": "high", "reason": " x ", "recommended_action": "monitor"}
    x, = parse(spark, r.VERDICT, good)
    assert x.reason == "x"
    assert ok(spark, r.VERDICT, {**good, "severity": "critical"}, {**good, "reason": " "},
              {**good, "recommended_action": "manual_review"}) == [False] * 3
