"""The whole chain from CSV files to logs, with scorers that answer by rule."""

import json

import pandas as pd
import pytest

from pyspark.sql import functions as F

from tidedesk.operators import scoring
from tidedesk.plans import stages
from tidedesk.session import materialize

REPLY = "row_seq long, raw_text string, stop_reason string, input_tokens long, output_tokens long, cache_read_tokens long"
AT = "2024-02-01T00:00:00Z"


def answering(make_reply):
    """A scorer that builds each reply from the prompt text."""
    def scorer(prompts):
        def make():
            def score(b: pd.DataFrame) -> pd.DataFrame:
                return pd.DataFrame({
                    "row_seq": b["row_seq"], "raw_text": [json.dumps(make_reply(p)) for p in b["prompt"]],
                    "stop_reason": "end_turn", "input_tokens": 100, "output_tokens": 10, "cache_read_tokens": 0})
            return score
        return scoring.score_batch(prompts, make, REPLY)
    return scorer


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("run")
    (base / "in").mkdir()
    head = "ticket_id,created_at,customer_id,channel,subject,body,priority,category,status,agent_id\n"
    for f in range(3):
        rows = "".join(
            f"6f1c2f3e-8a52-4c1d-9b3a-{f:04d}{i:08d},2024-01-0{1 + i % 9},c{i % 4},EMAIL,sub {i},"
            f"\"<p>{'angry' if i % 5 == 0 else 'calm'} words about case {i % 7 if f else i}</p>\",low,billing,open,a1\n" for i in range(20))
        (base / "in" / f"{f}.csv").write_text(head + rows)
    out = str(base / "out")
    t = {}
    t["raw"] = stages.ingest_stage(spark, str(base / "in"), out)
    t["norm"] = stages.transform_stage(t["raw"], out, AT)
    t["report"] = stages.quality_stage(t["norm"], f"{out}/quality", "2024-02-01")
    valid = spark.read.parquet(f"{out}/quality/validated")
    one = answering(lambda p: {"category": "billing", "priority": "low", "confidence": 0.5 if "angry" in p else 0.9})
    two = answering(lambda p: {"category": "technical", "priority": "high", "confidence": 0.95})
    t["classified"] = stages.classify_stage(valid, one, two, out)
    t["capped"] = stages.classify_stage(valid, one, two, f"{out}/capped", cap=0.0029)
    t["sampled"] = stages.classify_stage(valid, one, two, f"{out}/sampled", sample=7)
    full = answering(lambda p: {"sentiment": "frustrated" if "angry" in p else "neutral", "sentiment_confidence": 0.8,
                                "entities": {}, "summary": "s", "urgency_score": 0.9, "urgency_reason": "r"} if "case 3" not in p else {})
    simple = answering(lambda p: {"sentiment": "neutral", "summary": "short"} if "sub 3" in p else {})
    t["enriched"] = stages.enrich_stage(t["classified"], full, simple, out)
    t["resumed"] = stages.enrich_stage(t["classified"], answering(lambda p: {}), answering(lambda p: {"sentiment": "positive", "summary": "x"}),
                                       f"{out}/again", previous=t["enriched"])
    verdict = answering(lambda p: {"anomaly_type": "potential_incident", "severity": "high", "reason": "r", "recommended_action": "create_task"})
    stages.detect_stage(t["enriched"].filter("row_seq < 1099511627776"), verdict, out)
    t["anomalies"] = stages.detect_stage(t["enriched"], verdict, out)
    t["out"] = out
    return t


def test_rows_are_kept(run):
    assert [run[k].count() for k in ("raw", "norm", "classified", "enriched", "resumed")] == [60] * 5
    assert run["report"].filter("passed").count() == 9


def test_tiers(run):
    got = {(r.llm_category, r.escalated): r["count"] for r in run["classified"].groupBy("llm_category", "escalated").count().collect()}
    assert got == {("technical", True): 12, ("billing", False): 48}


def test_cap(spark, run):
    # 0.00012 a row: batches start at 0, .0012, .0024, .0036; 30 rows run and spend .0036, past the cap.
    c = run["capped"]
    assert c.filter("llm_category <> 'unknown'").count() == 30 and c.filter("escalated").count() == 0
    assert run["sampled"].count() == 7
    cost = {r.name: r.value for r in spark.read.json(f"{run['out']}/capped/classification_report").filter("section = 'cost'").collect()}
    assert cost == {"tier1": 0.0036, "total": 0.0036, "kept_tier1": 0.0036, "kept_total": 0.0036, "cache_hit_rate": 0.0}


def test_fallback_and_resume(run):
    e = run["enriched"]
    failed = e.filter("enrichment_failed").count()
    assert 0 < failed < 60 and e.filter("urgency_reason like 'Class%' and not enrichment_failed").count() > 0
    r = run["resumed"]
    assert r.filter("enrichment_failed").count() == 0 and r.filter("sentiment = 'positive'").count() == failed


def test_anomalies_and_trend(spark, run):
    a = run["anomalies"]
    assert a.count() > 0 and a.filter("recommended_action <> 'create_task'").count() == 0
    assert spark.read.json(f"{run['out']}/high_severity_alerts").filter("alert_channel = 'email'").count() > 0
    trend = {r.name: r.delta for r in spark.read.json(f"{run['out']}/anomaly_trend").collect()}
    assert trend["anomalies_found"] == trend["type:potential_incident"] > 0


def test_actions(spark, run, tmp_path):
    calls = run["anomalies"].selectExpr(
        "row_seq as call_id", "row_seq as anomaly_id", "1L as step", "1L as pos", "'escalate_ticket' as tool",
        "map('ticket_id', ticket_id, 'reason', reason, 'severity', severity) as input", "anomaly_type", "'tool_use' as stop_reason")
    done, waiting = stages.action_stage(calls, run["anomalies"], str(tmp_path))
    assert done.count() == 0 and waiting.count() == calls.count()
    assert spark.read.json(str(tmp_path / "pending_approval")).count() == calls.count()
    assert spark.read.json(str(tmp_path / "agent_summary")).filter("name = 'pending_approval'").first().value == calls.count()


def test_a_cap_binds_what_the_scorer_is_sent(spark, make_tickets, tmp_path):
    """Every reply costs 0.0012; a cap of 0.012 lets eleven batches' worth of money pass at most one batch over."""
    tickets = materialize(make_tickets(*[{}] * 300), "cap-tickets")
    sent = []

    def scorer(prompts):
        sent.append(prompts.count())
        return prompts.select(
            "row_seq", F.lit('{"category": "billing", "priority": "low", "confidence": 0.9}').alias("raw_text"), F.lit("end_turn").alias("stop_reason"),
            F.lit(1000).alias("input_tokens"), F.lit(100).alias("output_tokens"), F.lit(0).alias("cache_read_tokens"))

    got = stages.score_under_cap(tickets, scorer, 0.012 * 3, (0.8, 4.0), batch=10)
    assert got.count() == sum(sent) == 30 and len(sent) < 6
    sent.clear()
    broken = lambda p: scorer(p).withColumn("raw_text", F.lit("no json"))
    assert stages.score_under_cap(tickets, broken, 0.012, (0.8, 4.0), batch=10).count() == 300 and len(sent) < 8
