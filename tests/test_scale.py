"""What must hold at scale: even partitions, narrow exchanges, whole inputs."""

import re

import pytest
from pyspark.sql import functions as F

from tidedesk.functions.clean import parse_ts
from tidedesk.operators import actions, anomaly, enrich, keyed, scoring
from tidedesk.operators.normalize import normalize
from tidedesk.plans import stages
from tidedesk.plans.catalog import QUERIES
from tidedesk.sources.tickets import read_tickets


def wide_exchanges(df, column):
    """Exchanges whose rows carry ``column``."""
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return len(re.findall(rf"\) Exchange\nInput \[\d+\]: \[[^\]]*\b{column}#", plan))


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_many_equal_keys_stay_even(spark, no_broadcast):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    try:
        rows = spark.range(300_000).select(F.col("id").alias("row_seq"), (F.col("id") % 3000).alias("k"))
        per = keyed.count_by_key(rows, "k").withColumn("v", F.col("n") > 1)
        out = keyed.attach_by_key(rows, "k", per, ["v"])
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("v").alias("count")).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 300_000 and max(sizes) < 2 * 300_000 / 400


def test_bodies_stay_out_of_exchanges(spark, make_tickets, no_broadcast):
    t = normalize(make_tickets({}, {"customer_id": "c"}), "2024-02-01T00:00:00Z").withColumns(
        {"sentiment": F.lit("frustrated"), "llm_category": F.lit("unknown")})
    flags = anomaly.anomaly_flags(t, contacts=True)
    assert wide_exchanges(flags, "body") == 0
    assert wide_exchanges(anomaly.anomaly_input(flags, t), "body") == 0
    none = spark.createDataFrame([], "row_seq long, ok boolean, category string, priority string, confidence double")
    assert wide_exchanges(scoring.merge_tiers(t, none, none), "body") == 1
    results = spark.createDataFrame([], "row_seq long, ok boolean, sentiment string, sentiment_confidence double, summary string,"
                                    " urgency_score double, urgency_reason string").withColumn("entities", enrich.no_entities())
    assert wide_exchanges(enrich.merge_enrichment(t, results, contacts=True), "body") == 1


def test_resume_moves_failed_rows_only(spark, make_tickets, no_broadcast, tmp_path):
    none = spark.createDataFrame([], "row_seq long, ok boolean, sentiment string, sentiment_confidence double, summary string,"
                                 " urgency_score double, urgency_reason string").withColumn("entities", enrich.no_entities())
    t = normalize(make_tickets({}, {"customer_id": "c"}), "2024-02-01T00:00:00Z")
    enrich.merge_enrichment(t, none, contacts=True).write.parquet(str(tmp_path / "prev"))
    out = enrich.resume(spark.read.parquet(str(tmp_path / "prev")), none)
    plan = out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    assert wide_exchanges(out, "body") == 1 and out.columns[-1] == "repeat_contact"
    # the branch of the kept rows is a scan and a filter
    assert re.search(r"Union \(\d+\)\n\s*:- Filter \(\d+\)\n\s*:\s+\+- Scan parquet", plan)


def test_swapped_headers_fail_loudly(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("b,a\n1,2\n")
    by_name = sorted((r.a, r.b) for r in read_tickets(spark, str(tmp_path)).collect())
    assert by_name == [("1", "2"), ("2", "1")]
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_tickets(spark, str(tmp_path), columns=["a", "b"]).collect()


def test_empty_input_passes_the_transform_stage(make_tickets, tmp_path):
    none = make_tickets({}).limit(0)
    assert stages.transform_stage(none, str(tmp_path), "2024-02-01T00:00:00Z").count() == 0


@pytest.mark.parametrize("text,want", [
    ("12/31/99 11:59:59 PM", "1999-12-31 23:59:59"), ("5th January 2024 3:04 pm", "2024-01-05 15:04:00"), ("13.02.2024", "2024-02-13 00:00:00"),
    ("Mon, 15 Jan 2024 10:30:00 +0200", "2024-01-15 08:30:00"), ("2024-01-15 10:30:00 -0500", "2024-01-15 15:30:00"), ("now", None), ("10:30", None),
    ("32/01/2024", None), ("Jan 32 2024", None), ("20241301", None),
])
def test_dates(spark, text, want):
    at = spark.range(1).select(F.date_format(parse_ts(F.lit(text)), "yyyy-MM-dd HH:mm:ss")).first()[0]
    assert at == want


CALL = "call_id long, anomaly_id long, step long, pos long, tool string, stop_reason string, input map<string,string>"


def test_a_run_ends_where_it_did_not_stop_for_tools(spark):
    calls = spark.createDataFrame([
        (1, 7, 1, 1, "send_alert", "tool_use", None), (2, 7, 1, 2, "create_task", "end_turn", {}), (3, 7, 2, 3, "send_alert", "end_turn", {}),
        (4, 7, 3, 4, "send_alert", "tool_use", {}), (5, 8, 1, 5, "send_alert", "tool_use", {}), (6, 9, 1, 6, "send_alert", None, {})], CALL)
    assert sorted(r.call_id for r in actions.executed(calls).collect()) == [1, 2, 5]
    steps = spark.createDataFrame([(7, 1, "tool_use"), (7, 2, "end_turn"), (8, 1, "tool_use"), (8, 2, "end_turn")],
                                  "anomaly_id long, step long, stop_reason string")
    log = {(r.anomaly_id, r.step): (r.tool_called, r.stop_reason) for r in actions.journal(calls, steps).collect()}
    assert log[8, 2] == (None, "end_turn") and log[7, 1] == ("send_alert", "tool_use") and len(log) == 6
    assert actions.check_calls(calls).filter("call_id = 1").first().call_error == "missing: message,channel"


def test_history_counts_tickets_without_a_date(spark):
    t = spark.createDataFrame([("a", "open", None), ("a", "open", "2024-01-01"), ("b", "closed", None), ("b", "open", "2030-01-01")],
                              "customer_id string, status string, created_at string").withColumn("created_at", F.col("created_at").cast("timestamp"))
    got = {r.customer_id: (r.prior_tickets, r.days_since_contact) for r in actions.customer_history(t, "2024-02-01 00:00:00").collect()}
    assert got == {"a": (2, 31), "b": (1, None)}


def rows_joined(node):
    """Rows that the joins of an executed plan have made, each counted once."""
    children = [node.children().apply(i) for i in range(node.children().size())]
    own = node.metrics().apply("numOutputRows").value() if "Join" in node.nodeName() else 0
    return own + sum(rows_joined(c) for c in children)


def test_incidents_cost_no_pairs(spark, no_broadcast, tmp_path):
    # 3,000 events, a third of them incidents that last for hundreds of the others; the last have no end or one before they begin
    kind = F.when(F.col("event_id") % 3 == 0, "error").otherwise("view")
    value = F.when(F.col("event_id") == 2_997, None).when(F.col("event_id") == 2_994, -3.0).otherwise(10.0 + F.col("event_id") % 5)
    spark.range(3_000).withColumnRenamed("id", "event_id").select(
        "event_id", F.timestamp_seconds(1_704_067_200 + F.col("event_id") / 2).alias("ts"), kind.alias("event_type"), value.alias("value"),
    ).write.parquet(f"{tmp_path}/events.parquet")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = QUERIES["i3_incident_tickets"](spark, str(tmp_path))
        got = {r.incident_id: tuple(r)[1:] for r in out.collect()}
        joined = rows_joined(out._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")

    def want(i):
        last = i if i in (2_994, 2_997) else min(2_999, 28_800 * 120 if i % 250 == 0 else i + (10 + i % 5) * 120 - 1)
        return last - i + 1, i, last

    assert got == {i: want(i) for i in range(0, 3_000, 3)}
    assert 0 < joined < 20_000 < 500_000 < sum(n for n, *_ in got.values())
