import pytest
from pyspark.sql import functions as F

from tidedesk.operators import anomaly as a

LONG = "this body is longer than twenty characters"


@pytest.fixture
def enriched(make_tickets):
    def make(*rows, contact=True):
        df = make_tickets(*[{k: v for k, v in r.items() if k in ("ticket_id", "body", "subject")} | (
            {} if "body" in r else {"body": f"plain body number {i}"}) | (
            {} if "ticket_id" in r else {"ticket_id": f"t{i}"}) for i, r in enumerate(rows)])
        extra = df.sparkSession.createDataFrame(
            [(i, r.get("sentiment", "neutral"), r.get("llm_category", "billing"), r.get("repeat_contact", False))
             for i, r in enumerate(rows)], "row_seq long, sentiment string, llm_category string, repeat_contact boolean")
        out = df.join(extra, "row_seq")
        return out if contact else out.drop("repeat_contact")
    return make


def flags(df):
    return [r.statistical_flags for r in a.anomaly_flags(df).orderBy("row_seq").collect()]


def test_flags_in_order(enriched):
    rows = [{}] * 20 + [
        {"body": "x" * 10_000, "sentiment": "frustrated", "llm_category": "unknown", "repeat_contact": True},
        {"sentiment": "negative", "repeat_contact": True}, {"sentiment": "frustrated"},
        {"sentiment": None, "llm_category": None, "repeat_contact": None}, {"body": None, "llm_category": "unknown"}]
    assert flags(enriched(*rows)) == [""] * 20 + [
        "body_length_spike|frustrated_sentiment|unclassified|repeat_frustrated",
        "repeat_frustrated", "frustrated_sentiment", "", "unclassified"]


def test_repeat_column_may_be_absent(enriched):
    assert flags(enriched({"sentiment": "negative", "repeat_contact": True}, contact=False)) == [""]


def test_spike_needs_two_bodies(enriched):
    assert flags(enriched({"body": "x" * 9999}, {"body": None})) == ["", ""]
    assert flags(enriched({"body": "same"}, {"body": "same"})) == ["", ""]  # deviation 0, not above the mean


def test_duplicates_fold_space_and_case(enriched):
    df = enriched({"body": LONG}, {"body": LONG.upper().replace(" ", "  \n") + " "}, {"body": LONG + "!"},
                  {"body": "short twin"}, {"body": "short twin"}, {"body": None}, {"body": None},
                  {"body": "exactly twenty chars"}, {"body": "exactly twenty chars"})
    assert flags(df) == ["duplicate_body"] * 2 + [""] * 7
    got = {r.row_seq: r.duplicate_body for r in a.duplicate_body(df).collect()}
    assert got == {i: i < 2 for i in range(9)}


def test_first_of_equal_bodies_uses_a_stricter_key(enriched):
    spaced = LONG.replace(" ", "  ")
    df = enriched({"body": LONG}, {"body": LONG.upper()}, {"body": spaced}, {"body": " " + LONG})
    assert [r.row_seq for r in a.chosen_candidates(df).orderBy("row_seq").collect()] == [0, 2]


def test_last_flagged_row_of_an_id_speaks_for_all(enriched):
    df = enriched({"ticket_id": "x", "sentiment": "frustrated"}, {"ticket_id": "x", "llm_category": "unknown"},
                  {"ticket_id": "x"}, {"ticket_id": "y"}, {"ticket_id": None, "sentiment": "frustrated"}, {"ticket_id": None})
    f = a.anomaly_flags(df)
    by_id = [(r.row_seq, r.ticket_id, r.statistical_flags) for r in a.candidates(f).orderBy("row_seq").collect()]
    assert by_id == [(0, "x", "unclassified"), (1, "x", "unclassified"), (2, "x", "unclassified"),
                     (4, "None", "frustrated_sentiment"), (5, "None", "frustrated_sentiment")]
    assert [r.row_seq for r in a.candidates(f, by="row").orderBy("row_seq").collect()] == [0, 1, 4]


def verdicts(spark, *rows):
    return spark.createDataFrame([(i, t, "end_turn") for i, t in rows], "row_seq long, raw_text string, stop_reason string")


def test_anomalies_end_to_end(spark, enriched):
    df = enriched({"sentiment": "frustrated"}, {"sentiment": "frustrated"}, {"sentiment": "frustrated", "body": None},
                  {"llm_category": "unknown"}, {})
    good = '{"anomaly_type": "potential_incident", "severity": "high", "reason": " why ", "recommended_action": "escalate"}'
    out = a.anomalies(df, verdicts(spark, (0, good), (1, "broken"), (2, good)))
    got = [tuple(r)[3:] for r in out.orderBy("row_seq").collect()]
    assert got == [
        ("potential_incident", "high", "why", "escalate", "hybrid"),
        ("frustrated_sentiment", "low", "Classification failed", "monitor", "hybrid"),
        ("frustrated_sentiment", "low", "Ticket body is null; statistical flag only", "manual_review", "statistical"),
        ("unclassified", "low", "Classification failed", "monitor", "hybrid")]
    assert out.columns == ["row_seq", "ticket_id", "statistical_flags", "anomaly_type", "severity", "reason",
                           "recommended_action", "detection_method"]
    alert, = a.alerts(out).collect()
    assert alert.alert_channel == "slack"
    assert alert.message == "HIGH anomaly: ticket t0 — potential_incident. Action: escalate. Reason: why"
    s = {(r.section, r.name): r.value for r in a.anomaly_summary(out).collect()}
    assert s == {("by_type", "potential_incident"): 1, ("by_type", "frustrated_sentiment"): 2, ("by_type", "unclassified"): 1,
                 ("by_severity", "high"): 1, ("by_severity", "low"): 3}
    t = {r.name: r.delta for r in a.anomaly_trend(out, out.filter("anomaly_type <> 'unclassified'").unionByName(
        out.limit(1).withColumn("anomaly_type", F.lit("gone")))).collect()}
    assert t == {"anomalies_found": 0, "type:unclassified": 1, "type:gone": -1}
    d = {r.name: r.value for r in a.detection_totals(df, out).collect()}
    assert d == {"total_tickets": 5, "anomalies_found": 4, "scored": 3}


def test_empty_keeps_the_schema(spark, enriched):
    out = a.anomalies(enriched({}), verdicts(spark, (0, "x")))
    assert out.count() == 0 and set(dict(out.dtypes).values()) == {"bigint", "string"}


def test_prompt(spark, enriched):
    df = enriched({"sentiment": "frustrated", "llm_category": "unknown", "subject": None, "body": "b" * 600}, {"body": "a"}, {"body": "c"})
    p = a.anomaly_input(a.candidates(a.anomaly_flags(df)), df).first().prompt
    assert p.splitlines()[1:] == ["Subject line: ", "Beginning of the text: " + "b" * 500, "Mood: frustrated",
                                  "Assigned category: unknown", "Flags raised: frustrated_sentiment, unclassified"]


def test_sensitivity(spark):
    df = spark.createDataFrame([("x" * n,) for n in [10] * 90 + [500] * 10], "body string")
    got = {r.z: (r.flagged, r.pct_of_total) for r in a.threshold_sensitivity(df).collect()}
    assert got == {2.0: (10, 0.1), 2.5: (10, 0.1), 3.0: (0, 0.0)}
    one = spark.createDataFrame([("x",), (None,)], "body string")
    assert [(r.flagged, r.pct_of_total) for r in a.threshold_sensitivity(one).collect()] == [(0, 0.0)] * 3


def test_partitioning_does_not_change_the_answer(spark, enriched):
    rows = [{"ticket_id": f"t{i % 7}", "body": f"{LONG} {i % 5}", "sentiment": ["frustrated", "neutral"][i % 2]} for i in range(40)]
    df = enriched(*rows)
    one, many = (sorted(map(tuple, a.chosen_candidates(df.repartition(n)).select("row_seq", "statistical_flags").collect())) for n in (1, 9))
    assert one == many


def test_spike_broadcasts_one_row(enriched):
    plan = a.length_spike(enriched({}))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" in plan
