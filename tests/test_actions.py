import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidedesk.operators import actions as a
from tidedesk.schema import TRIM_MARKER


@pytest.fixture
def calls(spark):
    def make(*rows):
        base = {"anomaly_id": 1, "step": 1, "tool": "create_task", "input": {}, "anomaly_type": "x", "stop_reason": "tool_use"}
        full = [{**base, "call_id": i, "pos": i, **r} for i, r in enumerate(rows)]
        names = ["call_id", "anomaly_id", "step", "pos", "tool", "input", "anomaly_type", "stop_reason"]
        return spark.createDataFrame([tuple(r[n] for n in names) for r in full],
            "call_id long, anomaly_id long, step long, pos long, tool string, input map<string,string>, anomaly_type string, stop_reason string")
    return make


def esc(severity, **more):
    return {"tool": "escalate_ticket", "input": {"ticket_id": "T", "reason": "r", "severity": severity, **more}}


def test_catalogue(calls):
    df = calls(esc("low"), esc("extreme"), {"tool": "escalate_ticket", "input": {"severity": "low"}},
               {"tool": "made_up"}, {"tool": None}, {"tool": "get_ticket_history", "input": {"customer_id": "c", "more": "x"}},
               {"tool": "send_alert", "input": {"message": "m", "channel": None}})
    assert [r.call_error for r in a.check_calls(df).orderBy("call_id").collect()] == [
        None, "not allowed: severity", "missing: ticket_id,reason", "Error: tool 'made_up' not found",
        "Error: tool 'None' not found", None, None]


def test_gate(calls):
    done, waiting = a.gate(calls(esc("high"), esc("medium"), {"tool": "send_alert", "input": {"severity": "high"}},
                                 {"tool": "escalate_ticket", "input": {"severity": "high"}}, {"tool": "escalate_ticket"}))
    assert sorted(r.call_id for r in done.collect()) == [1, 2, 4]
    assert [(r.call_id, r.ticket_id) for r in waiting.orderBy("call_id").collect()] == [(0, "T"), (3, "unknown")]


def test_summary_counts_pending_and_unknown(calls):
    df = calls(esc("high"), esc("low"), {"tool": "made_up", "anomaly_id": 2}, {"tool": "create_task", "anomaly_id": 2})
    s = {(r.section, r.name): r.value for r in a.action_summary(df, df.select("anomaly_id").distinct(), df.limit(2)).collect()}
    assert s[("totals", "total_tool_calls")] == 4 and s[("totals", "actions_taken")] == 3 and s[("totals", "pending_approval")] == 1
    assert s[("tool_distribution", "escalate_ticket")] == 1 and s[("tool_distribution", "auto_respond")] == 0
    assert s[("totals", "avg_tool_calls_per_anomaly")] == 2.0 and s[("totals", "context_truncations")] == 2
    assert sum(v for (sec, _), v in s.items() if sec == "tool_distribution") == 2
    none = {(r.section, r.name): r.value for r in a.action_summary(df.limit(0), df.limit(0)).collect()}
    assert none[("totals", "avg_tool_calls_per_anomaly")] == 0.0


def test_step_cap(calls):
    df = calls(*[{"step": s} for s in range(1, 16)], {"step": 10}, *[{"anomaly_id": 2, "step": s} for s in range(0, 60, 5)])
    kept = a.cap_steps(df)
    assert sorted(r.step for r in kept.filter("anomaly_id = 1").collect()) == [*range(1, 11), 10]
    assert sorted(r.step for r in kept.filter("anomaly_id = 2").collect()) == list(range(0, 50, 5))
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()


def turns(spark, **sizes):
    rows = [(int(c[1:]), t, "user", "x" * n) for c, lens in sizes.items() for t, n in enumerate(lens)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_trim(spark):
    df = turns(spark, c1=[40] * 7, c2=[4] * 7, c3=[100] * 5, c4=[100] * 6, c5=[400], c6=[100, 100])
    out = a.trim_context(df, limit=49).orderBy("conv_id", "turn", "is_marker").collect()
    seen = {c: [(r.turn, r.is_marker) for r in out if r.conv_id == c] for c in range(1, 7)}
    m = [(0, False), (0, True)]
    assert seen[1] == m + [(t, False) for t in (3, 4, 5, 6)]
    assert seen[2] == [(t, False) for t in range(7)]
    assert seen[3] == m + [(t, False) for t in (1, 2, 3, 4)]
    assert seen[4] == m + [(t, False) for t in (2, 3, 4, 5)]
    assert seen[5] == m and seen[6] == m + [(1, False)]
    assert {r.text for r in out if r.is_marker} == {TRIM_MARKER}


def test_tokens(spark):
    got = {r.conv_id: r.estimated_tokens for r in a.estimate_tokens(turns(spark, c1=[3], c2=[4, 3], c3=[4, 4])).collect()}
    assert got == {1: 0, 2: 1, 3: 2}


def test_journal_takes_first_tool(calls):
    df = calls({"tool": "send_alert", "pos": 5}, {"tool": "create_task", "pos": 2}, {"step": 2, "tool": None, "stop_reason": "end_turn"})
    got = {r.step: (r.tool_called, r.tool_use_id, r.stop_reason) for r in a.journal(df).collect()}
    assert got == {1: ("create_task", 1, "tool_use"), 2: (None, 2, "end_turn")}


def test_apply_status(calls, make_tickets):
    def upd(ticket, status):
        return {"tool": "update_ticket_status", "input": {"ticket_id": ticket, "new_status": status, "reason": "r"}}
    t = make_tickets(*[{"ticket_id": i} for i in ("a", "a", "b", "c", None)])
    out = a.apply_status(t, calls(upd("a", "closed"), upd("a", "pending"), upd("b", "gone"), {"tool": "create_task"}))
    assert [r.status for r in out.orderBy("row_seq").collect()] == ["pending", "pending", "open", "open", "open"]
    assert out.columns == t.columns


def test_history(make_tickets):
    t = make_tickets({"created_at": "2024-01-02"}, {"created_at": "2024-01-10", "status": "closed"},
                     {"created_at": "2024-03-01"}, {"customer_id": None})
    t = t.withColumn("created_at", F.to_timestamp("created_at"))
    r, = a.customer_history(t, "2024-01-20 00:00:00").collect()
    assert (r.prior_tickets, r.open_tickets, r.closed_tickets, r.pending_tickets, r.days_since_contact) == (2, 1, 1, 0, 10)


def test_status_in_effect(spark):

    t = lambda s: None if s is None else dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    moments = spark.createDataFrame([(i, k, t(s), "x") for i, (k, s) in enumerate(
        [("a", 5), ("a", 10), ("a", 11), ("a", 99), ("b", 1), ("zz", 1), (None, 1), ("a", None), ("b", 50)])],
        "moment_id long, ticket_id string, at timestamp, new_status string")
    updates = spark.createDataFrame([(1, "a", t(10), "pending"), (2, "a", t(10), "closed"), (3, "a", t(20), "reopened"), (4, "b", t(40), None), (5, None, t(0), "open")],
                                    "call_id long, ticket_id string, at timestamp, new_status string")
    tickets = spark.createDataFrame([("a", "open", 1), ("b", "closed", 1), ("b", "pending", 2), (None, "open", 3)], "ticket_id string, status string, row_seq long")
    out = a.status_at(moments, updates, tickets)
    assert out.columns == ["moment_id", "ticket_id", "at", "new_status", "status"]
    assert [r.status for r in out.orderBy("moment_id").collect()] == ["open", "closed", "closed", "closed", "pending", None, None, None, "pending"]
    assert a.status_at(moments.limit(0), updates, tickets).count() == 0
