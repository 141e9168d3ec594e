"""Tool calls proposed for anomalies: checks, approval gate, limits, summaries.

Input frames:
``calls``  (call_id, anomaly_id, step, pos, tool, input map<string,string>, anomaly_type)
``turns``  (conv_id, turn, role, text)
The ids, ``step``, ``pos`` and ``turn`` are never null.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidedesk.operators.keyed import attach_by_key
from tidedesk.operators.ordered import asof_join
from tidedesk.operators.quality import as_of_literal
from tidedesk.operators.scoring import tally
from tidedesk.schema import STATUSES, TOOL_ARGUMENTS, TOOL_CHOICES, TRIM_MARKER

MAX_STEPS = 10
TOKEN_LIMIT = 40_000
CHARS_PER_TOKEN = 4


def _texts(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def check_calls(calls: DataFrame) -> DataFrame:
    """Add ``call_error``: unknown tool, missing arguments, or a value not allowed.

    The catalogue is six tools, so it is part of the expression, not a join.
    """
    tool, given = F.col("tool"), F.col("input")
    required = F.create_map(*[x for t, a in TOOL_ARGUMENTS.items() for x in (F.lit(t), _texts(a))])
    given = F.coalesce(given, F.create_map().cast("map<string,string>"))
    missing = F.array_except(F.try_element_at(required, tool), F.map_keys(given))
    bad = F.filter(F.array(*[
        F.when((tool == t) & ~F.try_element_at(given, F.lit(arg)).isin(allowed), F.lit(arg))
        for (t, arg), allowed in TOOL_CHOICES.items()
    ]), lambda x: x.isNotNull())
    error = (
        F.when(~F.coalesce(tool.isin(list(TOOL_ARGUMENTS)), F.lit(False)),
               F.concat(F.lit("Error: tool '"), F.coalesce(tool, F.lit("None")), F.lit("' not found")))
        .when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ",")))
        .when(F.size(bad) > 0, F.concat(F.lit("not allowed: "), F.array_join(bad, ",")))
    )
    return calls.withColumn("call_error", error)


def needs_approval() -> Column:
    return F.coalesce(
        (F.col("tool") == "escalate_ticket")
        & (F.try_element_at("input", F.lit("severity")) == "high"), F.lit(False)
    )


def steps_of(calls: DataFrame) -> DataFrame:
    """``(anomaly_id, step, stop_reason)`` of the steps that made calls; the first call speaks for its step."""
    return calls.groupBy("anomaly_id", "step").agg(F.min_by("stop_reason", "pos").alias("stop_reason"))


def executed(calls: DataFrame, steps: DataFrame | None = None) -> DataFrame:
    """Calls before the end of their anomaly's run.

    A run ends at its first step that did not stop for tools: the calls of that step and of all later
    ones are not executed. ``steps`` has a row per step, with or without calls; by default the steps
    with calls.
    """
    ends = (
        (steps_of(calls) if steps is None else steps)
        .filter(F.coalesce(F.col("stop_reason") != "tool_use", F.lit(True)))
        .groupBy("anomaly_id").agg(F.min("step").alias("_end"))
    )
    return attach_by_key(calls, "anomaly_id", ends, ["_end"], spread="call_id").filter(
        F.col("_end").isNull() | (F.col("step") < F.col("_end"))).drop("_end")


def gate(calls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into (actions, pending): high-severity escalations wait for a human."""
    waiting = calls.filter(needs_approval()).withColumn(
        "ticket_id", F.coalesce(F.try_element_at("input", F.lit("ticket_id")), F.lit("unknown"))
    )
    return calls.filter(~needs_approval()), waiting


def customer_history(tickets: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    """Per customer: tickets, tickets per status, days since the last contact.

    Tickets without a date count; the last contact needs one and is null without.
    """
    return (
        tickets.filter(F.col("customer_id").isNotNull() & F.coalesce(F.col("created_at") <= as_of_literal(as_of), F.lit(True)))
        .groupBy("customer_id")
        .agg(F.count("*").alias("prior_tickets"),
             *[F.count_if(F.col("status") == s).alias(f"{s}_tickets") for s in STATUSES],
             F.datediff(as_of_literal(as_of), F.max("created_at")).alias("days_since_contact"))
    )


def apply_status(tickets: DataFrame, actions: DataFrame) -> DataFrame:
    """Ticket table after the latest executed status update of each ticket.

    ``actions`` needs ``call_id`` (its order) and must hold executed calls only.
    """
    wanted = F.try_element_at("input", F.lit("new_status"))
    latest = (
        actions.filter((F.col("tool") == "update_ticket_status") & wanted.isin(STATUSES))
        .select(F.try_element_at("input", F.lit("ticket_id")).alias("ticket_id"),
                wanted.alias("_new"), "call_id")
        .filter(F.col("ticket_id").isNotNull())
        .groupBy("ticket_id").agg(F.max_by("_new", "call_id").alias("_new"))
    )
    return attach_by_key(tickets, "ticket_id", latest, ["_new"]).withColumn(
        "status", F.coalesce("_new", "status")
    ).drop("_new")


def status_at(moments: DataFrame, updates: DataFrame, tickets: DataFrame) -> DataFrame:
    """``moments`` with the status in effect then: that of the ticket's last update not later, else the ticket's first status.

    ``moments`` (moment_id unique, ticket_id, at), ``updates`` (call_id, ticket_id, at, new_status): of updates at one time
    the one with the largest ``call_id`` holds; those to another status than ``STATUSES`` never took effect. ``tickets``
    (ticket_id, status), of a repeated id the row with the largest ``row_seq``. A moment without ticket or time, or of an
    unknown ticket without updates, gets null. One ticket may hold any share of moments and updates.
    """
    valid = updates.filter(F.col("new_status").isin(STATUSES)).select(
        F.col("ticket_id").alias("_t"), F.col("at").alias("_at"), "call_id", F.col("new_status").alias("_new"))
    found = asof_join(moments, valid, "ticket_id", "at", "_at", ["_new"], right_key="_t", right_seq="call_id", left_id="moment_id")
    first = tickets.filter(F.col("ticket_id").isNotNull()).groupBy("ticket_id").agg(F.max_by("status", "row_seq").alias("_first"))
    both = attach_by_key(found, "ticket_id", first, ["_first"], spread="moment_id")
    status = F.when(F.col("at").isNotNull(), F.coalesce("_new", "_first"))
    return both.select(*moments.columns, status.alias("status"))


def cap_steps(calls: DataFrame, limit: int = MAX_STEPS) -> DataFrame:
    """Calls in the first ``limit`` steps of each anomaly.

    Steps are made distinct first (combined before the shuffle), then the rank
    filter lets every task keep at most ``limit`` steps of an anomaly before
    anything moves. The step at which an anomaly stops is joined back with heavy
    anomalies spread out.
    """
    w = Window.partitionBy("anomaly_id").orderBy("step")
    last = (
        calls.select("anomaly_id", "step").distinct()
        .withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= limit)
        .groupBy("anomaly_id").agg(F.max("step").alias("_last_step"))
    )
    return attach_by_key(calls, "anomaly_id", last, ["_last_step"], spread="call_id").filter(
        F.col("step") <= F.col("_last_step")
    ).drop("_last_step")


def estimate_tokens(turns: DataFrame) -> DataFrame:
    """Per conversation: characters divided by four, rounded down."""
    return turns.groupBy("conv_id").agg(
        F.floor(F.coalesce(F.sum(F.length("text")), F.lit(0)) / CHARS_PER_TOKEN).alias("estimated_tokens")
    )


def trim_context(turns: DataFrame, limit: int = TOKEN_LIMIT, last: int = 4) -> DataFrame:
    """Shorten conversations whose estimate exceeds ``limit``.

    They keep the first turn, a marker turn and the last ``last`` turns (all after
    the first when there are at most ``last + 1``). A marker carries the number of
    the first turn and ``is_marker``, so ``turn, is_marker`` is the reading order.
    """
    sizes = turns.groupBy("conv_id").agg(
        F.floor(F.coalesce(F.sum(F.length("text")), F.lit(0)) / CHARS_PER_TOKEN).alias("_tokens"),
        F.count("*").alias("n"), F.min("turn").alias("_first"),
    )
    over = sizes.filter(F.col("_tokens") > limit)
    newest = Window.partitionBy("conv_id").orderBy(F.desc("turn"))
    tail = (
        turns.select("conv_id", "turn").withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= last)
        .groupBy("conv_id").agg(F.min("turn").alias("_tail"))
    )
    cut = over.join(tail, "conv_id").select(
        "conv_id", "_first", F.when(F.col("n") > last + 1, F.col("_tail")).otherwise(F.col("_first")).alias("_from")
    )
    kept = attach_by_key(
        turns.withColumn("is_marker", F.lit(False)), "conv_id", cut, ["_first", "_from"],
        weights=sizes.select("conv_id", "n"), spread="turn",
    ).filter(
        F.col("_from").isNull() | (F.col("turn") == F.col("_first")) | (F.col("turn") >= F.col("_from"))
    ).drop("_first", "_from")
    markers = over.select(
        "conv_id", F.col("_first").alias("turn"), F.lit("user").alias("role"),
        F.lit(TRIM_MARKER).alias("text"), F.lit(True).alias("is_marker"),
    )
    return kept.unionByName(markers)


def journal(calls: DataFrame, steps: DataFrame | None = None) -> DataFrame:
    """One row per step: the first tool called, its id, the stop reason.

    ``steps`` (anomaly_id, step, stop_reason) adds the steps without a call, whose tool is null.
    """
    key = ["anomaly_id", "step"]
    if steps is None:
        both = calls.select(*key, "pos", "tool", "call_id", "stop_reason", F.lit(None).cast("string").alias("_own"))
    else:
        # one aggregate over both tables, so that neither is joined; nothing is null but the columns of the other
        both = calls.select(*key, "pos", "tool", "call_id", "stop_reason").unionByName(
            steps.select(*key, F.col("stop_reason").alias("_own")), allowMissingColumns=True)
    return both.groupBy(*key).agg(
        F.min_by("tool", "pos").alias("tool_called"), F.min_by("call_id", "pos").alias("tool_use_id"),
        F.coalesce(F.max("_own"), F.min_by("stop_reason", "pos")).alias("stop_reason"))


def action_summary(calls: DataFrame, anomalies: DataFrame, truncations: DataFrame | None = None) -> DataFrame:
    """``(section, name, value)``; unknown tools count as actions but have no row.

    ``anomalies`` has one row per processed anomaly, ``truncations`` one per trim.
    """
    wait = needs_approval()
    counted = tally(calls, {
        ("totals", "total_tool_calls"): F.count("*"),
        ("totals", "actions_taken"): F.count_if(~wait),
        ("totals", "pending_approval"): F.count_if(wait),
        **{("tool_distribution", t): F.count_if((F.col("tool") == t) & ~wait) for t in TOOL_ARGUMENTS},
    })
    processed = tally(anomalies, {("totals", "anomalies_processed"): F.count("*")})
    per = calls.agg(F.count("*").alias("c")).crossJoin(anomalies.agg(F.count("*").alias("a"))).select(
        F.lit("totals").alias("section"), F.lit("avg_tool_calls_per_anomaly").alias("name"),
        F.coalesce(F.round(F.col("c") / F.nullif(F.col("a"), F.lit(0)), 2), F.lit(0.0)).alias("value"),
    )
    out = counted.unionByName(processed).unionByName(per)
    if truncations is not None:
        out = out.unionByName(tally(truncations, {("totals", "context_truncations"): F.count("*")}))
    return out


