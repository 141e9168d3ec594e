"""Stages that write their outputs below a folder and return readers over them.

Each takes and returns DataFrames; call them in the order of your own job. A scorer
is any function from prompts (row_seq, prompt) to replies (row_seq, raw_text,
stop_reason, input_tokens, output_tokens, cache_read_tokens) - usually
``score_batch`` over a model client, or a stored table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidedesk.operators import actions, anomaly, enrich, normalize, quality, scoring
from tidedesk.operators.budget import token_cost
from tidedesk.schema import MODEL_PRICES, PRICES, REVIEW_BELOW
from tidedesk.session import materialize
from tidedesk.sources.sinks import replace_rows, report_json, write_by_channel, write_table
from tidedesk.sources.tickets import read_tickets

Scorer = Callable[[DataFrame], DataFrame]


def _previous(path: str, like: DataFrame) -> DataFrame | None:
    """The small report of the run before, held in memory: its file is replaced later."""
    spark = like.sparkSession
    try:
        rows = spark.read.schema(like.schema).json(path).collect()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None
    return spark.createDataFrame(rows, like.schema)


def ingest_stage(spark: SparkSession, source: str | list[str], path: str, **options) -> DataFrame:
    """CSV files to the raw table, with ``row_seq``."""
    return write_table(read_tickets(spark, source, **options), f"{path}/raw")


def transform_stage(raw: DataFrame, path: str, processed_at: str, strict: bool = False) -> DataFrame:
    """Normalised table, its channel-partitioned copy and the profile report."""
    out = write_table(normalize.normalize(raw, processed_at, strict), f"{path}/normalized")
    write_by_channel(out, f"{path}/partitioned")
    report_json(quality.profile(out), f"{path}/profile")
    return out


def quality_stage(df: DataFrame, path: str, as_of: dt.datetime | str) -> DataFrame:
    """Write ``validated``, ``rejected`` and ``report`` below ``path``; then gate.

    The report carries the trend against the report found there, and replaces it
    even when the gate fails. Returns the written report.
    """
    validated = write_table(quality.quality_flags(df, as_of), f"{path}/validated")
    checks = quality.quality_report(validated, as_of)
    report = quality.with_trend(checks, _previous(f"{path}/report", checks))
    write_table(quality.dead_letter(validated), f"{path}/rejected")
    written = report_json(report, f"{path}/report")
    quality.enforce(written)
    return written


def score_under_cap(tickets: DataFrame, scorer: Scorer, cap: float | None, price: tuple[float, float],
                    spent: float = 0.0, batch: int = 1) -> DataFrame:
    """Parsed replies for a written ``tickets`` table in ``row_seq`` order, slice by slice.

    Slices are sized in money: after the first, one batch, a slice has as many rows as the money left
    would pay for at the highest cost of a row so far, whole batches, one batch at least; while nothing
    has been billed it doubles. So a run costs at most ``cap`` and one batch, unless later rows cost more
    than any before, and takes few slices: each uses up a fixed share of what is left. Scoring stops when the cost reaches ``cap``; the exact cut is left to
    ``scoring.tier1_within_budget`` and ``tier2_within_budget``. All replies received are returned.
    """
    prompts = scoring.scoring_input(tickets).select("row_seq", "prompt")
    if cap is None:
        return materialize(scoring.classified_replies(scorer(prompts)), "replies")
    done = scoring.classified_replies(scorer(prompts.limit(0)))
    after, cost, size, dearest = F.lit(True), spent, batch, 0.0
    while cost < cap:
        if dearest > 0:
            size = int((cap - cost) / dearest)
        size = max(1, size // batch) * batch
        ahead = scoring.first_n(tickets.filter(after).select("row_seq"), size)
        high = ahead.agg(F.max("row_seq")).first()[0]
        if high is None:
            break
        part = prompts.filter(after & (F.col("row_seq") <= F.lit(high)))
        got = materialize(scoring.classified_replies(scorer(part)), "replies")
        done = done.unionByName(got)
        row_cost = token_cost(F.col("input_tokens"), F.col("output_tokens"), price)
        cost, dearest = _spent(got, price, cost), max(dearest, got.agg(F.max(row_cost)).first()[0] or 0.0)
        after, size = F.col("row_seq") > F.lit(high), size * 2
    return done


def _spent(replies: DataFrame, price: tuple[float, float], before: float = 0.0) -> float:
    return replies.agg(token_cost(
        F.coalesce(F.sum("input_tokens"), F.lit(0)), F.coalesce(F.sum("output_tokens"), F.lit(0)), price, before,
    )).first()[0]


def classify_stage(tickets: DataFrame, tier1: Scorer, tier2: Scorer, path: str,
                   sample: int | None = None, cap: float | None = None) -> DataFrame:
    """Classified table and report. Only rows under review reach the second scorer.

    The report has what was billed (every valid reply received) beside the cost of the replies kept
    (``kept_*``); the second tier starts from what the first was billed.
    """
    if sample is not None:
        tickets = materialize(scoring.first_n(tickets, sample), "sample")
    all1 = materialize(score_under_cap(tickets, tier1, cap, PRICES[1], batch=scoring.TIER1_BATCH), "tier1-replies")
    t1 = materialize(scoring.tier1_within_budget(tickets, all1, cap), "tier1")
    review = t1.filter(F.col("ok") & (F.col("confidence") < REVIEW_BELOW)).select("row_seq")
    spent = _spent(all1, PRICES[1])
    all2 = materialize(score_under_cap(materialize(tickets.join(review, "row_seq", "left_semi"), "review"), tier2, cap,
                                       PRICES[2], spent), "tier2-replies")
    t2 = materialize(scoring.tier2_within_budget(t1, all2, cap, spent), "tier2")
    out = write_table(scoring.merge_tiers(tickets, t1, t2), f"{path}/classified")
    report = scoring.classification_report(out, t1).unionByName(scoring.confidence_buckets(out))
    for prefix, first, second in (("", all1, all2), ("kept_", t1, t2)):
        usage = first.withColumn("tier", F.lit(1)).unionByName(second.withColumn("tier", F.lit(2)))
        costs = materialize(scoring.usage_cost(usage), "costs")
        report = report.unionByName(costs.select(
            F.lit("cost").alias("section"), F.concat(F.lit(f"{prefix}tier"), F.col("tier").cast("string")).alias("name"),
            F.col("cost_usd").alias("value")))
        report = report.unionByName(scoring.total_cost(costs).select(
            F.lit("cost").alias("section"), F.lit(f"{prefix}total").alias("name"), F.col("total_cost_usd").alias("value")))
    report = report.unionByName(scoring.cache_hit_rate(all1).select(
        F.lit("cost").alias("section"), F.lit("cache_hit_rate").alias("name"), F.col("cache_hit_rate").alias("value")))
    report_json(report, f"{path}/classification_report")
    return out


def enrich_stage(tickets: DataFrame, full: Scorer, simple: Scorer, path: str,
                 previous: DataFrame | None = None) -> DataFrame:
    """Enriched table and report. The simple scorer sees only what the full one failed.

    With ``previous`` (an earlier output, at another path) only its failed rows are
    scored again.
    """
    todo = tickets if previous is None else previous.filter("enrichment_failed")
    prompts = scoring.scoring_input(todo).select("row_seq", "prompt")
    first = materialize(full(prompts), "full-replies")
    unusable = enrich.unusable_replies(first)
    second = materialize(simple(prompts.join(unusable, "row_seq", "left_semi")), "simple-replies")
    results = materialize(enrich.enrichment_results(first, second), "enrichment-results")
    if previous is None:
        out = write_table(enrich.merge_enrichment(tickets, results, contacts=True), f"{path}/enriched")
    else:
        out = write_table(enrich.resume(previous, results), f"{path}/enriched")
    report_json(enrich.enrichment_report(out, results), f"{path}/enrichment_report")
    report_json(enrich.usage_by_model(results), f"{path}/usage")
    report_json(scoring.usage_cost(results.filter(F.col("model").isNotNull()), MODEL_PRICES, "model"), f"{path}/cost")
    return out


def detect_stage(tickets: DataFrame, scorer: Scorer, path: str, by: str = "ticket_id") -> DataFrame:
    """Anomaly table, summary with trend, sensitivity and alerts."""
    chosen = anomaly.chosen_candidates(tickets, by)
    replies = materialize(scorer(anomaly.anomaly_input(chosen, tickets).select("row_seq", "prompt")), "verdicts")
    out = write_table(anomaly.anomalies_of(chosen, replies), f"{path}/anomalies")
    report_json(anomaly.threshold_sensitivity(tickets), f"{path}/threshold_analysis")
    replace_rows(anomaly.alerts(out), f"{path}/high_severity_alerts")
    summary = anomaly.anomaly_summary(out)
    before = _previous(f"{path}/anomaly_report", summary)
    trend = None if before is None else anomaly.summary_trend(summary, before)
    totals = anomaly.detection_totals(tickets, out).withColumn("value", F.col("value").cast("long"))
    report_json(summary.unionByName(totals), f"{path}/anomaly_report")
    if trend is not None:
        report_json(trend, f"{path}/anomaly_trend")
    return out


def action_stage(calls: DataFrame, anomalies: DataFrame, path: str, steps: DataFrame | None = None,
                 turns: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Action, pending and journal logs of this run (earlier ones are replaced) and the summary.

    ``steps`` has a row per step with its stop reason, also for steps without a call: a run ends at the
    first that did not stop for tools, and all are in the journal. ``turns`` are the conversations:
    their trimmed form is written, and the summary counts the trims.
    """
    kept = materialize(actions.check_calls(actions.cap_steps(calls)), "calls")
    ran = materialize(actions.executed(kept, steps), "executed")
    done, waiting = actions.gate(ran)
    replace_rows(done, f"{path}/actions")
    replace_rows(waiting, f"{path}/pending_approval")
    replace_rows(actions.journal(kept, steps), f"{path}/reasoning")
    truncations = None
    if turns is not None:
        trimmed = write_table(actions.trim_context(turns), f"{path}/contexts")
        truncations = trimmed.filter("is_marker")
    report_json(actions.action_summary(ran, anomalies, truncations), f"{path}/agent_summary")
    return done, waiting
