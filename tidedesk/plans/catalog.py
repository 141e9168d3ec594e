"""One query per operator over the provided tables, each over whole tables.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``plans/oracle.py`` holds the
SQL twin of the same name.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidedesk.functions import replies
from tidedesk.functions.clean import is_uuid4, norm_enum, norm_priority, parse_ts
from tidedesk.functions.text import blank_to_null, strip, strip_fences, strip_html
from tidedesk.operators import actions as act, deltas, difference, intervals, ordered, replay, sketches, totals
from tidedesk.operators import anomaly as ano
from tidedesk.operators import enrich as enr
from tidedesk.operators import normalize as nrm
from tidedesk.operators import quality as qua
from tidedesk.operators import runs
from tidedesk.operators import scoring as sco
from tidedesk.operators.budget import budget_cut
from tidedesk.plans import views
from tidedesk.schema import CATEGORIES, CHANNELS, MODEL_PRICES, PRICES, PRIORITIES, STATUSES, TICKET_COLUMNS
from tidedesk.session import materialize, scratch_dir
from tidedesk.sources import ranges
from tidedesk.sources.sinks import append_rows, read_rows, replace_rows, report_json, write_by_channel, write_table
from tidedesk.sources.tickets import NoInputError, null_tokens, read_tickets
from tidedesk.streaming import lifecycles

AS_OF = "2024-02-01 00:00:00"
PROCESSED_AT = "2024-02-01T00:00:00Z"
TIER1_CAP = 0.05
TIER2_CAP = 0.08

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    """Register a function under its name; the session is put in UTC first."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


# Inputs ---------------------------------------------------------------------

def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def raw_tickets(spark: SparkSession, d: str) -> DataFrame:
    for name in ("documents", "orders", "events", "labels"):
        table(spark, d, name).createOrReplaceTempView(name)
    return spark.sql(views.TICKETS)


def tickets(spark: SparkSession, d: str) -> DataFrame:
    return nrm.normalize(raw_tickets(spark, d), PROCESSED_AT)


def stored_replies(spark: SparkSession, d: str, sql: str) -> DataFrame:
    """Model replies as a written table, the way a scoring job leaves them."""
    raw_tickets(spark, d).createOrReplaceTempView("tickets")
    return materialize(spark.sql(sql), "replies")


def tier(spark: SparkSession, d: str, n: int) -> DataFrame:
    parsed = sco.classified_replies(stored_replies(spark, d, views.RESPONSES).filter(F.col("tier") == n))
    return materialize(parsed.drop("tier"), f"tier{n}")


def usage(spark: SparkSession, d: str) -> DataFrame:
    return sco.classified_replies(stored_replies(spark, d, views.RESPONSES))


def merged(spark: SparkSession, d: str) -> DataFrame:
    base = tickets(spark, d).drop("llm_category")
    return sco.merge_tiers(base, tier(spark, d, 1), tier(spark, d, 2))


def enrich_results(spark: SparkSession, d: str) -> DataFrame:
    e = stored_replies(spark, d, views.ENRICHMENTS)
    full = e.withColumnsRenamed({"full_text": "raw_text", "full_stop": "stop_reason"})
    simple = e.withColumnRenamed("simple_text", "raw_text").withColumn("stop_reason", F.lit("end_turn"))
    return materialize(enr.enrichment_results(full, simple), "enrichment-results")


def enriched(spark: SparkSession, d: str) -> DataFrame:
    return with_contacts(spark, d)[0]


def with_contacts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    results = enrich_results(spark, d)
    return enr.merge_enrichment(tickets(spark, d).drop("sentiment"), results, contacts=True), results


def flat(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        "row_seq", "sentiment", "sentiment_confidence", enr.entities_json(F.col("entities")).alias("entities_json"),
        "summary", "urgency_score", "urgency_reason", "enrichment_failed", *more,
    )


def contacted(spark: SparkSession, d: str) -> DataFrame:
    return enr.repeat_contact(tickets(spark, d))


def stored(spark: SparkSession, d: str) -> DataFrame:
    """Normalised tickets as a written table, the way a run keeps them between stages."""
    return materialize(tickets(spark, d), "tickets")


def verdicts(spark: SparkSession, d: str) -> DataFrame:
    return stored_replies(spark, d, views.VERDICTS)


def found(spark: SparkSession, d: str) -> DataFrame:
    return materialize(ano.anomalies(tickets(spark, d), verdicts(spark, d), contacts=True), "anomalies")


def chosen(spark: SparkSession, d: str) -> DataFrame:
    return ano.chosen_candidates(tickets(spark, d), contacts=True)


CALL_INPUT = """
CASE tool
 WHEN 'escalate_ticket' THEN CASE WHEN call_id % 5 = 0 THEN map('ticket_id', ticket_id, 'severity', severity)
                             ELSE map('ticket_id', ticket_id, 'severity', severity, 'reason', 'r') END
 WHEN 'send_alert' THEN map('message', 'm', 'channel', CASE severity WHEN 'high' THEN 'slack' WHEN 'medium' THEN 'pagerduty' ELSE 'fax' END)
 WHEN 'create_task' THEN map('title', 't')
 WHEN 'get_ticket_history' THEN CASE WHEN call_id % 7 = 0 THEN NULL ELSE map('customer_id', 'c') END
 WHEN 'update_ticket_status' THEN map('ticket_id', ticket_id, 'new_status', new_status, 'reason', 'r')
 ELSE map('x', 'y') END
"""


def calls(spark: SparkSession, d: str) -> DataFrame:
    table(spark, d, "events").createOrReplaceTempView("events")
    return spark.sql(views.TOOL_CALLS).withColumn("input", F.expr(CALL_INPUT))


def ran(spark: SparkSession, d: str) -> DataFrame:
    """Executed calls: those before the end of their anomaly's run."""
    return act.executed(calls(spark, d), steps(spark, d))


def steps(spark: SparkSession, d: str) -> DataFrame:
    table(spark, d, "events").createOrReplaceTempView("events")
    calls(spark, d).createOrReplaceTempView("calls")
    return spark.sql(views.STEPS)


def micros(column: str = "created_at"):
    return F.unix_micros(column).alias(f"{column}_us")


CSV = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False,
       "ignoreTrailingWhiteSpace": False}


# A: sources and sinks -------------------------------------------------------

@query
def a1_csv_by_header(spark, d):
    raw = raw_tickets(spark, d).withColumnRenamed("row_seq", "src_seq")
    path = scratch_dir(spark, "csv")
    raw.filter("status = 'open'").select("src_seq", *TICKET_COLUMNS).write.options(**CSV).csv(f"{path}/one")
    raw.filter("status <> 'open'").select(
        *[c for c in reversed(TICKET_COLUMNS) if c != "category"], "src_seq"
    ).write.options(**CSV).csv(f"{path}/two")
    return read_tickets(spark, path).select(F.col("src_seq").cast("long").alias("src_seq"), *TICKET_COLUMNS)


@query
def a2_csv_suffix(spark, d):
    raw = raw_tickets(spark, d).select("row_seq", "channel").withColumnRenamed("row_seq", "src_seq")
    path = scratch_dir(spark, "csv")
    raw.write.options(**CSV).csv(f"{path}/deep/er")
    raw.select(F.concat_ws(",", "src_seq", "channel")).write.text(f"{path}/other")
    back = read_tickets(spark, path, columns=["src_seq", "channel"], multi_line=False)
    return back.groupBy("channel").agg(
        F.count("*").alias("n"), (F.count("*") - F.count_distinct("row_seq")).alias("repeated_row_seq")
    )


@query
def a3_null_tokens(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.expr(
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'N/A' WHEN '2-HIGH' THEN '' WHEN '3-MEDIUM' THEN 'null'"
        " WHEN '5-LOW' THEN '<NA>' ELSE o_orderpriority END").alias("priority"))
    return null_tokens(o)


@query
def a4_no_input(spark, d):
    # files per suffix; a suffix without files is an error
    path = scratch_dir(spark, "csv")
    table(spark, d, "orders").select(F.concat_ws(",", "o_orderkey", "o_orderstatus")).write.partitionBy().csv(f"{path}/in")
    rows = []
    for pattern in ("*.csv", "*.tsv"):
        try:
            rows.append((pattern, read_tickets(spark, path, pattern=pattern, columns=["a"], multi_line=False).count() >= 0))
        except NoInputError:
            rows.append((pattern, False))
    return spark.createDataFrame(rows, "pattern string, has_input boolean")


@query
def a5_a6_parquet(spark, d):
    back = write_table(tickets(spark, d), scratch_dir(spark, "normalized"))
    return back.select("row_seq", "channel", "status", micros())


@query
def a7_channel_partitions(spark, d):
    path = scratch_dir(spark, "by-channel")
    parts = write_by_channel(tickets(spark, d), path)
    return spark.read.parquet(path).groupBy("channel").agg(F.count("*").alias("n")).withColumn(
        "partitions", F.lit(parts).cast("long"))


@query
def a8_report_json(spark, d):
    return report_json(qua.quality_report(tickets(spark, d), AS_OF), scratch_dir(spark, "report"))


@query
def a9_json_lines(spark, d):
    path = scratch_dir(spark, "actions")
    acted, waiting = act.gate(calls(spark, d))
    keep = ["call_id", "tool", "input"]
    append_rows(waiting.select(*keep), path)
    replace_rows(acted.select(*keep), path)
    append_rows(waiting.select(*keep), path)
    back = read_rows(spark, path, "call_id long, tool string, input map<string,string>")
    return back.groupBy("tool").agg(
        F.count("*").alias("n"), F.sum(F.size("input")).alias("arguments"), F.max("call_id").alias("last_call"))


@query
def a10_dead_letter(spark, d):
    return qua.dead_letter(qua.quality_flags(tickets(spark, d), AS_OF)).select("row_seq", "quality_flags")


# B: normalisation -----------------------------------------------------------

@query
def b_normalize(spark, d):
    return tickets(spark, d).select(
        "row_seq", "ticket_id", micros(), "customer_id", "channel", "subject", "body", "priority", "category",
        "status", "agent_id", "parse_error", "priority_normalized", "html_stripped", "invalid_ticket_id",
        "_schema_version", "_processed_at",
    )


@query
def b2_parse_ts(spark, d):
    # The event time written in five layouts.
    ts = F.col("ts")
    text = (
        F.when(F.col("event_type") == "view", F.date_format(ts, "MM/dd/yyyy"))
        .when(F.col("event_type") == "click", F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
        .when(F.col("event_type") == "error", F.date_format(ts, "yyyy/MM/dd HH:mm:ss"))
        .when(F.col("event_type") == "signup", F.date_format(ts, "HH:mm"))
        .otherwise(F.date_format(ts, " yyyy-MM-dd HH:mm:ss "))
    )
    parsed = table(spark, d, "events").select("event_id", parse_ts(text).alias("at"))
    return parsed.select("event_id", F.unix_micros("at").alias("at_us"), F.col("at").isNull().alias("parse_error"))


#: Layouts of one time, and how much of it each keeps.
LAYOUTS = [
    ("MM/dd/yyyy hh:mm a", "minute"), ("MMM d, yyyy", "day"), ("MMMM d yyyy", "day"), ("dd-MMM-yyyy", "day"), ("MM-dd-yyyy", "day"),
    ("yyyy.MM.dd", "day"), ("M/d/yy", "day"), ("yyyy/M/d", "day"), ("EEE, dd MMM yyyy HH:mm:ss 'GMT'", "second"),
    ("yyyyMMdd'T'HHmmss'Z'", "second"), ("yyyyMMddHHmmss", "second"), ("yyyy-MM-dd hh:mm a", "minute"), ("yyyy/MM/dd'T'HH:mm:ss'Z'", "second"),
    ("yyyyMMdd", "day"), ("d MMMM yyyy H:mm", "minute"), ("MMM d yyyy h:mm:ss a", "second"), ("MM.dd.yyyy HH:mm", "minute"),
    ("yyyy-MM-dd'T'HH:mm:ss", "second"), ("M/d/yyyy H:mm:ss", "second"), ("EEEE, MMMM d, yyyy", "day"), ("d MMM yyyy hh:mm a", "minute"),
    ("yyyy-M-d H:mm", "minute"), ("MMM yyyy", "month"), ("dd MMM yyyy HH:mm:ss '+0000'", "second"),
]


@query
def b2_layouts(spark, d):
    n = F.col("event_id") % len(LAYOUTS)
    text = F.coalesce(*[F.when(n == i, F.date_format("ts", p)) for i, (p, _) in enumerate(LAYOUTS)])
    return table(spark, d, "events").select("event_id", F.unix_micros(parse_ts(text)).alias("at_us"))


@query
def b1_missing_columns(spark, d):
    rows = []
    for name in ("orders", "documents", "events"):
        missing = nrm.missing_columns(table(spark, d, name).withColumnRenamed("text", "body"))
        rows += [(name, c, table(spark, d, name).count()) for c in missing]
    return spark.createDataFrame(rows, "table_name string, missing_column string, table_rows long")


@query
def b3_enums(spark, d):
    return raw_tickets(spark, d).select(
        "row_seq", norm_enum(F.col("channel"), CHANNELS).alias("channel"),
        norm_enum(F.col("status"), STATUSES).alias("status"),
        norm_enum(F.col("category"), CATEGORIES).alias("category"))


@query
def b4_priority(spark, d):
    p = norm_priority(F.col("priority"), PRIORITIES)
    return raw_tickets(spark, d).select("row_seq", p.alias("priority"), p.isNotNull().alias("priority_normalized"))


@query
def b5_strict_violations(spark, d):
    return nrm.enum_violations(raw_tickets(spark, d))


@query
def b6_b7_strip(spark, d):
    return raw_tickets(spark, d).select(
        "row_seq", blank_to_null(F.col("subject")).alias("subject"), strip(F.col("customer_id")).alias("customer_id"))


@query
def b8_strip_html(spark, d):
    plain = strip_html(F.col("html"))
    return table(spark, d, "pages").select("page_id", plain.alias("plain"), (plain != F.col("html")).alias("changed"))


@query
def b9_uuid4(spark, d):
    return raw_tickets(spark, d).select("row_seq", (~is_uuid4(F.col("ticket_id"))).alias("invalid_ticket_id"))


@query
def b10_meta(spark, d):
    return nrm.with_meta(table(spark, d, "orders").select("o_orderkey"), PROCESSED_AT)


@query
def b11_row_count(spark, d):
    before = raw_tickets(spark, d).agg(F.count("*").alias("rows_in"))
    once = tickets(spark, d)
    twice = nrm.normalize(once.withColumn("created_at", F.col("created_at").cast("string")), PROCESSED_AT)
    after = twice.agg(
        F.count("*").alias("rows_out"), F.count_if("parse_error").alias("parse_errors"),
        F.count_if(F.col("body").isNull()).alias("null_bodies"))
    return before.crossJoin(after)


# C: quality gate ------------------------------------------------------------

@query
def c1_c8_flag_counts(spark, d):
    flagged = qua.quality_flags(tickets(spark, d), AS_OF)
    return flagged.select(F.explode(F.split("quality_flags", r"\|")).alias("flag")).filter("flag <> ''").groupBy(
        "flag").agg(F.count("*").alias("n"))


@query
def c3_c4_raw_enums(spark, d):
    # On text that was never normalised the enum checks do catch values.
    flagged = qua.quality_flags(raw_tickets(spark, d).withColumn("created_at", parse_ts(F.col("created_at"))), AS_OF)
    return flagged.select("row_seq", "quality_flags")


@query
def c9_quality_flags(spark, d):
    return qua.quality_flags(tickets(spark, d), AS_OF).select("row_seq", "quality_flags")


@query
def c9_flags_lineitem(spark, d):
    return qua.quality_flags(lineitem_tickets(spark, d), "2001-12-31 00:00:00").select(
        "l_orderkey", "l_linenumber", "quality_flags")


def lineitem_tickets(spark: SparkSession, d: str) -> DataFrame:
    """Ticket-shaped rows from line items: the size of the published flag claim."""
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_quantity") >= 5, F.col("l_returnflag")).alias("subject"),
        F.when(F.col("l_discount") < 0.09, F.lit("high")).alias("priority"),
        F.expr("CASE l_returnflag WHEN 'A' THEN 'email' WHEN 'N' THEN 'chat' ELSE 'fax' END").alias("channel"),
        F.expr("CASE l_linestatus WHEN 'F' THEN 'closed' ELSE 'open' END").alias("status"),
        F.col("l_shipdate").cast("timestamp").alias("created_at"),
        F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("body"),
        F.when(F.col("l_tax") > 0.01, F.col("l_suppkey").cast("string")).alias("agent_id"),
    )


@query
def c10_rate_checks(spark, d):
    return qua.rate_checks(tickets(spark, d), AS_OF)


@query
def c11_count_checks(spark, d):
    return qua.count_checks(tickets(spark, d), AS_OF)


@query
def c12_duplicate_ids(spark, d):
    return qua.duplicate_count(tickets(spark, d), "ticket_id")


@query
def c12_duplicate_customers(spark, d):
    return qua.duplicate_count(table(spark, d, "orders"), "o_custkey")


@query
def c13_gate_verdict(spark, d):
    report = qua.quality_report(tickets(spark, d), AS_OF)
    return report.filter(F.col("check") == qua.HARD_CHECK).select("check", "passed", "value", "threshold")


@query
def c14_quality_report(spark, d):
    return qua.quality_report(tickets(spark, d), AS_OF)


@query
def c15_trend(spark, d):
    before = tickets(spark, d).filter(F.col("status") != "open")
    previous = qua.quality_report(before, AS_OF).filter(F.col("check") != "short_body")
    return qua.with_trend(qua.quality_report(tickets(spark, d), AS_OF), previous)


@query
def c16_contract(spark, d):
    raw = raw_tickets(spark, d).withColumn("status", F.when(F.col("status") != "pending", F.col("status")))
    return qua.contract_violations(raw).select("row_seq", F.concat_ws("|", "violations").alias("violations"))


@query
def c17_profile(spark, d):
    return qua.profile(tickets(spark, d)).withColumn("value", F.col("value").cast("long"))


# D: replies, tiers, budget --------------------------------------------------

@query
def d1_scoring_input(spark, d):
    return sco.scoring_input(tickets(spark, d)).select("row_seq", "prompt")


@query
def d2_score_batch(spark, d):
    # A stand-in for a model client: decides by a word in the prompt.
    def make_scorer():
        def score(batch: pd.DataFrame) -> pd.DataFrame:
            hit = batch["prompt"].str.lower().str.contains("the", regex=False)
            return pd.DataFrame({
                "row_seq": batch["row_seq"],
                "category": hit.map({True: "technical", False: "general"}),
                "prompt_chars": batch["prompt"].str.len().astype("int64"),
            })

        return score

    prompts = sco.scoring_input(tickets(spark, d)).select("row_seq", "prompt")
    return sco.score_batch(prompts, make_scorer, "row_seq long, category string, prompt_chars long")


@query
def d3_strip_fences(spark, d):
    return stored_replies(spark, d, views.RESPONSES).select(
        "row_seq", F.col("tier").cast("long").alias("tier"), strip_fences(F.col("raw_text")).alias("json_text"))


@query
def d4_parse_classification(spark, d):
    r = replies.parse_replies(stored_replies(spark, d, views.RESPONSES).withColumn("stop_reason", F.lit("end_turn")),
                              replies.CLASSIFICATION)
    return r.select("row_seq", F.col("tier").cast("long").alias("tier"), "reply.category", "reply.priority",
                    "reply.confidence", F.col("reply").isNotNull().alias("ok"))


@query
def d4_repeated_keys(spark, d):
    # every reply names each of its keys a second time, at first with values that are of no use
    stale = F.lit('{"category": "stale", "priority": null, "confidence": [1], ')
    text = F.when(F.col("raw_text").startswith("{"), F.concat(stale, F.expr("substring(raw_text, 2)"))).otherwise(F.col("raw_text"))
    r = replies.parse_replies(stored_replies(spark, d, views.RESPONSES).withColumns({"raw_text": text, "stop_reason": F.lit("end_turn")}),
                              replies.CLASSIFICATION)
    return r.select("row_seq", F.col("tier").cast("long").alias("tier"), "reply.category", "reply.priority",
                    "reply.confidence", F.col("reply").isNotNull().alias("ok"))


@query
def d5_refusals(spark, d):
    return stored_replies(spark, d, views.RESPONSES).filter(~replies.reply_ok(F.col("raw_text"), F.col("stop_reason"))).select(
        "row_seq", F.col("tier").cast("long").alias("tier"))


@query
def d7_merge_tiers(spark, d):
    return merged(spark, d).select(
        "row_seq", "llm_category", "llm_priority", "llm_confidence", "needs_review", "escalated")


@query
def d9_first_n_large(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("row_seq"), "o_custkey")
    return sco.first_n(o, 10_007)


@query
def d12_enrichment_cost(spark, d):
    results = enrich_results(spark, d).filter(F.col("model").isNotNull())
    return sco.usage_cost(results, MODEL_PRICES, "model")


@query
def d15_enrichment_cache(spark, d):
    return sco.cache_hit_rate(enrich_results(spark, d).filter("model = 'small'"))


@query
def d9_first_n(spark, d):
    return sco.first_n(raw_tickets(spark, d), 25).select("row_seq", "ticket_id")


@query
def d10_tier1_budget(spark, d):
    return sco.tier1_within_budget(raw_tickets(spark, d), tier(spark, d, 1), TIER1_CAP).select(
        "row_seq", F.coalesce("ok", F.lit(False)).alias("ok"))


@query
def d10_orders_budget(spark, d):
    # A cap that stops far into the table, and an order column with gaps.
    o = table(spark, d, "orders").select(
        (F.col("o_orderkey") * 70001).alias("row_seq"), (F.col("o_custkey") % 100).alias("input_tokens"),
        (F.col("o_custkey") % 7).alias("output_tokens"))
    return budget_cut(o, 0.4, price=PRICES[1], batch=10).select("row_seq")


@query
def d11_tier2_budget(spark, d):
    t1 = sco.tier1_within_budget(raw_tickets(spark, d), tier(spark, d, 1), TIER1_CAP)
    return sco.tier2_within_budget(t1, tier(spark, d, 2), TIER2_CAP).select("row_seq")


@query
def d12_usage_cost(spark, d):
    per_tier = sco.usage_cost(usage(spark, d))
    return per_tier.select(F.col("tier").cast("long").alias("tier"), "input_tokens", "output_tokens", "cost_usd")


@query
def d12_total_cost(spark, d):
    return sco.total_cost(sco.usage_cost(usage(spark, d)))


@query
def d13_classification_report(spark, d):
    return sco.classification_report(merged(spark, d), tier(spark, d, 1))


@query
def d14_confidence_buckets(spark, d):
    return sco.confidence_buckets(merged(spark, d))


@query
def d15_cache_hit_rate(spark, d):
    return sco.cache_hit_rate(tier(spark, d, 1))


# E: enrichment --------------------------------------------------------------

@query
def e1_parse_enrichment(spark, d):
    e = replies.parse_replies(stored_replies(spark, d, views.ENRICHMENTS), replies.ENRICHMENT, raw="full_text", stop="full_stop")
    return e.select("row_seq", "answered", "reply.sentiment", "reply.sentiment_confidence", "reply.summary",
                    "reply.urgency_score", F.size("reply.entities.error_codes").cast("long").alias("error_codes"),
                    F.col("reply").isNotNull().alias("ok"))


@query
def e2_e3_merge_fallback(spark, d):
    return flat(enriched(spark, d))


@query
def e4_entity_counts(spark, d):
    return enr.entity_counts(enriched(spark, d))


@query
def e5_resume(spark, d):
    again = stored_replies(spark, d, views.ENRICHMENTS).select(
        "row_seq",
        F.when(F.col("row_seq") % 3 == 0, F.lit("broken")).otherwise(F.concat(
            F.lit('{"sentiment": "positive", "sentiment_confidence": 1, "entities": {}, "summary": "Again ",'
                  ' "urgency_score": 0.25, "urgency_reason": "second run '), F.col("row_seq").cast("string"), F.lit('"}')
        )).alias("raw_text"),
        F.lit("end_turn").alias("stop_reason"), "input_tokens", "output_tokens", "cache_read_tokens")
    results = enr.enrichment_results(again, again.withColumn("raw_text", F.lit("broken")))
    previous = materialize(enriched(spark, d), "enriched")
    return flat(enr.resume(previous, results), "repeat_contact")


@query
def e6_repeat_contact(spark, d):
    return enr.repeat_contact(tickets(spark, d).select("row_seq", "customer_id"))


@query
def e6_repeat_orders(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("row_seq"), "o_custkey")
    return enr.repeat_contact(o, k=10, key="o_custkey")


@query
def e7_enrichment_report(spark, d):
    e, results = with_contacts(spark, d)
    return enr.enrichment_report(e, results)


@query
def e8_usage_by_model(spark, d):
    return enr.usage_by_model(enrich_results(spark, d))


# F: anomalies ---------------------------------------------------------------

@query
def f1_length_spike(spark, d):
    return ano.length_spike(tickets(spark, d)).select("row_seq", "body_length_spike")


@query
def f1_documents_spike(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return ano.length_spike(docs, text="text", flag="spike").select("doc_id", "spike")


@query
def f2_f6_anomaly_flags(spark, d):
    return ano.anomaly_flags(tickets(spark, d), contacts=True).select("row_seq", "statistical_flags")


@query
def f5_documents_duplicates(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("row_seq"), F.col("text").alias("body"))
    return ano.duplicate_body(docs)


@query
def f7_candidates(spark, d):
    return ano.candidates(ano.anomaly_flags(tickets(spark, d), contacts=True)).select("row_seq", "ticket_id", "statistical_flags")


@query
def f7_candidates_by_row(spark, d):
    return ano.candidates(ano.anomaly_flags(tickets(spark, d), contacts=True), by="row").select(
        "row_seq", "ticket_id", "statistical_flags")


@query
def f8_first_duplicate(spark, d):
    return chosen(spark, d).select("row_seq", "statistical_flags", "has_body")


@query
def f9_statistical_only(spark, d):
    return ano.statistical_only(chosen(spark, d))


@query
def f10_anomaly_input(spark, d):
    return ano.anomaly_input(chosen(spark, d), tickets(spark, d)).select("row_seq", "prompt")


@query
def f11_merge_verdict(spark, d):
    return ano.merge_verdict(chosen(spark, d), verdicts(spark, d))


@query
def f12_anomalies(spark, d):
    return found(spark, d)


@query
def f13_threshold_sensitivity(spark, d):
    return ano.threshold_sensitivity(tickets(spark, d))


@query
def f13_documents_sensitivity(spark, d):
    return ano.threshold_sensitivity(table(spark, d, "documents"), text="text")


@query
def f14_anomaly_summary(spark, d):
    anomalies = found(spark, d)
    totals = ano.detection_totals(tickets(spark, d), anomalies)
    return ano.anomaly_summary(anomalies).unionByName(totals.withColumn("value", F.col("value").cast("long")))


@query
def f15_alerts(spark, d):
    return ano.alerts(found(spark, d))


@query
def f16_anomaly_trend(spark, d):
    now = found(spark, d)
    return ano.anomaly_trend(now, now.filter(F.col("severity") != "low"))


# G: action gating -----------------------------------------------------------

@query
def g1_check_calls(spark, d):
    return act.check_calls(calls(spark, d)).select("call_id", "tool", "call_error")


@query
def g2_pending(spark, d):
    return act.gate(ran(spark, d))[1].select("call_id", "ticket_id", "tool", "anomaly_type")


@query
def g2_actions(spark, d):
    return act.gate(ran(spark, d))[0].select("call_id", "tool")


@query
def g3_customer_history(spark, d):
    return act.customer_history(tickets(spark, d), AS_OF).withColumn(
        "days_since_contact", F.col("days_since_contact").cast("long"))


@query
def g4_apply_status(spark, d):
    return act.apply_status(tickets(spark, d), act.gate(ran(spark, d))[0]).select("row_seq", "ticket_id", "status")


@query
def g4_status_at(spark, d):
    events = table(spark, d, "events").select(
        "event_id", "event_type", F.col("ts").cast("timestamp").alias("at"),
        F.expr("concat('00000000-0000-4000-8000-', lpad(CAST(CASE WHEN event_id % 3 = 0 THEN 6 ELSE event_id % 500 END AS VARCHAR(20)), 12, '0'))").alias("ticket_id"),
        F.expr("CASE event_id % 4 WHEN 0 THEN 'open' WHEN 1 THEN 'pending' WHEN 2 THEN 'closed' ELSE 'reopened' END").alias("new_status"))
    updates = events.filter("event_type = 'purchase'").withColumnRenamed("event_id", "call_id")
    moments = events.filter("event_type = 'error'").select(F.col("event_id").alias("moment_id"), "ticket_id", "at")
    return act.status_at(moments, updates, tickets(spark, d)).select("moment_id", "ticket_id", "status")


@query
def g5_cap_steps(spark, d):
    return act.cap_steps(calls(spark, d)).select("call_id", "anomaly_id", "step")


@query
def g6_estimate_tokens(spark, d):
    return act.estimate_tokens(table(spark, d, "conversations"))


@query
def g7_trim_context(spark, d):
    return act.trim_context(table(spark, d, "conversations"), limit=300)


@query
def g8_action_summary(spark, d):
    trims = act.trim_context(table(spark, d, "conversations"), limit=300).filter("is_marker")
    return act.action_summary(ran(spark, d), calls(spark, d).select("anomaly_id").distinct(), trims)


@query
def g9_journal(spark, d):
    return act.journal(calls(spark, d), steps(spark, d))


# H: run reporting -----------------------------------------------------------

@query
def h1_run_metrics(spark, d):
    t = stored(spark, d)
    return runs.run_metrics(
        spark, run_id="r1", timestamp=PROCESSED_AT, duration_ms=1200, ingested=raw_tickets(spark, d), validated=t,
        checks=qua.quality_report(t, AS_OF), anomalies=ano.anomalies(t, verdicts(spark, d), contacts=True), actions=act.gate(ran(spark, d))[0])


@query
def h2_last_runs(spark, d):
    history = table(spark, d, "orders").select(
        F.concat(F.lit("run-"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("run_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("timestamp"), F.col("o_custkey").alias("records_ingested"))
    path = scratch_dir(spark, "history")
    append_rows(history, path)
    return runs.last_runs(read_rows(spark, path, history.schema), 10)


@query
def h3_freshness(spark, d):
    expected = spark.createDataFrame(
        [("view", "failed"), ("click", "failed"), ("error", "degraded"), ("purchase", "degraded"),
         ("signup", "degraded"), ("refund", "degraded")], "name string, missing_status string")
    seen = table(spark, d, "events").select(F.col("event_type").alias("name"), F.col("ts").alias("seen_at"))
    return runs.freshness(expected, seen, "2024-01-31 00:00:00", 0.25)


# I: order, time, state and comparison ----------------------------------------

def contacts(events: DataFrame) -> DataFrame:
    """Events as contacts; a third of them are of one customer."""
    return events.select(
        F.col("event_id").alias("row_seq"), F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("user_id")).alias("customer_id"),
        F.col("ts").cast("timestamp").alias("created_at"))


@query
def i1_ticket_lifecycles(spark, d):
    # a pattern, since a stream takes a single file only by one
    stream = spark.readStream.schema(table(spark, d, "events").schema).parquet(f"{d}/events.parque[t]")
    kind = F.when(F.col("event_type") == "error", "open").when(F.col("event_type") == "purchase", "close")
    events = stream.select(F.col("user_id").alias("ticket_id"), F.col("ts").alias("at"), kind.alias("kind"), F.col("event_id").alias("seq"))
    path = scratch_dir(spark, "lifecycles")
    lifecycles.run(lifecycles.follow(events, 6 * 3600, 3600), f"{path}/rows", f"{path}/checkpoint")
    ended = spark.read.schema(lifecycles.SCHEMA).parquet(f"{path}/rows")
    return ended.select(F.col("ticket").cast("long").alias("ticket"), F.unix_micros("opened_at").alias("opened_us"),
                        F.unix_micros("ended_at").alias("ended_us"), "outcome")


@query
def i2_asof_orders(spark, d):
    # thirty days of events stand for the years of the orders, at eighty times their pace
    at = F.timestamp_micros(F.lit(788918400000000) + 80 * (F.unix_micros(F.col("ts").cast("timestamp")) - F.lit(1704067200000000)))
    events = table(spark, d, "events").select("event_id", "user_id", at.alias("at"))
    orders = table(spark, d, "orders").withColumn("ordered_at", F.col("o_orderdate").cast("timestamp"))
    return ordered.asof_join(events, orders, "user_id", "at", "ordered_at", ["o_orderkey", "o_totalprice"],
                             right_key="o_custkey", right_seq="o_orderkey", left_id="event_id").drop("at")


@query
def i3_incident_tickets(spark, d):
    events = table(spark, d, "events").withColumn("at", F.col("ts").cast("timestamp"))
    minutes = F.when(F.col("event_id") % 250 == 0, 28_800).otherwise(F.floor("value"))
    ends = F.timestamp_micros(F.unix_micros("at") + minutes * 60_000_000)
    # an incident without an end, or that ends before it begins, meets what comes with it
    incidents = events.filter(F.col("event_type") == "error").select(
        F.col("event_id").alias("incident_id"), F.col("at").alias("begins"), F.greatest("at", ends).alias("ends"))
    met = intervals.points_within(events, incidents, "at", ("begins", "ends"), "event_id")
    return met.groupBy("incident_id").agg(
        F.sum("n_points").alias("n_tickets"), F.min("least").alias("first_ticket"), F.max("most").alias("last_ticket"))


@query
def i4_contact_gaps(spark, d):
    gaps = ordered.contact_gaps(contacts(table(spark, d, "events")))
    return gaps.select("row_seq", "customer_id", "contact_no", F.round(F.col("gap_seconds") * 1_000_000).cast("long").alias("gap_us"))


@query
def i5_ticket_cube(spark, d):
    dims = ["channel", "status", "priority"]
    small = totals.cells(tickets(spark, d), dims, {"chars": F.length("body")})
    return totals.subtotals(small, dims, ["chars"])


@query
def i5_anomaly_rollup(spark, d):
    dims = ["anomaly_type", "severity"]
    summed = totals.subtotals(totals.cells(found(spark, d), dims), dims, sets="rollup")
    return totals.named_totals(summed, dims)


def two_runs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """A flagged run, and one in which rows have gone, come twice or another status."""
    first = qua.quality_flags(tickets(spark, d), AS_OF).select("row_seq", "ticket_id", "channel", "status", "priority", "quality_flags")
    status = F.when(F.col("row_seq") % 41 == 5, "closed").otherwise(F.col("status"))
    times = F.when(F.col("row_seq") % 40 == 3, 0).when(F.col("row_seq") % 43 == 7, 2).otherwise(1)
    second = first.withColumn("status", status).withColumn("k", F.explode(F.array_repeat(F.lit(1), times))).drop("k")
    return first.drop("row_seq"), second.drop("row_seq")


@query
def i6_run_difference(spark, d):
    before, after = two_runs(spark, d)
    return difference.key_differences(before, after, ["ticket_id"])


@query
def i7_sketch_thresholds(spark, d):
    t = stored(spark, d).select("row_seq", "channel", "customer_id", F.length("body").alias("chars"))
    path = scratch_dir(spark, "sketches")
    for run in (0, 1):
        part = t.filter(F.col("row_seq") % 2 == run)
        sketches.store(sketches.sketch(part, ["channel"], {"chars": F.col("chars")}, {"customers": F.col("customer_id")}), path, f"r{run}")
    merged_ = materialize(sketches.merge(sketches.stored(spark, path), ["channel"]), "merged-sketches")
    ranks = (0.5, 0.95)
    asked = merged_.select(F.col("channel").alias("c"), "n", F.col("n_chars").alias("seen"), sketches.distinct("customers").alias("customers"),
                           *[sketches.quantile("chars", q).alias(f"q{i}") for i, q in enumerate(ranks)])
    exact = t.join(F.broadcast(asked), F.col("channel") == F.col("c")).groupBy("channel").agg(
        F.first("n").alias("n"), F.first("seen").alias("seen"), F.first("customers").alias("guess"), F.count_distinct("customer_id").alias("customers"),
        *[F.count_if(F.col("chars") <= F.col(f"q{i}")).alias(f"at{i}") for i in range(2)],
        *[F.count_if(F.col("chars") < F.col(f"q{i}")).alias(f"below{i}") for i in range(2)])
    slack = [F.greatest(sketches.RANK_ERROR * F.col("seen"), F.lit(1.0)) for _ in ranks]
    good = [(F.col(f"at{i}") >= q * F.col("seen") - slack[i]) & (F.col(f"below{i}") <= q * F.col("seen") + slack[i]) for i, q in enumerate(ranks)]
    near = F.abs(F.col("guess") - F.col("customers")) <= F.greatest(sketches.DISTINCT_ERROR * F.col("customers"), F.lit(1.0))
    return exact.select("channel", "n", F.col("seen").alias("n_chars"), good[0].alias("median_in_bound"), good[1].alias("p95_in_bound"),
                        near.alias("customers_in_bound"))


@query
def i8_replay(spark, d):
    return replay.replay(table(spark, d, "conversations"), 300)


@query
def i9_byte_ranges(spark, d):
    raw = raw_tickets(spark, d).withColumnRenamed("row_seq", "src_seq")
    path = scratch_dir(spark, "ranges")
    raw.filter("status = 'open'").select("src_seq", "ticket_id", "customer_id", "channel", "status").write.options(**CSV).csv(f"{path}/one")
    raw.filter("status <> 'open'").select("status", "ticket_id", "src_seq", "priority").write.options(**CSV).csv(f"{path}/two")
    back = ranges.read_files(spark, path, split_bytes=1 << 20)
    return back.select(F.col("src_seq").cast("long").alias("src_seq"), "ticket_id", "customer_id", "channel", "status", "priority")


@query
def i10_incremental_counts(spark, d):
    events = table(spark, d, "events").select("event_id", "user_id", F.round(F.col("value") * 100).cast("long").alias("cents"))
    path = scratch_dir(spark, "deltas")
    for seq in range(10):
        gone = events.filter((F.col("event_id") % 10 == seq - 1) & (F.col("event_id") % 7 == 0))
        changes = deltas.signed(events.filter(F.col("event_id") % 10 == seq), gone)
        deltas.append(changes, path, seq, ["user_id"], {"cents": F.col("cents")})
    counts = deltas.current(spark, path, ["user_id"])
    return counts.select("user_id", "n", "cents", (F.col("n") >= 3).alias("repeat_contact"))
