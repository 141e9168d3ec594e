"""SQL twins of the catalogue queries, for DuckDB over the same tables."""

from __future__ import annotations

from tidedesk.plans import views

_ENUM = "CASE WHEN lower({s}) IN ({v}) THEN lower({s}) ELSE {o} END"


def _strip(c: str) -> str:
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def _enum(c: str, values: str, other: str = "'unknown'") -> str:
    return _ENUM.format(s=_strip(c), v=values, o=other)


CHANNELS = "'email','chat','phone','web'"
STATUSES = "'open','closed','pending'"
CATEGORIES = "'billing','technical','general','other'"
PRIORITIES = "'low','medium','high','critical'"
SENTIMENTS = "'positive','neutral','negative','frustrated'"
AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"
UUID = "[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}"
NA = "'','#N/A','#N/A N/A','#NA','-1.#IND','-1.#QNAN','-NaN','-nan','1.#IND','1.#QNAN','<NA>','N/A','NA','NULL','NaN','None','n/a','nan','null'"

_TS = (r"CASE WHEN regexp_matches({c}, '^\d{{4}}(-|$)') THEN try_cast({c} AS TIMESTAMP) "
       "ELSE coalesce(try_strptime({c}, '%m/%d/%Y'), try_strptime({c}, '%d/%m/%Y')) END")

COLUMNS = ["ticket_id", "created_at", "customer_id", "channel", "subject", "body", "priority", "category", "status", "agent_id"]
# What each layout of b2_layouts keeps of a time.
KEPT = ["minute", "day", "day", "day", "day", "day", "day", "day", "second", "second", "second", "minute", "second", "day", "minute", "second",
        "minute", "second", "second", "day", "minute", "minute", "month", "second"]
CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, needs: list[str], sql: str) -> None:
    CTES[name] = (needs, sql)


def with_ctes(needs: list[str], body: str) -> str:
    order: list[str] = []

    def add(n: str) -> None:
        for m in CTES[n][0]:
            add(m)
        if n not in order:
            order.append(n)

    for n in needs:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order) + "\n" + body


cte("tickets", [], views.TICKETS)
cte("norm", ["tickets"], f"""
SELECT row_seq, {_strip('ticket_id')} AS ticket_id, {_TS.format(c='created_at')} AS created_at,
 {_strip('customer_id')} AS customer_id, {_enum('channel', CHANNELS)} AS channel,
 nullif({_strip('subject')}, '') AS subject,
 regexp_replace(nullif({_strip('body')}, ''), '<[^>]+>', '', 'g') AS body, nullif({_strip('body')}, '') AS body0,
 {_enum('priority', PRIORITIES, 'NULL')} AS priority, {_enum('category', CATEGORIES)} AS category,
 {_enum('status', STATUSES)} AS status, {_strip('agent_id')} AS agent_id, sentiment, llm_category
FROM tickets""")
FLAGS = f"""concat_ws('|', CASE WHEN subject IS NULL THEN 'missing_subject' END, CASE WHEN priority IS NULL THEN 'missing_priority' END,
 CASE WHEN coalesce(channel NOT IN ({CHANNELS},'unknown'), true) THEN 'invalid_channel' END,
 CASE WHEN coalesce(status NOT IN ({STATUSES},'unknown'), true) THEN 'invalid_status' END,
 CASE WHEN created_at IS NULL THEN 'null_created_at' END, CASE WHEN length(body) < 10 THEN 'short_body' END,
 CASE WHEN created_at > {AS_OF} THEN 'future_created_at' END,
 CASE WHEN status = 'closed' AND agent_id IS NULL THEN 'closed_without_agent' END)"""
cte("flagged", ["norm"], f"SELECT *, {FLAGS} AS quality_flags FROM norm")


def _report(source: str, names: list[str]) -> str:
    rates = {
        "completeness_subject": ("subject IS NOT NULL", 0.90), "completeness_priority": ("priority IS NOT NULL", 0.80),
        "validity_channel": (f"coalesce(channel IN ({CHANNELS},'unknown'), false)", 0.95),
        "validity_status": (f"coalesce(status IN ({STATUSES},'unknown'), false)", 0.95),
    }
    counts = {
        "uniqueness_ticket_id": ("count(*) - (count(DISTINCT ticket_id) + max(CASE WHEN ticket_id IS NULL THEN 1 ELSE 0 END))", "greatest(1, floor(count(*) * 0.05))"),
        "validity_created_at": ("count(*) FILTER (created_at IS NULL)", "greatest(1, floor(count(*) * 0.10))"),
        "short_body": ("count(*) FILTER (length(body) < 10)", "greatest(1, floor(count(*) * 0.01))"),
        "future_created_at": (f"count(*) FILTER (created_at > {AS_OF})", "0"),
        "closed_without_agent": ("count(*) FILTER (status = 'closed' AND agent_id IS NULL)", "floor(count(*) * 0.05)"),
    }
    out = []
    for n in names:
        if n in rates:
            p, t = rates[n]
            v = f"avg(CASE WHEN {p} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"
            out.append(f"SELECT '{n}' AS \"check\", {v} >= {t}::DOUBLE AS passed, round({v}, 4) AS value, {t}::DOUBLE AS threshold FROM {source}")
        else:
            v, t = counts[n]
            out.append(f"SELECT '{n}' AS \"check\", ({v}) <= ({t}) AS passed, CAST({v} AS DOUBLE) AS value, CAST({t} AS DOUBLE) AS threshold FROM {source}")
    return "\nUNION ALL ".join(out)


RATES = ["completeness_subject", "completeness_priority", "validity_channel", "validity_status"]
COUNTS = ["validity_created_at", "short_body", "future_created_at", "closed_without_agent"]
NINE = [*RATES, "uniqueness_ticket_id", *COUNTS]


def _tally(source: str, cells: list[tuple[str, str, str]]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{s}' AS section, '{n}' AS name, coalesce(CAST({e} AS DOUBLE), 0.0::DOUBLE) AS value FROM {source}" for s, n, e in cells)


def _cnt(p: str) -> str:
    return f"count(*) FILTER ({p})"


# Replies
cte("responses", ["tickets"], views.RESPONSES)
_UNFENCED = r"CASE WHEN starts_with({c}, '```') THEN regexp_replace(regexp_replace({c}, '^```[^\n]*\n', ''), '\n```\s*$', '') ELSE {c} END"
cte("unfenced", ["responses"], f"SELECT *, {_UNFENCED.format(c='raw_text')} AS txt FROM responses")
cte("fields", ["unfenced"], """
SELECT *, json_extract_string(js, '$.category') AS c, json_extract_string(js, '$.priority') AS p,
 try_cast(json_extract_string(js, '$.confidence') AS DOUBLE) AS f
FROM (SELECT *, CASE WHEN json_valid(txt) THEN txt END AS js FROM unfenced) u""")
_GOOD = f"coalesce(c IN ({CATEGORIES}) AND p IN ({PRIORITIES}) AND f BETWEEN 0 AND 1, false)"
cte("parsed", ["fields"], f"""
SELECT row_seq, tier, CASE WHEN ok THEN c END AS category, CASE WHEN ok THEN p END AS priority, CASE WHEN ok THEN round(f, 3) END AS confidence, ok,
 CASE WHEN ok THEN input_tokens ELSE 0 END AS ti, CASE WHEN ok THEN output_tokens ELSE 0 END AS tou, CASE WHEN ok THEN cache_read_tokens ELSE 0 END AS tc
FROM (SELECT *, {_GOOD} AND stop_reason <> 'refusal' AS ok FROM fields) x""")
cte("merged", ["tickets", "parsed"], """
SELECT t.row_seq, CASE WHEN take2 THEN c2 WHEN ok1 THEN c1 ELSE 'unknown' END AS llm_category,
 CASE WHEN take2 THEN p2 WHEN ok1 THEN p1 ELSE 'unknown' END AS llm_priority,
 CASE WHEN take2 THEN f2 WHEN ok1 THEN f1 ELSE 0.0::DOUBLE END AS llm_confidence, rev AND NOT take2 AS needs_review, rev AS escalated
FROM (SELECT a.row_seq, a.ok AS ok1, a.category AS c1, a.priority AS p1, a.confidence AS f1, b.category AS c2, b.priority AS p2, b.confidence AS f2,
   coalesce(a.ok AND a.confidence < 0.70::DOUBLE, false) AS rev, coalesce(a.ok AND a.confidence < 0.70::DOUBLE AND b.ok AND b.confidence >= 0.85::DOUBLE, false) AS take2
  FROM parsed a JOIN parsed b ON a.row_seq = b.row_seq AND a.tier = 1 AND b.tier = 2) m JOIN tickets t ON t.row_seq = m.row_seq""")
cte("budget1", ["parsed"], """
SELECT r.* FROM (SELECT *, (row_number() OVER (ORDER BY row_seq) - 1) // 10 AS b FROM parsed WHERE tier = 1) r
JOIN (SELECT b, coalesce(sum(ti) OVER w, 0) AS bi, coalesce(sum(tou) OVER w, 0) AS bo FROM
   (SELECT b, sum(ti) AS ti, sum(tou) AS tou FROM (SELECT *, (row_number() OVER (ORDER BY row_seq) - 1) // 10 AS b FROM parsed WHERE tier = 1) q GROUP BY b) g
   WINDOW w AS (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) c ON r.b = c.b
WHERE bi::DOUBLE / 1000000 * 0.8::DOUBLE + bo::DOUBLE / 1000000 * 4.0::DOUBLE < 0.05::DOUBLE""")
cte("budget2", ["parsed", "budget1"], """
SELECT row_seq FROM (SELECT p.row_seq, coalesce(sum(p.ti) OVER w, 0) AS bi, coalesce(sum(p.tou) OVER w, 0) AS bo,
  (SELECT sum(ti)::DOUBLE / 1000000 * 0.8::DOUBLE + sum(tou)::DOUBLE / 1000000 * 4.0::DOUBLE FROM budget1) AS spent
 FROM parsed p JOIN budget1 b ON p.row_seq = b.row_seq AND b.ok AND b.confidence < 0.70::DOUBLE WHERE p.tier = 2
 WINDOW w AS (ORDER BY p.row_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) x
WHERE spent + bi::DOUBLE / 1000000 * 3.0::DOUBLE + bo::DOUBLE / 1000000 * 15.0::DOUBLE < 0.08::DOUBLE""")

# Enrichment
cte("enrichments", ["tickets"], views.ENRICHMENTS)
cte("enr_fields", ["enrichments"], """
SELECT *, json_extract_string(js, '$.sentiment') AS s, try_cast(json_extract_string(js, '$.sentiment_confidence') AS DOUBLE) AS sc,
 nullif(trim(json_extract_string(js, '$.summary')), '') AS su, try_cast(json_extract_string(js, '$.urgency_score') AS DOUBLE) AS us,
 nullif(trim(json_extract_string(js, '$.urgency_reason')), '') AS ur,
 coalesce(json_extract(js, '$.entities.product_names'), '[]') AS pn, coalesce(json_extract(js, '$.entities.error_codes'), '[]') AS ec,
 coalesce(json_extract(js, '$.entities.account_ids'), '[]') AS ai,
 nullif(trim(json_extract_string(simple_text, '$.summary')), '') AS ssu, full_stop <> 'refusal' AS answered
FROM (SELECT *, CASE WHEN json_valid(full_text) THEN full_text END AS js FROM enrichments) u""")
cte("enr_ok", ["enr_fields"], f"""
SELECT *, answered AND coalesce(s IN ({SENTIMENTS}) AND sc BETWEEN 0 AND 1 AND su IS NOT NULL AND us BETWEEN 0 AND 1 AND ur IS NOT NULL
   AND CAST(ai AS VARCHAR) = '[]', false) AS full_ok FROM enr_fields""")
_NONE = '\'{"product_names":[],"error_codes":[],"account_ids":[]}\''
cte("enr", ["enr_ok"], f"""
SELECT row_seq, CASE WHEN full_ok THEN s WHEN simple_ok THEN 'neutral' END AS sentiment,
 CASE WHEN full_ok THEN round(sc, 3) WHEN simple_ok THEN 0.5::DOUBLE END AS sentiment_confidence,
 CASE WHEN full_ok THEN concat('{{"product_names":', CAST(pn AS VARCHAR), ',"error_codes":', CAST(ec AS VARCHAR), ',"account_ids":[]}}') ELSE {_NONE} END AS entities_json,
 CASE WHEN full_ok THEN su WHEN simple_ok THEN ssu END AS summary,
 CASE WHEN full_ok THEN round(us, 2) ELSE 0.5::DOUBLE END AS urgency_score,
 CASE WHEN full_ok THEN ur ELSE 'Classification failed; manual review required' END AS urgency_reason,
 NOT (full_ok OR simple_ok) AS enrichment_failed, pn, ec, full_ok, simple_ok, input_tokens, output_tokens, cache_read_tokens
FROM (SELECT *, answered AND NOT full_ok AND ssu IS NOT NULL AS simple_ok FROM enr_ok) x""")
_ENR_COLS = "row_seq, sentiment, sentiment_confidence, entities_json, summary, urgency_score, urgency_reason, enrichment_failed"
cte("repeats", ["norm"], """
SELECT n.*, coalesce(r.k >= 3, false) AS repeat_contact FROM norm n
LEFT JOIN (SELECT customer_id, count(*) AS k FROM norm WHERE customer_id IS NOT NULL GROUP BY customer_id) r ON n.customer_id = r.customer_id""")

# Anomalies
cte("lengths", ["norm"], "SELECT avg(length(body)) AS m, stddev_samp(length(body)) AS s, count(body) AS k FROM norm")
cte("dups", ["norm"], r"""
SELECT row_seq, length(key) > 20 AND count(*) OVER (PARTITION BY key) >= 2 AS dup FROM
(SELECT row_seq, regexp_replace(lower(regexp_replace(body, '^\s+|\s+$', '', 'g')), '\s+', ' ', 'g') AS key FROM norm WHERE body IS NOT NULL) x""")
cte("aflags", ["repeats", "lengths", "dups"], """
SELECT r.row_seq, r.ticket_id, r.subject, r.body, r.sentiment, r.llm_category,
 concat_ws('|', CASE WHEN k >= 2 AND length(r.body) > m + 3.0::DOUBLE * s THEN 'body_length_spike' END, CASE WHEN sentiment = 'frustrated' THEN 'frustrated_sentiment' END,
 CASE WHEN llm_category = 'unknown' THEN 'unclassified' END, CASE WHEN repeat_contact AND sentiment IN ('frustrated','negative') THEN 'repeat_frustrated' END,
 CASE WHEN coalesce(dup, false) THEN 'duplicate_body' END) AS statistical_flags
FROM repeats r CROSS JOIN lengths LEFT JOIN dups d ON r.row_seq = d.row_seq""")
cte("cands", ["aflags"], """
SELECT a.row_seq, a.ticket_id, a.subject, a.body, a.sentiment, a.llm_category, i.f AS statistical_flags FROM aflags a
JOIN (SELECT ticket_id, arg_max(statistical_flags, row_seq) AS f FROM aflags WHERE statistical_flags <> '' GROUP BY ticket_id) i ON a.ticket_id = i.ticket_id""")
cte("chosen", ["cands"], r"""
SELECT * FROM (SELECT *, body IS NOT NULL AND contains(statistical_flags, 'duplicate_body') AS isdup,
 row_number() OVER (PARTITION BY (body IS NOT NULL AND contains(statistical_flags, 'duplicate_body')), lower(regexp_replace(body, '^\s+|\s+$', '', 'g')) ORDER BY row_seq) AS rk FROM cands) x
WHERE NOT isdup OR rk = 1""")
cte("verdicts", ["tickets"], views.VERDICTS)
cte("scored", ["chosen", "verdicts"], """
SELECT row_seq, ticket_id, statistical_flags, CASE WHEN good THEN t ELSE split_part(statistical_flags, '|', 1) END AS anomaly_type,
 CASE WHEN good THEN se ELSE 'low' END AS severity, CASE WHEN good THEN re ELSE 'Classification failed' END AS reason,
 CASE WHEN good THEN ac ELSE 'monitor' END AS recommended_action, 'hybrid' AS detection_method
FROM (SELECT c.*, json_extract_string(js, '$.anomaly_type') AS t, json_extract_string(js, '$.severity') AS se, trim(json_extract_string(js, '$.reason')) AS re,
   json_extract_string(js, '$.recommended_action') AS ac,
   coalesce(json_extract_string(js, '$.anomaly_type') IN ('body_length_spike','frustrated_sentiment','unclassified','potential_incident','repeat_frustrated','duplicate_body'), false) AS good
  FROM chosen c JOIN (SELECT row_seq, CASE WHEN json_valid(raw_text) THEN raw_text END AS js FROM verdicts) v ON c.row_seq = v.row_seq WHERE c.body IS NOT NULL) y""")
cte("statonly", ["chosen"], """
SELECT row_seq, ticket_id, statistical_flags, split_part(statistical_flags, '|', 1) AS anomaly_type, 'low' AS severity,
 'Ticket body is null; statistical flag only' AS reason, 'manual_review' AS recommended_action, 'statistical' AS detection_method
FROM chosen WHERE body IS NULL""")
cte("anom", ["scored", "statonly"], "SELECT * FROM scored UNION ALL SELECT * FROM statonly")

# Actions
cte("status_changes", ["norm"], """
SELECT event_id, event_type, ts,
 concat('00000000-0000-4000-8000-', lpad(CAST(CASE WHEN event_id % 3 = 0 THEN 6 ELSE event_id % 500 END AS VARCHAR(20)), 12, '0')) AS ticket_id,
 CASE event_id % 4 WHEN 0 THEN 'open' WHEN 1 THEN 'pending' WHEN 2 THEN 'closed' ELSE 'reopened' END AS new_status FROM events""")
cte("second_run", ["flagged"], """
SELECT ticket_id, channel, CASE WHEN row_seq % 41 = 5 THEN 'closed' ELSE status END AS status, priority, quality_flags
FROM flagged, unnest(range(CASE WHEN row_seq % 40 = 3 THEN 0 WHEN row_seq % 43 = 7 THEN 2 ELSE 1 END)) t(k)""")
cte("net_rows", ["second_run"], """
SELECT ticket_id, sum(sign) AS copies FROM (
 SELECT ticket_id, channel, status, priority, quality_flags, -1 AS sign FROM flagged UNION ALL SELECT *, 1 FROM second_run) x
GROUP BY ticket_id, channel, status, priority, quality_flags HAVING sum(sign) <> 0""")
cte("net_keys", ["net_rows"], "SELECT ticket_id, sum(greatest(copies, 0)) AS more, sum(greatest(-copies, 0)) AS fewer FROM net_rows GROUP BY ticket_id")

cte("calls", [], views.TOOL_CALLS)
cte("steps", ["calls"], views.STEPS)
cte("ran", ["calls", "steps"], """
SELECT c.* FROM calls c LEFT JOIN (SELECT anomaly_id, min(step) AS fin FROM steps WHERE stop_reason <> 'tool_use' GROUP BY anomaly_id) e
 ON c.anomaly_id = e.anomaly_id WHERE e.fin IS NULL OR c.step < e.fin""")
# arguments given per call, and the catalogue: (tool, required argument), (tool, argument, allowed value)
cte("given", ["calls"], """
SELECT call_id, unnest(CASE tool WHEN 'escalate_ticket' THEN CASE WHEN call_id % 5 = 0 THEN ['ticket_id', 'severity'] ELSE ['ticket_id', 'severity', 'reason'] END
  WHEN 'send_alert' THEN ['message', 'channel'] WHEN 'create_task' THEN ['title'] WHEN 'get_ticket_history' THEN CASE WHEN call_id % 7 = 0 THEN [] ELSE ['customer_id'] END
  WHEN 'update_ticket_status' THEN ['ticket_id', 'new_status', 'reason'] ELSE ['x'] END) AS arg,
 CASE tool WHEN 'escalate_ticket' THEN severity WHEN 'send_alert' THEN CASE severity WHEN 'high' THEN 'slack' WHEN 'medium' THEN 'pagerduty' ELSE 'fax' END
  WHEN 'update_ticket_status' THEN new_status END AS chosen
FROM calls""")
cte("catalogue", [], """
SELECT * FROM (VALUES ('escalate_ticket', 'ticket_id', 1, NULL), ('escalate_ticket', 'reason', 2, NULL), ('escalate_ticket', 'severity', 3, ['low', 'medium', 'high']),
 ('send_alert', 'message', 1, NULL), ('send_alert', 'channel', 2, ['slack', 'email', 'pagerduty']), ('create_task', 'title', 1, NULL),
 ('create_task', 'description', 2, NULL), ('create_task', 'assignee', 3, ['tier1', 'tier2', 'billing_team', 'engineering']),
 ('auto_respond', 'ticket_id', 1, NULL), ('auto_respond', 'response_template', 2, ['acknowledge_delay', 'sla_commitment', 'escalation_notice', 'general_thanks']),
 ('get_ticket_history', 'customer_id', 1, NULL), ('update_ticket_status', 'ticket_id', 1, NULL),
 ('update_ticket_status', 'new_status', 2, ['open', 'pending', 'closed']), ('update_ticket_status', 'reason', 3, NULL)) t(tool, arg, k, allowed)""")
_WAIT = "(tool = 'escalate_ticket' AND severity = 'high')"
cte("updates", ["ran"], f"""
SELECT ticket_id, arg_max(new_status, call_id) AS new_status FROM ran
WHERE tool = 'update_ticket_status' AND new_status <> 'reopened' GROUP BY ticket_id""")


def _sensitivity(source: str, text: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {z}::DOUBLE AS z, count(*) FILTER (length({text}) > m + {z}::DOUBLE * s) AS flagged, "
        f"round(count(*) FILTER (length({text}) > m + {z}::DOUBLE * s) / count(*)::DOUBLE, 3) AS pct_of_total "
        f"FROM {source}, (SELECT avg(length({text})) AS m, stddev_samp(length({text})) AS s FROM {source}) q" for z in ("2.0", "2.5", "3.0"))


def oracle_sql() -> dict[str, str]:
    o: dict[str, str] = {}
    w = with_ctes
    na = lambda c: f"CASE WHEN {c} NOT IN ({NA}) THEN {c} END AS {c}"
    o["a1_csv_by_header"] = w(["tickets"], "SELECT row_seq AS src_seq, " + ", ".join(
        na(c) for c in ("ticket_id", "created_at", "customer_id", "channel", "subject", "body", "priority", "status", "agent_id"))
        + ", CASE WHEN status = 'open' THEN category END AS category FROM tickets")
    o["a2_csv_suffix"] = w(["tickets"], "SELECT channel, count(*) AS n, CAST(0 AS BIGINT) AS repeated_row_seq FROM tickets GROUP BY channel")
    o["a3_null_tokens"] = "SELECT o_orderkey, CASE WHEN o_orderpriority NOT IN ('1-URGENT','2-HIGH','3-MEDIUM','5-LOW') THEN o_orderpriority END AS priority FROM orders"
    o["a4_no_input"] = "SELECT '*.csv' AS pattern, count(*) > 0 AS has_input FROM orders UNION ALL SELECT '*.tsv', false"
    o["a5_a6_parquet"] = w(["norm"], "SELECT row_seq, channel, status, epoch_us(created_at) AS created_at_us FROM norm")
    o["a7_channel_partitions"] = w(["norm"], "SELECT channel, count(*) AS n, (SELECT count(DISTINCT channel) FROM norm) AS partitions FROM norm GROUP BY channel")
    o["a8_report_json"] = w(["norm"], _report("norm", NINE))
    o["a9_json_lines"] = w(["calls"], """
SELECT tool, count(*) AS n, CAST(sum(CASE tool WHEN 'escalate_ticket' THEN CASE WHEN call_id % 5 = 0 THEN 2 ELSE 3 END WHEN 'send_alert' THEN 2
 WHEN 'update_ticket_status' THEN 3 WHEN 'get_ticket_history' THEN CASE WHEN call_id % 7 = 0 THEN NULL ELSE 1 END ELSE 1 END) AS BIGINT) AS arguments, max(call_id) AS last_call FROM calls GROUP BY tool""")
    o["a10_dead_letter"] = w(["flagged"], "SELECT row_seq, quality_flags FROM flagged WHERE quality_flags <> ''")

    o["b_normalize"] = w(["norm"], f"""
SELECT row_seq, ticket_id, epoch_us(created_at) AS created_at_us, customer_id, channel, subject, body, priority, category, status, agent_id,
 created_at IS NULL AS parse_error, priority IS NOT NULL AS priority_normalized, coalesce(body <> body0, false) AS html_stripped,
 coalesce(NOT regexp_full_match(ticket_id, '{UUID}', 'i'), true) AS invalid_ticket_id, '1.0' AS _schema_version, '2024-02-01T00:00:00Z' AS _processed_at FROM norm""")
    o["b2_parse_ts"] = """
SELECT event_id, epoch_us(parsed_at) AS at_us, parsed_at IS NULL AS parse_error FROM (SELECT event_id, CASE event_type
 WHEN 'view' THEN date_trunc('day', ts) WHEN 'click' THEN date_trunc('second', ts) - INTERVAL 2 HOUR WHEN 'error' THEN date_trunc('second', ts)
 WHEN 'signup' THEN NULL ELSE date_trunc('second', ts) END AS parsed_at FROM events) x"""
    o["b2_layouts"] = ("SELECT event_id, epoch_us(CASE event_id % 24 " + " ".join(
        f"WHEN {i} THEN date_trunc('{p}', ts)" for i, p in enumerate(KEPT)) + " END) AS at_us FROM events")
    o["b1_missing_columns"] = "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, unnest({[c for c in COLUMNS if c not in have]}) AS missing_column, (SELECT count(*) FROM {t}) AS table_rows"
        for t, have in (("orders", ()), ("documents", ("body",)), ("events", ())))
    o["b3_enums"] = w(["norm"], "SELECT row_seq, channel, status, category FROM norm")
    o["b4_priority"] = w(["norm"], "SELECT row_seq, priority, priority IS NOT NULL AS priority_normalized FROM norm")
    low = lambda c: f"lower({_strip(c)})"
    o["b5_strict_violations"] = w(["tickets"], " UNION ".join(
        f"SELECT '{c}' AS column_name, {low(c)} AS bad_value FROM tickets WHERE {low(c)} NOT IN ({v})"
        for c, v in (("channel", CHANNELS), ("priority", PRIORITIES), ("status", STATUSES), ("category", CATEGORIES))))
    o["b6_b7_strip"] = w(["norm"], "SELECT row_seq, subject, customer_id FROM norm")
    o["b8_strip_html"] = "SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS plain, regexp_replace(html, '<[^>]+>', '', 'g') <> html AS changed FROM pages"
    o["b9_uuid4"] = w(["tickets"], f"SELECT row_seq, NOT regexp_full_match(ticket_id, '{UUID}', 'i') AS invalid_ticket_id FROM tickets")
    o["b10_meta"] = "SELECT o_orderkey, '1.0' AS _schema_version, '2024-02-01T00:00:00Z' AS _processed_at FROM orders"
    o["b11_row_count"] = w(["norm"], """
SELECT (SELECT count(*) FROM tickets) AS rows_in, count(*) AS rows_out, count(*) FILTER (created_at IS NULL) AS parse_errors,
 count(*) FILTER (nullif(body, '') IS NULL) AS null_bodies FROM norm""")

    o["c1_c8_flag_counts"] = w(["flagged"], "SELECT flag, count(*) AS n FROM (SELECT unnest(string_split(quality_flags, '|')) AS flag FROM flagged) x WHERE flag <> '' GROUP BY flag")
    o["c3_c4_raw_enums"] = w(["tickets"], f"SELECT row_seq, {FLAGS} AS quality_flags FROM (SELECT * EXCLUDE (created_at), {_TS.format(c='created_at')} AS created_at FROM tickets) x")
    o["c9_quality_flags"] = w(["flagged"], "SELECT row_seq, quality_flags FROM flagged")
    o["c9_flags_lineitem"] = """
SELECT l_orderkey, l_linenumber, concat_ws('|', CASE WHEN l_quantity < 5 THEN 'missing_subject' END, CASE WHEN l_discount >= 0.09::DOUBLE THEN 'missing_priority' END,
 CASE WHEN l_returnflag NOT IN ('A','N') THEN 'invalid_channel' END, CASE WHEN length(concat('part ', l_partkey)) < 10 THEN 'short_body' END,
 CASE WHEN l_shipdate > TIMESTAMP '2001-12-31 00:00:00' THEN 'future_created_at' END,
 CASE WHEN l_linestatus = 'F' AND l_tax <= 0.01::DOUBLE THEN 'closed_without_agent' END) AS quality_flags FROM lineitem"""
    o["c10_rate_checks"] = w(["norm"], _report("norm", RATES))
    o["c11_count_checks"] = w(["norm"], _report("norm", COUNTS))
    o["c12_duplicate_ids"] = w(["norm"], "SELECT count(*) - count(DISTINCT ticket_id) AS duplicates FROM norm")
    o["c12_duplicate_customers"] = "SELECT count(*) - count(DISTINCT o_custkey) AS duplicates FROM orders"
    o["c13_gate_verdict"] = w(["norm"], _report("norm", ["uniqueness_ticket_id"]))
    o["c14_quality_report"] = w(["norm"], _report("norm", NINE))
    o["c15_trend"] = w(["norm"], f"""
SELECT c.*, round(c.value - p.value, 4) AS trend FROM ({_report('norm', NINE)}) c
LEFT JOIN ({_report("(SELECT * FROM norm WHERE status <> 'open') n", [n for n in NINE if n != 'short_body'])}) p ON c."check" = p."check" """)
    o["c16_contract"] = w(["tickets"], f"""
SELECT row_seq, concat_ws('|', CASE WHEN ticket_id IS NULL THEN 'ticket_id_required' END, CASE WHEN customer_id IS NULL THEN 'customer_id_required' END,
 CASE WHEN channel IS NULL THEN 'channel_required' END, CASE WHEN status = 'pending' THEN 'status_required' END,
 CASE WHEN channel NOT IN ({CHANNELS},'unknown') THEN 'channel_value' END,
 CASE WHEN status <> 'pending' AND status NOT IN ({STATUSES},'unknown') THEN 'status_value' END) AS violations FROM tickets""")
    o["c17_profile"] = w(["norm"], "SELECT section, name, CAST(value AS BIGINT) AS value FROM (" + _tally("norm", [
        ("totals", "total_records", "count(*)"), ("totals", "parse_errors", _cnt("created_at IS NULL")),
        ("totals", "html_stripped", _cnt("body <> body0")), ("totals", "invalid_ticket_ids", _cnt(f"NOT regexp_full_match(ticket_id, '{UUID}', 'i')")),
        ("totals", "priority_nulled", _cnt("priority IS NULL")),
        *[("null_counts", c, _cnt(f"{c} IS NULL")) for c in ("subject", "body", "priority", "agent_id")]]) + ") t"
        " UNION ALL SELECT 'channel_distribution', channel, count(*) FROM norm GROUP BY channel"
        " UNION ALL SELECT 'status_distribution', status, count(*) FROM norm GROUP BY status")

    prompt = "concat('Subject: ', coalesce(subject, ''), chr(10), chr(10), 'Body: ', coalesce(body, ''))"
    nonblank = "trim(coalesce(subject, '')) <> '' OR trim(coalesce(body, '')) <> ''"
    o["d1_scoring_input"] = w(["norm"], f"SELECT row_seq, {prompt} AS prompt FROM norm WHERE {nonblank}")
    o["d2_score_batch"] = w(["norm"], f"""
SELECT row_seq, CASE WHEN contains(lower(prompt), 'the') THEN 'technical' ELSE 'general' END AS category, length(prompt) AS prompt_chars
FROM (SELECT row_seq, {prompt} AS prompt FROM norm WHERE {nonblank}) x""")
    o["d3_strip_fences"] = w(["unfenced"], "SELECT row_seq, CAST(tier AS BIGINT) AS tier, txt AS json_text FROM unfenced")
    o["d4_parse_classification"] = w(["fields"], f"""
SELECT row_seq, CAST(tier AS BIGINT) AS tier, CASE WHEN ok THEN c END AS category, CASE WHEN ok THEN p END AS priority, CASE WHEN ok THEN round(f, 3) END AS confidence, ok
FROM (SELECT *, {_GOOD} AS ok FROM fields) x""")
    o["d4_repeated_keys"] = o["d4_parse_classification"]  # the last of repeated keys counts
    o["d5_refusals"] = w(["responses"], "SELECT row_seq, CAST(tier AS BIGINT) AS tier FROM responses WHERE stop_reason = 'refusal'")
    o["d7_merge_tiers"] = w(["merged"], "SELECT * FROM merged")
    o["d9_first_n"] = w(["tickets"], "SELECT row_seq, ticket_id FROM tickets ORDER BY row_seq LIMIT 25")
    o["d9_first_n_large"] = "SELECT o_orderkey AS row_seq, o_custkey FROM orders ORDER BY o_orderkey LIMIT 10007"
    ecost = "sum(input_tokens)::DOUBLE / 1000000 * {i}::DOUBLE + sum(output_tokens)::DOUBLE / 1000000 * {j}::DOUBLE"
    o["d12_enrichment_cost"] = w(["enr"], f"""
SELECT model, CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens,
 round(CASE model WHEN 'small' THEN {ecost.format(i='0.8', j='4.0')} ELSE {ecost.format(i='3.0', j='15.0')} END, 6) AS cost_usd
FROM (SELECT *, CASE WHEN full_ok THEN 'small' ELSE 'large' END AS model FROM enr WHERE full_ok OR simple_ok) x GROUP BY model""")
    o["d15_enrichment_cache"] = w(["enr"], "SELECT round(sum(cache_read_tokens)::DOUBLE / (sum(input_tokens) + sum(cache_read_tokens))::DOUBLE, 4) AS cache_hit_rate FROM enr WHERE full_ok")
    o["d10_tier1_budget"] = w(["budget1"], "SELECT row_seq, ok FROM budget1")
    o["d10_orders_budget"] = """
WITH r AS (SELECT o_orderkey * 70001 AS row_seq, o_custkey % 100 AS ti, o_custkey % 7 AS tou, (row_number() OVER (ORDER BY o_orderkey) - 1) // 10 AS b FROM orders),
g AS (SELECT b, coalesce(sum(ti) OVER w, 0) AS bi, coalesce(sum(tou) OVER w, 0) AS bo FROM (SELECT b, sum(ti) AS ti, sum(tou) AS tou FROM r GROUP BY b) q
 WINDOW w AS (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT row_seq FROM r JOIN g ON r.b = g.b WHERE bi::DOUBLE / 1000000 * 0.8::DOUBLE + bo::DOUBLE / 1000000 * 4.0::DOUBLE < 0.4::DOUBLE"""
    o["d11_tier2_budget"] = w(["budget2"], "SELECT row_seq FROM budget2")
    cost = "round(CASE tier WHEN 1 THEN sum(ti)::DOUBLE / 1000000 * 0.8::DOUBLE + sum(tou)::DOUBLE / 1000000 * 4.0::DOUBLE ELSE sum(ti)::DOUBLE / 1000000 * 3.0::DOUBLE + sum(tou)::DOUBLE / 1000000 * 15.0::DOUBLE END, 6)"
    o["d12_usage_cost"] = w(["parsed"], f"SELECT CAST(tier AS BIGINT) AS tier, CAST(sum(ti) AS BIGINT) AS input_tokens, CAST(sum(tou) AS BIGINT) AS output_tokens, {cost} AS cost_usd FROM parsed GROUP BY tier")
    o["d12_total_cost"] = w(["parsed"], f"SELECT round(sum(c), 4) AS total_cost_usd FROM (SELECT {cost} AS c FROM parsed GROUP BY tier) x")
    o["d13_classification_report"] = w(["merged"], _tally("merged", [
        ("totals", "total_tickets", "count(*)"), ("totals", "needs_review", _cnt("needs_review")), ("totals", "escalated", _cnt("escalated")),
        *[("category_distribution", v, _cnt(f"llm_category = '{v}'")) for v in ("billing", "technical", "general", "other")],
        *[("priority_distribution", v, _cnt(f"llm_priority = '{v}'")) for v in ("low", "medium", "high", "critical")]])
        + " UNION ALL " + _tally("(SELECT * FROM parsed WHERE tier = 1) p", [("totals", "classified", _cnt("ok")), ("totals", "failed", _cnt("NOT ok"))]))
    o["d14_confidence_buckets"] = w(["merged"], _tally("merged", [
        ("confidence_buckets", "0.0-0.5", _cnt("llm_confidence < 0.5::DOUBLE")),
        ("confidence_buckets", "0.5-0.7", _cnt("llm_confidence >= 0.5::DOUBLE AND llm_confidence < 0.7::DOUBLE")),
        ("confidence_buckets", "0.7-0.9", _cnt("llm_confidence >= 0.7::DOUBLE AND llm_confidence < 0.9::DOUBLE")),
        ("confidence_buckets", "0.9-1.0", _cnt("llm_confidence >= 0.9::DOUBLE"))]))
    o["d15_cache_hit_rate"] = w(["parsed"], "SELECT round(sum(tc)::DOUBLE / (sum(ti) + sum(tc))::DOUBLE, 4) AS cache_hit_rate FROM parsed WHERE tier = 1")

    o["e1_parse_enrichment"] = w(["enr_ok"], """
SELECT row_seq, answered, CASE WHEN full_ok THEN s END AS sentiment, CASE WHEN full_ok THEN round(sc, 3) END AS sentiment_confidence, CASE WHEN full_ok THEN su END AS summary,
 CASE WHEN full_ok THEN round(us, 2) END AS urgency_score, CASE WHEN full_ok THEN CAST(json_array_length(ec) AS BIGINT) END AS error_codes, full_ok AS ok FROM enr_ok""")
    o["e2_e3_merge_fallback"] = w(["enr"], f"SELECT {_ENR_COLS} FROM enr")
    o["e4_entity_counts"] = w(["enr"], """
SELECT kind, value, count(*) AS mentions FROM (
 SELECT 'product_names' AS kind, unnest(CAST(pn AS VARCHAR[])) AS value FROM enr WHERE full_ok
 UNION ALL SELECT 'error_codes', unnest(CAST(ec AS VARCHAR[])) FROM enr WHERE full_ok) x GROUP BY kind, value""")
    o["e5_resume"] = w(["enr", "repeats"], f"""
SELECT e.row_seq, CASE WHEN redo THEN 'positive' ELSE sentiment END AS sentiment, CASE WHEN redo THEN 1.0::DOUBLE ELSE sentiment_confidence END AS sentiment_confidence,
 entities_json, CASE WHEN redo THEN 'Again' ELSE summary END AS summary, CASE WHEN redo THEN 0.25::DOUBLE ELSE urgency_score END AS urgency_score,
 CASE WHEN redo THEN concat('second run ', CAST(e.row_seq AS VARCHAR)) ELSE urgency_reason END AS urgency_reason, enrichment_failed AND NOT redo AS enrichment_failed, repeat_contact
FROM (SELECT *, enrichment_failed AND row_seq % 3 <> 0 AS redo FROM enr) e JOIN (SELECT row_seq, repeat_contact FROM repeats) r ON e.row_seq = r.row_seq""")
    o["e6_repeat_contact"] = w(["repeats"], "SELECT row_seq, customer_id, repeat_contact FROM repeats")
    o["e6_repeat_orders"] = "SELECT o_orderkey AS row_seq, o_custkey, count(*) OVER (PARTITION BY o_custkey) >= 10 AS repeat_contact FROM orders"
    o["e7_enrichment_report"] = w(["enr", "repeats"], _tally("enr", [
        ("totals", "total", "count(*)"), ("totals", "enriched", _cnt("NOT enrichment_failed")), ("totals", "failed", _cnt("enrichment_failed")),
        ("totals", "enrichment_failed_pct", "round(count(*) FILTER (enrichment_failed) / count(*)::DOUBLE, 4)"),
        *[("sentiment_distribution", v, _cnt(f"sentiment = '{v}'")) for v in ("positive", "neutral", "negative", "frustrated")],
        ("urgency_distribution", "low (0.0-0.3)", _cnt("urgency_score <= 0.3::DOUBLE")),
        ("urgency_distribution", "medium (0.4-0.6)", _cnt("urgency_score > 0.3::DOUBLE AND urgency_score <= 0.6::DOUBLE")),
        ("urgency_distribution", "high (0.7-1.0)", _cnt("urgency_score > 0.6::DOUBLE"))])
        + " UNION ALL " + _tally("repeats", [("totals", "repeat_contacts", _cnt("repeat_contact"))])
        + " UNION ALL " + _tally("(SELECT * FROM enr WHERE full_ok OR simple_ok) u", [
            ("totals", "tokens_used", "sum(input_tokens + output_tokens)"),
            ("totals", "cost_usd", "round(" + " + ".join(
                f"coalesce(sum({t}) FILTER ({p}), 0)::DOUBLE / 1000000 * {c}::DOUBLE" for p, t, c in (
                    ("full_ok", "input_tokens", 0.8), ("full_ok", "output_tokens", 4.0),
                    ("NOT full_ok", "input_tokens", 3.0), ("NOT full_ok", "output_tokens", 15.0))) + ", 4)"),
            ("totals", "cache_hit_rate", "round(sum(cache_read_tokens) FILTER (full_ok)::DOUBLE / (sum(input_tokens) FILTER (full_ok) + sum(cache_read_tokens) FILTER (full_ok))::DOUBLE, 4)")]))
    o["e8_usage_by_model"] = w(["enr"], """
SELECT CASE WHEN full_ok THEN 'small' ELSE 'large' END AS model, count(*) AS replies, CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens,
 CAST(sum(CASE WHEN full_ok THEN cache_read_tokens ELSE 0 END) AS BIGINT) AS cache_read_tokens FROM enr WHERE full_ok OR simple_ok GROUP BY 1""")

    o["f1_length_spike"] = w(["norm", "lengths"], "SELECT row_seq, coalesce(k >= 2 AND length(body) > m + 3.0::DOUBLE * s, false) AS body_length_spike FROM norm CROSS JOIN lengths")
    o["f1_documents_spike"] = "SELECT doc_id, length(text) > m + 3.0::DOUBLE * s AS spike FROM documents, (SELECT avg(length(text)) AS m, stddev_samp(length(text)) AS s FROM documents) q"
    o["f2_f6_anomaly_flags"] = w(["aflags"], "SELECT row_seq, statistical_flags FROM aflags")
    o["f5_documents_duplicates"] = r"""
SELECT row_seq, length(key) > 20 AND count(*) OVER (PARTITION BY key) >= 2 AS duplicate_body FROM
(SELECT doc_id AS row_seq, regexp_replace(lower(regexp_replace(text, '^\s+|\s+$', '', 'g')), '\s+', ' ', 'g') AS key FROM documents) x"""
    o["f7_candidates"] = w(["cands"], "SELECT row_seq, ticket_id, statistical_flags FROM cands")
    o["f7_candidates_by_row"] = w(["aflags"], "SELECT row_seq, ticket_id, statistical_flags FROM aflags WHERE statistical_flags <> ''")
    o["f8_first_duplicate"] = w(["chosen"], "SELECT row_seq, statistical_flags, body IS NOT NULL AS has_body FROM chosen")
    o["f9_statistical_only"] = w(["statonly"], "SELECT * FROM statonly")
    o["f10_anomaly_input"] = w(["chosen"], """
SELECT row_seq, concat('Ticket ', ticket_id, chr(10), 'Subject line: ', coalesce(subject, ''), chr(10), 'Beginning of the text: ', substr(body, 1, 500), chr(10),
 'Mood: ', coalesce(sentiment, ''), chr(10), 'Assigned category: ', coalesce(llm_category, ''), chr(10), 'Flags raised: ', replace(statistical_flags, '|', ', ')) AS prompt
FROM chosen WHERE body IS NOT NULL""")
    o["f11_merge_verdict"] = w(["scored"], "SELECT * FROM scored")
    o["f12_anomalies"] = w(["anom"], "SELECT * FROM anom")
    o["f13_threshold_sensitivity"] = w(["norm"], _sensitivity("norm", "body"))
    o["f13_documents_sensitivity"] = _sensitivity("documents", "text")
    o["f14_anomaly_summary"] = w(["anom", "norm"], """
SELECT 'by_type' AS section, anomaly_type AS name, count(*) AS value FROM anom GROUP BY 2 UNION ALL SELECT 'by_severity', severity, count(*) FROM anom GROUP BY 2
UNION ALL SELECT 'totals', 'total_tickets', count(*) FROM norm UNION ALL SELECT 'totals', 'anomalies_found', count(*) FROM anom
UNION ALL SELECT 'totals', 'scored', count(*) FROM anom WHERE detection_method = 'hybrid'""")
    o["f15_alerts"] = w(["anom"], """
SELECT ticket_id, anomaly_type, severity, reason, recommended_action, CASE recommended_action WHEN 'escalate' THEN 'slack' WHEN 'create_task' THEN 'email' ELSE 'monitor' END AS alert_channel,
 concat('HIGH anomaly: ticket ', ticket_id, ' — ', anomaly_type, '. Action: ', recommended_action, '. Reason: ', reason) AS message FROM anom WHERE severity = 'high'""")
    o["f16_anomaly_trend"] = w(["anom"], """
SELECT 'anomalies_found' AS name, (SELECT count(*) FROM anom) - (SELECT count(*) FROM anom WHERE severity <> 'low') AS delta
UNION ALL SELECT concat('type:', anomaly_type), count(*) FILTER (severity = 'low') FROM anom GROUP BY anomaly_type HAVING count(*) FILTER (severity = 'low') <> 0""")

    o["g1_check_calls"] = w(["calls", "given", "catalogue"], """
SELECT c.call_id, any_value(c.tool) AS tool, CASE WHEN count(k.tool) = 0 THEN concat('Error: tool ', chr(39), any_value(c.tool), chr(39), ' not found')
 WHEN count(*) FILTER (g.arg IS NULL) > 0 THEN concat('missing: ', string_agg(k.arg, ',' ORDER BY k.k) FILTER (g.arg IS NULL))
 WHEN count(*) FILTER (k.allowed IS NOT NULL AND NOT list_contains(k.allowed, g.chosen)) > 0
  THEN concat('not allowed: ', string_agg(k.arg, ',' ORDER BY k.k) FILTER (k.allowed IS NOT NULL AND NOT list_contains(k.allowed, g.chosen))) END AS call_error
FROM calls c LEFT JOIN catalogue k ON k.tool = c.tool LEFT JOIN given g ON g.call_id = c.call_id AND g.arg = k.arg GROUP BY c.call_id""")
    o["g2_pending"] = w(["ran"], f"SELECT call_id, ticket_id, tool, anomaly_type FROM ran WHERE {_WAIT}")
    o["g2_actions"] = w(["ran"], f"SELECT call_id, tool FROM ran WHERE NOT {_WAIT}")
    o["g3_customer_history"] = w(["norm"], f"""
SELECT customer_id, count(*) AS prior_tickets, count(*) FILTER (status = 'open') AS open_tickets, count(*) FILTER (status = 'closed') AS closed_tickets,
 count(*) FILTER (status = 'pending') AS pending_tickets, date_diff('day', max(created_at), {AS_OF}) AS days_since_contact
FROM norm WHERE customer_id IS NOT NULL AND coalesce(created_at <= {AS_OF}, true) GROUP BY customer_id""")
    o["g4_apply_status"] = w(["norm", "updates"], "SELECT n.row_seq, n.ticket_id, coalesce(u.new_status, n.status) AS status FROM norm n LEFT JOIN updates u ON n.ticket_id = u.ticket_id")
    o["g4_status_at"] = w(["status_changes"], """
SELECT m.event_id AS moment_id, m.ticket_id, coalesce(u.new_status, f.status) AS status FROM status_changes m
ASOF LEFT JOIN (SELECT ticket_id, ts, arg_max(new_status, event_id) AS new_status FROM status_changes WHERE event_type = 'purchase' AND new_status <> 'reopened'
 GROUP BY 1, 2) u ON m.ticket_id = u.ticket_id AND m.ts >= u.ts
LEFT JOIN (SELECT ticket_id, arg_max(status, row_seq) AS status FROM norm GROUP BY 1) f ON f.ticket_id = m.ticket_id
WHERE m.event_type = 'error'""")
    o["g5_cap_steps"] = w(["calls"], "SELECT call_id, anomaly_id, step FROM (SELECT *, dense_rank() OVER (PARTITION BY anomaly_id ORDER BY step) AS r FROM calls) x WHERE r <= 10")
    o["g6_estimate_tokens"] = "SELECT conv_id, CAST(sum(length(text)) // 4 AS BIGINT) AS estimated_tokens FROM conversations GROUP BY conv_id"
    o["g7_trim_context"] = """
WITH s AS (SELECT *, count(*) OVER (PARTITION BY conv_id) AS n, sum(length(text)) OVER (PARTITION BY conv_id) // 4 > 300 AS big,
 row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS a, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS z FROM conversations)
SELECT conv_id, turn, role, text, false AS is_marker FROM s WHERE NOT big OR n <= 5 OR a = 1 OR z <= 4
UNION ALL SELECT conv_id, turn, 'user', '[Earlier turns summarized for context length management]', true FROM s WHERE big AND a = 1"""
    tools = ("escalate_ticket", "send_alert", "create_task", "auto_respond", "get_ticket_history", "update_ticket_status")
    o["g8_action_summary"] = w(["ran"], _tally("ran", [
        ("totals", "total_tool_calls", "count(*)"), ("totals", "actions_taken", _cnt(f"NOT {_WAIT}")), ("totals", "pending_approval", _cnt(_WAIT)),
        *[("tool_distribution", t, _cnt(f"tool = '{t}' AND NOT {_WAIT}")) for t in tools],
        ("totals", "anomalies_processed", "max((SELECT count(DISTINCT anomaly_id) FROM calls))"),
        ("totals", "avg_tool_calls_per_anomaly", "round(count(*)::DOUBLE / max((SELECT count(DISTINCT anomaly_id) FROM calls))::DOUBLE, 2)"),
        ("totals", "context_truncations", "max((SELECT count(*) FROM (SELECT conv_id FROM conversations GROUP BY conv_id HAVING sum(length(text)) // 4 > 300) t))")]))
    o["g9_journal"] = w(["calls", "steps"], """
SELECT s.anomaly_id, s.step, c.tool AS tool_called, c.call_id AS tool_use_id, s.stop_reason FROM steps s
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY anomaly_id, step ORDER BY pos) AS k FROM calls) c ON c.anomaly_id = s.anomaly_id AND c.step = s.step AND c.k = 1""")

    o["h1_run_metrics"] = w(["norm", "anom", "ran"], f"""
SELECT 'r1' AS run_id, '2024-02-01T00:00:00Z' AS timestamp, 'success' AS pipeline_status, CAST(1200 AS BIGINT) AS total_duration_ms,
 (SELECT count(*) FROM tickets) AS records_ingested, (SELECT count(*) FROM norm) AS records_validated,
 (SELECT count(*) FROM ({_report('norm', NINE)}) q WHERE NOT passed) AS quality_checks_failed, (SELECT count(*) FROM anom) AS anomalies_found,
 (SELECT count(*) FROM ran WHERE NOT {_WAIT}) AS agent_actions_taken""")
    o["h2_last_runs"] = "SELECT concat('run-', lpad(CAST(o_orderkey AS VARCHAR), 12, '0')) AS run_id, strftime(o_orderdate, '%Y-%m-%d') AS timestamp, o_custkey AS records_ingested FROM orders ORDER BY 2 DESC, 1 DESC LIMIT 10"
    o["h3_freshness"] = """
SELECT x.name, CASE WHEN m IS NULL THEN x.miss WHEN age > 0.25::DOUBLE THEN 'degraded' ELSE 'ok' END AS status, round(age, 1) AS age_hours,
 CASE max(CASE WHEN m IS NULL THEN CASE x.miss WHEN 'failed' THEN 2 ELSE 1 END WHEN age > 0.25::DOUBLE THEN 1 ELSE 0 END) OVER () WHEN 2 THEN 'failed' WHEN 1 THEN 'degraded' ELSE 'ok' END AS overall
FROM (VALUES ('view','failed'),('click','failed'),('error','degraded'),('purchase','degraded'),('signup','degraded'),('refund','degraded')) x(name, miss)
LEFT JOIN (SELECT event_type, max(ts) AS m, (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(ts)))::DOUBLE / 3600000000.0::DOUBLE AS age FROM events GROUP BY 1) e ON x.name = e.event_type"""

    o["i1_ticket_lifecycles"] = """
WITH e AS (
 SELECT user_id AS ticket, epoch_us(ts) AS us, event_id, event_type = 'purchase' AS closes FROM events WHERE event_type IN ('error', 'purchase')
), w AS (SELECT max(us) // 1000 * 1000 - 3600000000 AS passed FROM e
), n AS (
 SELECT e.*, lead(us) OVER o AS next_us, lead(closes) OVER o AS next_closes FROM e, w WHERE us <= passed WINDOW o AS (PARTITION BY ticket ORDER BY us, event_id)
)
SELECT ticket, us AS opened_us, least(us + 21600000000, coalesce(next_us, us + 21600000000)) AS ended_us,
 CASE WHEN next_us <= us + 21600000000 THEN CASE WHEN next_closes THEN 'closed' ELSE 'reopened' END ELSE 'expired' END AS outcome
FROM n, w WHERE NOT closes AND (next_us IS NOT NULL OR us + 21600000000 <= passed)"""
    o["i2_asof_orders"] = """
WITH e AS (
 SELECT event_id, user_id, make_timestamp(788918400000000 + 80 * (epoch_us(ts) - 1704067200000000)) AS at FROM events
), r AS (
 SELECT o_custkey, o_orderdate, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY 1, 2
)
SELECT event_id, user_id, o_orderkey, o_totalprice FROM e ASOF LEFT JOIN r ON e.user_id = r.o_custkey AND e.at >= r.o_orderdate"""
    o["i3_incident_tickets"] = """
WITH i AS (
 SELECT event_id, ts AS begins, ts + to_minutes(CASE WHEN event_id % 250 = 0 THEN 28800 ELSE CAST(floor(value) AS BIGINT) END) AS ends
 FROM events WHERE event_type = 'error'
)
SELECT i.event_id AS incident_id, count(*) AS n_tickets, min(e.event_id) AS first_ticket, max(e.event_id) AS last_ticket
FROM i JOIN events e ON e.ts >= i.begins AND (e.ts < i.ends OR e.ts = i.begins) GROUP BY 1"""
    o["i4_contact_gaps"] = """
WITH c AS (SELECT event_id AS row_seq, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS customer_id, ts FROM events)
SELECT row_seq, customer_id, row_number() OVER o AS contact_no, epoch_us(ts) - epoch_us(lag(ts) OVER o) AS gap_us
FROM c WINDOW o AS (PARTITION BY customer_id ORDER BY ts, row_seq)"""
    o["i5_ticket_cube"] = w(["norm"], """
SELECT channel, status, priority, CAST(grouping(channel, status, priority) AS BIGINT) AS grouping_id, count(*) AS n, CAST(sum(length(body)) AS BIGINT) AS chars_sum,
 avg(length(body)) AS chars_mean, min(length(body)) AS chars_min, max(length(body)) AS chars_max
FROM norm GROUP BY CUBE (channel, status, priority)""")
    o["i5_anomaly_rollup"] = w(["anom"], """
SELECT CASE WHEN grouping(anomaly_type) = 1 THEN '(all)' ELSE coalesce(anomaly_type, '(none)') END AS anomaly_type,
 CASE WHEN grouping(severity) = 1 THEN '(all)' ELSE coalesce(severity, '(none)') END AS severity,
 CAST(grouping(anomaly_type, severity) AS BIGINT) AS grouping_id, count(*) AS n
FROM anom GROUP BY ROLLUP (anomaly_type, severity)""")
    o["i6_run_difference"] = w(["net_keys"], """
SELECT ticket_id, CAST(more - least(more, fewer) AS BIGINT) AS n_added, CAST(fewer - least(more, fewer) AS BIGINT) AS n_removed,
 CAST(least(more, fewer) AS BIGINT) AS n_changed FROM net_keys""")
    o["i7_sketch_thresholds"] = w(["norm"], """
SELECT channel, count(*) AS n, count(body) AS n_chars, true AS median_in_bound, true AS p95_in_bound, true AS customers_in_bound FROM norm GROUP BY channel""")
    o["i8_replay"] = """
WITH RECURSIVE t AS (
 SELECT conv_id, turn, role, length(text) AS size, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations
), r(conv_id, turn, k, step, turn_of_step, context_chars, trimmed) AS (
 SELECT conv_id, turn, k, CASE WHEN role = 'user' THEN 1 ELSE 0 END, 1, size, size // 4 > 300 FROM t WHERE k = 1
 UNION ALL
 SELECT t.conv_id, t.turn, t.k, r.step + CASE WHEN t.role = 'user' THEN 1 ELSE 0 END, CASE WHEN t.role = 'user' THEN 1 ELSE r.turn_of_step + 1 END,
  CASE WHEN (r.context_chars + t.size) // 4 > 300 THEN t.size ELSE r.context_chars + t.size END, (r.context_chars + t.size) // 4 > 300
 FROM r JOIN t ON t.conv_id = r.conv_id AND t.k = r.k + 1
)
SELECT conv_id, turn, CAST(step AS BIGINT) AS step, CAST(turn_of_step AS BIGINT) AS turn_of_step, CAST(context_chars AS BIGINT) AS context_chars,
 CAST(context_chars // 4 AS BIGINT) AS context_tokens, trimmed FROM r"""
    o["i9_byte_ranges"] = w(["tickets"], f"""
SELECT row_seq AS src_seq, CASE WHEN ticket_id NOT IN ({NA}) THEN ticket_id END AS ticket_id, CASE WHEN status = 'open' THEN customer_id END AS customer_id,
 CASE WHEN status = 'open' THEN channel END AS channel, status, CASE WHEN status <> 'open' AND priority NOT IN ({NA}) THEN priority END AS priority FROM tickets""")
    o["i10_incremental_counts"] = """
SELECT user_id, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents, count(*) >= 3 AS repeat_contact
FROM events WHERE NOT (event_id % 10 < 9 AND event_id % 7 = 0) GROUP BY user_id"""
    return o
