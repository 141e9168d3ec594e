"""Fixture views, as text that Spark and DuckDB both run.

They give the ticket, reply and tool-call shapes over the provided tables.
"""

# One ticket per document. Every order and every event counts: they are dealt to documents by their
# number modulo the number of documents, and sums over a document's share decide its fields.
TICKETS = """
SELECT d.doc_id AS row_seq,
 CASE WHEN d.doc_id % 29 = 7 THEN concat('bad-', CAST(d.doc_id AS VARCHAR(20)))
      ELSE concat('00000000-0000-4000-8000-', lpad(CAST(CASE WHEN d.doc_id % 31 = 3 THEN d.doc_id - 1 ELSE d.doc_id END AS VARCHAR(20)), 12, '0')) END AS ticket_id,
 CASE WHEN d.doc_id % 50 = 11 THEN 'yesterday' WHEN d.doc_id % 50 = 23 THEN '31/02/2024' WHEN d.doc_id % 50 = 31 THEN '2099-01-01T00:00:00' ELSE CAST(e.ts AS VARCHAR(40)) END AS created_at,
 concat(' cust-', CAST(CAST(floor(o.customers % n.docs / 2.0) AS BIGINT) AS VARCHAR(20)), ' ') AS customer_id,
 CASE e.kinds % 5 WHEN 0 THEN ' Web ' WHEN 1 THEN 'CHAT' WHEN 2 THEN 'email' WHEN 3 THEN 'phone' ELSE 'fax' END AS channel,
 CASE WHEN d.doc_id % 20 = 4 THEN '  ' WHEN d.doc_id % 20 = 9 THEN NULL ELSE concat(d.source, ' ', d.lang, ' ', CAST(d.n_chars AS VARCHAR(20))) END AS subject,
 CASE WHEN d.doc_id % 17 = 5 THEN NULL WHEN d.doc_id % 40 = 1 THEN '<br>' WHEN d.doc_id % 7 = 0 THEN concat('<p>', d.text, '</p>') ELSE d.text END AS body,
 CASE o.urgencies % 5 WHEN 0 THEN 'Critical' WHEN 1 THEN 'high' WHEN 2 THEN ' medium' WHEN 3 THEN 'low' ELSE '' END AS priority,
 CASE d.lang WHEN 'en' THEN 'Billing' WHEN 'fr' THEN 'technical' WHEN 'de' THEN 'general' ELSE 'legal' END AS category,
 CASE o.states % 3 WHEN 0 THEN 'open' WHEN 1 THEN 'Closed' ELSE 'pending' END AS status,
 CASE WHEN d.doc_id % 13 = 0 THEN NULL ELSE concat('agent-', CAST(o.customers % 20 AS VARCHAR(20))) END AS agent_id,
 CASE WHEN l.toxic = 1 THEN 'frustrated' WHEN l.quality = 0 THEN 'negative' WHEN l.quality = 1 THEN 'neutral' END AS sentiment,
 CASE WHEN d.doc_id % 23 = 0 THEN 'unknown' ELSE 'billing' END AS llm_category
FROM documents d CROSS JOIN (SELECT greatest(count(*), 1) AS docs FROM documents) n
LEFT JOIN (SELECT o_orderkey % c.docs AS share, sum(o_custkey) AS customers, count(*) AS orders,
  sum(CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 WHEN '5-LOW' THEN 3 ELSE 4 END) AS urgencies,
  sum(CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'F' THEN 1 ELSE 2 END) AS states
 FROM orders CROSS JOIN (SELECT greatest(count(*), 1) AS docs FROM documents) c GROUP BY o_orderkey % c.docs) o ON o.share = d.doc_id
LEFT JOIN (SELECT event_id % c.docs AS share, max(ts) AS ts, count(*) AS events,
  sum(CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3 ELSE 4 END) AS kinds
 FROM events CROSS JOIN (SELECT greatest(count(*), 1) AS docs FROM documents) c GROUP BY event_id % c.docs) e ON e.share = d.doc_id
LEFT JOIN labels l ON l.doc_id = d.doc_id
"""

# Two tiers of classification replies per ticket: valid, fenced, broken, refused.
RESPONSES = """
SELECT row_seq, tier,
 CASE WHEN (row_seq + tier) % 41 = 0 THEN 'not json {{{'
      WHEN (row_seq + tier) % 19 = 0 THEN concat('```json', chr(10), js, chr(10), '```') ELSE js END AS raw_text,
 CASE WHEN (row_seq + tier) % 97 = 0 THEN 'refusal' ELSE 'end_turn' END AS stop_reason,
 CAST(50 + row_seq % 70 AS BIGINT) AS input_tokens, CAST(10 + row_seq % 9 AS BIGINT) AS output_tokens, CAST(row_seq % 5 AS BIGINT) AS cache_read_tokens
FROM (SELECT t.row_seq, k.tier, concat('{"category": "', CASE t.row_seq % 9 WHEN 0 THEN 'billing' WHEN 1 THEN 'technical' WHEN 2 THEN 'general' WHEN 3 THEN 'refund' ELSE 'other' END,
   '", "priority": "', CASE t.row_seq % 4 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' ELSE 'critical' END,
   '", "confidence": ', CASE WHEN t.row_seq % 53 = 7 THEN '1.40' ELSE concat('0.', lpad(CAST((t.row_seq * 37 + k.tier * 11) % 100 AS VARCHAR(20)), 2, '0')) END, '}') AS js
  FROM tickets t CROSS JOIN (SELECT 1 AS tier UNION ALL SELECT 2 AS tier) k) x
"""

# Full and simple enrichment replies. Some full replies break one rule each.
ENRICHMENTS = """
SELECT t.row_seq,
 CASE WHEN t.row_seq % 37 = 0 THEN 'no json here'
      ELSE concat('{"sentiment": "', CASE WHEN t.row_seq % 31 = 4 THEN 'angry' ELSE CASE t.row_seq % 4 WHEN 0 THEN 'positive' WHEN 1 THEN 'neutral' WHEN 2 THEN 'negative' ELSE 'frustrated' END END,
        '", "sentiment_confidence": ', CASE WHEN t.row_seq % 43 = 5 THEN '7' ELSE concat('"0.', lpad(CAST(t.row_seq * 7 % 1000 AS VARCHAR(20)), 3, '0'), '"') END,
        ', "entities": {"product_names": ["p', CAST(t.row_seq % 6 AS VARCHAR(20)), '"]',
          CASE WHEN t.row_seq % 3 = 0 THEN concat(', "error_codes": ["E', CAST(t.row_seq % 11 AS VARCHAR(20)), '", "E', CAST(t.row_seq % 5 AS VARCHAR(20)), '"]') ELSE '' END,
          CASE WHEN t.row_seq % 47 = 6 THEN ', "account_ids": [12]' ELSE '' END, '}',
        ', "summary": "', CASE WHEN t.row_seq % 29 = 3 THEN '  ' ELSE concat(' Ticket ', CAST(t.row_seq AS VARCHAR(20)), ' was raised. ') END,
        '", "urgency_score": 0.', lpad(CAST(t.row_seq * 13 % 100 AS VARCHAR(20)), 2, '0'),
        ', "urgency_reason": "Reason ', CAST(t.row_seq % 8 AS VARCHAR(20)), '"}') END AS full_text,
 CASE WHEN t.row_seq % 101 = 9 THEN 'refusal' ELSE 'end_turn' END AS full_stop,
 CASE WHEN t.row_seq % 2 = 0 THEN concat('{"sentiment": "neutral", "summary": "Short ', CAST(t.row_seq AS VARCHAR(20)), '"}') ELSE '{"sentiment": "neutral"}' END AS simple_text,
 CAST(200 + t.row_seq % 90 AS BIGINT) AS input_tokens, CAST(60 + t.row_seq % 30 AS BIGINT) AS output_tokens, CAST(t.row_seq % 7 AS BIGINT) AS cache_read_tokens
FROM tickets t
"""

# Verdict replies for every ticket; candidates pick theirs by row_seq.
VERDICTS = """
SELECT t.row_seq,
 CASE WHEN t.row_seq % 11 = 0 THEN '{"anomaly_type": "duplicate_body"'
      ELSE concat('{"anomaly_type": "', CASE t.row_seq % 5 WHEN 0 THEN 'potential_incident' WHEN 1 THEN 'frustrated_sentiment' WHEN 2 THEN 'duplicate_body' WHEN 3 THEN 'weird' ELSE 'unclassified' END,
        '", "severity": "', CASE t.row_seq % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END,
        '", "reason": " Seen in ticket ', CAST(t.row_seq AS VARCHAR(20)), ' ", "recommended_action": "',
        CASE t.row_seq % 4 WHEN 0 THEN 'escalate' WHEN 1 THEN 'create_task' WHEN 2 THEN 'auto_respond' ELSE 'monitor' END, '"}') END AS raw_text,
 'end_turn' AS stop_reason
FROM tickets t
"""

# Steps of the runs: those with calls, as their first call says, and a closing step without one.
STEPS = """
SELECT anomaly_id, step, stop_reason FROM (
 SELECT anomaly_id, step, stop_reason, row_number() OVER (PARTITION BY anomaly_id, step ORDER BY pos) AS k FROM calls) x WHERE k = 1
UNION ALL SELECT anomaly_id, max(step) + 1, 'end_turn' FROM calls GROUP BY anomaly_id
"""

# Tool calls, several per step; steps follow the event number.
TOOL_CALLS = """
SELECT event_id AS call_id, user_id AS anomaly_id, CAST(floor(event_id / 500.0) AS BIGINT) + 1 AS step, event_id AS pos,
 CASE event_type WHEN 'view' THEN 'get_ticket_history' WHEN 'click' THEN 'send_alert' WHEN 'error' THEN 'escalate_ticket' WHEN 'purchase' THEN 'update_ticket_status' ELSE CASE WHEN event_id % 2 = 0 THEN 'hallucinated_tool' ELSE 'create_task' END END AS tool,
 CASE event_id % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS severity,
 CASE event_id % 4 WHEN 0 THEN 'open' WHEN 1 THEN 'pending' WHEN 2 THEN 'closed' ELSE 'reopened' END AS new_status,
 concat('00000000-0000-4000-8000-', lpad(CAST(event_id % 500 AS VARCHAR(20)), 12, '0')) AS ticket_id,
 CASE event_id % 2 WHEN 0 THEN 'duplicate_body' ELSE 'unclassified' END AS anomaly_type,
 CASE WHEN event_id % 40 = 5 THEN 'end_turn' ELSE 'tool_use' END AS stop_reason
FROM events
"""
