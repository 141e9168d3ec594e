"""Names and value sets of the ticket tables.

Everything below is a fixed value of the data contract.
"""

TICKET_COLUMNS = [
    "ticket_id", "created_at", "customer_id", "channel", "subject",
    "body", "priority", "category", "status", "agent_id",
]

CHANNELS = ["email", "chat", "phone", "web"]
PRIORITIES = ["low", "medium", "high", "critical"]
STATUSES = ["open", "closed", "pending"]
CATEGORIES = ["billing", "technical", "general", "other"]
SENTIMENTS = ["positive", "neutral", "negative", "frustrated"]
UNKNOWN = "unknown"

SCHEMA_VERSION = "1.0"

UUID4 = r"[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}"

# Dollars per million tokens: tier -> (input, output).
PRICES = {1: (0.80, 4.00), 2: (3.00, 15.00)}
MODEL_PRICES = {"small": PRICES[1], "large": PRICES[2]}

REVIEW_BELOW = 0.70
ACCEPT_TIER2_FROM = 0.85

URGENCY_DEFAULT = 0.5
URGENCY_DEFAULT_REASON = "Classification failed; manual review required"
ENTITY_LISTS = ["product_names", "error_codes", "account_ids"]

ANOMALY_TYPES = [
    "body_length_spike", "frustrated_sentiment", "unclassified",
    "potential_incident", "repeat_frustrated", "duplicate_body",
]
SEVERITIES = ["low", "medium", "high"]
VERDICT_ACTIONS = ["escalate", "auto_respond", "create_task", "monitor"]
ANOMALY_COLUMNS = [
    "ticket_id", "statistical_flags", "anomaly_type", "severity",
    "reason", "recommended_action", "detection_method",
]

# Tool -> required arguments, and (tool, argument) -> allowed values.
TOOL_ARGUMENTS = {
    "escalate_ticket": ["ticket_id", "reason", "severity"],
    "send_alert": ["message", "channel"],
    "create_task": ["title", "description", "assignee"],
    "auto_respond": ["ticket_id", "response_template"],
    "get_ticket_history": ["customer_id"],
    "update_ticket_status": ["ticket_id", "new_status", "reason"],
}
TOOL_CHOICES = {
    ("escalate_ticket", "severity"): ["low", "medium", "high"],
    ("send_alert", "channel"): ["slack", "email", "pagerduty"],
    ("create_task", "assignee"): ["tier1", "tier2", "billing_team", "engineering"],
    ("auto_respond", "response_template"): [
        "acknowledge_delay", "sla_commitment", "escalation_notice", "general_thanks",
    ],
    ("update_ticket_status", "new_status"): ["open", "pending", "closed"],
}
# Sentences of the anomaly and alert tables.
REASON_NO_BODY = "Ticket body is null; statistical flag only"
REASON_NO_VERDICT = "Classification failed"
ALERT_TEXT = "HIGH anomaly: ticket %s — %s. Action: %s. Reason: %s"
TRIM_MARKER = "[Earlier turns summarized for context length management]"

# Cell texts that mean "no value" in a CSV file.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]
