"""Statistical anomaly flags, candidates, verdicts, alerts and trends.

Flags are computed on a narrow frame (ids, lengths, 32-byte fingerprints): ticket
bodies are read once and never shuffled for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidedesk.functions.replies import VERDICT, parse_replies
from tidedesk.functions.text import collapse, fingerprint, folded
from tidedesk.operators.enrich import repeat_contact
from tidedesk.operators.keyed import attach_by_key, count_by_key
from tidedesk.operators.quality import join_flags
from tidedesk.operators.scoring import tally
from tidedesk.schema import ALERT_TEXT, ANOMALY_COLUMNS, REASON_NO_BODY, REASON_NO_VERDICT, UNKNOWN
from tidedesk.session import materialize

# Fixed values.
SPIKE_Z = 3.0
SENSITIVITY_ZS = [2.0, 2.5, 3.0]
DUPLICATE_MIN = 20
PREVIEW = 500


def length_stats(df: DataFrame, text: str = "body") -> DataFrame:
    """One row: mean, sample deviation and number of the text lengths."""
    return _stats_of(df, F.length(text))


def _stats_of(df: DataFrame, n: Column) -> DataFrame:
    return df.agg(
        F.avg(n).alias("mean_len"), F.stddev_samp(n).alias("std_len"), F.count(n).alias("n_len")
    )


def _above(length: Column, z: Column | float) -> Column:
    z = z if isinstance(z, Column) else F.lit(z)
    return F.coalesce(
        (F.col("n_len") >= 2) & (length > F.col("mean_len") + z * F.col("std_len")), F.lit(False)
    )


def length_spike(df: DataFrame, z: float = SPIKE_Z, text: str = "body",
                 flag: str = "body_length_spike") -> DataFrame:
    """Add ``flag``: the text is longer than mean + z sample deviations.

    The statistics are one row, so the join is a broadcast of one row.
    """
    return (
        df.crossJoin(F.broadcast(length_stats(df, text)))
        .withColumn(flag, _above(F.length(text), z))
        .drop("mean_len", "std_len", "n_len")
    )


def duplicate_body(df: DataFrame, text: str = "body", order: str = "row_seq",
                   flag: str = "duplicate_body") -> DataFrame:
    """``(order, flag)`` per row: another row has the same text after folding.

    Folding lowers case and collapses white space; texts of 20 characters or
    fewer, and nulls, never count. Fingerprints are written down once; the texts
    are not read again for the count and the join.
    """
    keyed = df.select(order, folded(F.col(text)).alias("_folded")).withColumn(
        "_key", collapse(F.col("_folded")))
    prints = materialize(keyed.select(order, _duplicate_print().alias("_fp")), "fingerprints")
    return _flag_repeated(prints, order, flag).drop("_fp")


def _duplicate_print() -> Column:
    """Fingerprint of ``_key``, for texts long enough to count."""
    return F.when(F.length("_key") > DUPLICATE_MIN, fingerprint(F.col("_key")))


def _flag_repeated(rows: DataFrame, order: str, flag: str) -> DataFrame:
    counts = count_by_key(rows, "_fp").withColumn(flag, F.col("n") >= 2)
    return attach_by_key(rows, "_fp", counts, [flag], spread=order, keep=F.col(flag)).withColumn(
        flag, F.coalesce(flag, F.lit(False))
    )


def threshold_sensitivity(df: DataFrame, zs: list[float] = SENSITIVITY_ZS,
                          text: str = "body") -> DataFrame:
    """``(z, flagged, pct_of_total)``; the share is of all rows, nulls included."""
    n = F.length(text)
    counts = (
        df.select(n.alias("_len")).crossJoin(F.broadcast(length_stats(df, text)))
        .agg(F.count("*").alias("total"),
             *[F.count_if(_above(F.col("_len"), z)).alias(f"z{i}") for i, z in enumerate(zs)])
    )
    return counts.select("total", F.explode(F.array(*[
        F.struct(F.lit(float(z)).alias("z"), F.col(f"z{i}").alias("flagged")) for i, z in enumerate(zs)
    ])).alias("c")).select(
        "c.z", "c.flagged",
        F.coalesce(F.round(F.col("c.flagged") / F.nullif(F.col("total"), F.lit(0)), 3), F.lit(0.0))
        .alias("pct_of_total"),
    )


def anomaly_flags(df: DataFrame, z: float = SPIKE_Z, contacts: bool = False) -> DataFrame:
    """One narrow row per ticket: ``row_seq, ticket_id, has_body, body_key, statistical_flags``.

    ``body_key`` is the fingerprint used later to keep the first of equal bodies;
    it does not collapse white space, unlike the one behind ``duplicate_body``.

    Lengths and fingerprints are written to the scratch folder first, so the bodies
    are read once however often the later steps come back to them. With ``contacts``,
    repeated customers are counted on those narrow rows; otherwise a column
    ``repeat_contact`` is used if there is one.
    """
    none = F.lit(False)
    mood = F.col("sentiment")
    given = "repeat_contact" in df.columns and not contacts
    repeat = F.coalesce(F.col("repeat_contact"), none) if given else F.lit(contacts)
    # Each folded text is a column of its own: used twice, computed once.
    texts = df.withColumn("_folded", folded(F.col("body"))).withColumn("_key", collapse(F.col("_folded")))
    narrow = materialize(texts.select(
        "row_seq",
        F.coalesce(F.col("ticket_id").cast("string"), F.lit("None")).alias("ticket_id"),
        F.length("body").alias("_len"),
        F.coalesce(mood == "frustrated", none).alias("_frustrated"),
        F.coalesce(F.col("llm_category") == UNKNOWN, none).alias("_unclassified"),
        (repeat & F.coalesce(mood.isin("frustrated", "negative"), none)).alias("_repeat"),
        _duplicate_print().alias("_fp"),
        fingerprint(F.col("_folded")).alias("body_key"), *["customer_id"] * contacts,
    ), "ticket-signals")
    if contacts:
        narrow = repeat_contact(narrow).withColumn("_repeat", F.col("_repeat") & F.col("repeat_contact"))
    marked = _flag_repeated(narrow, "row_seq", "_dup").crossJoin(
        F.broadcast(_stats_of(narrow, F.col("_len"))))
    return marked.select(
        "row_seq", "ticket_id", F.col("_len").isNotNull().alias("has_body"), "body_key",
        join_flags({
            "body_length_spike": _above(F.col("_len"), z),
            "frustrated_sentiment": F.col("_frustrated"),
            "unclassified": F.col("_unclassified"),
            "repeat_frustrated": F.col("_repeat"),
            "duplicate_body": F.col("_dup"),
        }).alias("statistical_flags"),
    )


def candidates(flags: DataFrame, by: str = "ticket_id") -> DataFrame:
    """Rows to report. With ``by="ticket_id"`` the last flagged row of an id speaks
    for every row of that id, flagged or not; with ``by="row"`` each row for itself.
    """
    has = F.col("statistical_flags") != ""
    if by == "row":
        return flags.filter(has)
    per_id = flags.groupBy("ticket_id").agg(
        F.count("*").alias("n"),
        F.max_by("statistical_flags", F.when(has, F.col("row_seq"))).alias("id_flags"),
    )
    spoken = attach_by_key(
        flags, "ticket_id", per_id, ["id_flags"], keep=F.col("id_flags").isNotNull()
    )
    return spoken.filter(F.col("id_flags").isNotNull()).withColumn(
        "statistical_flags", F.col("id_flags")
    ).drop("id_flags")


def first_duplicate(cands: DataFrame) -> DataFrame:
    """Among candidates flagged as duplicates keep the first row of each body.

    The first rows come from a pre-aggregated minimum and are matched back on the
    unique ``row_seq``, so a body with many copies never meets in one task.
    """
    is_dup = F.col("has_body") & F.array_contains(F.split("statistical_flags", r"\|"), "duplicate_body")
    firsts = cands.filter(is_dup).groupBy("body_key").agg(F.min("row_seq").alias("row_seq")).select(
        "row_seq", F.lit(True).alias("_first")
    )
    return cands.join(firsts, "row_seq", "left").filter(~is_dup | F.col("_first").isNotNull()).drop("_first")


def _first_flag() -> Column:
    return F.split("statistical_flags", r"\|")[0]


def statistical_only(cands: DataFrame) -> DataFrame:
    """Candidates without a body: reported on the statistics alone."""
    return cands.filter(~F.col("has_body")).select(
        "row_seq", "ticket_id", "statistical_flags", _first_flag().alias("anomaly_type"),
        F.lit("low").alias("severity"),
        F.lit(REASON_NO_BODY).alias("reason"),
        F.lit("manual_review").alias("recommended_action"),
        F.lit("statistical").alias("detection_method"),
    )


def anomaly_input(cands: DataFrame, tickets: DataFrame) -> DataFrame:
    """Prompt text for the candidates that have a body."""
    # the bodies are cut in the scan; only the preview moves
    wide = tickets.select(
        "row_seq", "subject", F.substring("body", 1, PREVIEW).alias("preview"), "sentiment", "llm_category")
    text = F.concat(
        F.lit("Ticket "), F.col("ticket_id"),
        F.lit("\nSubject line: "), F.coalesce("subject", F.lit("")),
        F.lit("\nBeginning of the text: "), "preview",
        F.lit("\nMood: "), F.coalesce("sentiment", F.lit("")),
        F.lit("\nAssigned category: "), F.coalesce("llm_category", F.lit("")),
        F.lit("\nFlags raised: "), F.replace("statistical_flags", F.lit("|"), F.lit(", ")),
    )
    return cands.filter("has_body").join(wide, "row_seq").select(
        "row_seq", "ticket_id", "statistical_flags", text.alias("prompt")
    )


def merge_verdict(cands: DataFrame, responses: DataFrame) -> DataFrame:
    """Candidates with a body plus their checked verdict, or the fallback verdict."""
    v = parse_replies(responses, VERDICT).select("row_seq", F.col("reply").alias("_v"))
    fallback = {
        "anomaly_type": _first_flag(), "severity": F.lit("low"),
        "reason": F.lit(REASON_NO_VERDICT), "recommended_action": F.lit("monitor"),
    }
    return cands.filter("has_body").join(v, "row_seq", "left").select(
        "row_seq", "ticket_id", "statistical_flags",
        *[F.coalesce(F.col(f"_v.{c}"), d).alias(c) for c, d in fallback.items()],
        F.lit("hybrid").alias("detection_method"),
    )


def chosen_candidates(tickets: DataFrame, by: str = "ticket_id", z: float = SPIKE_Z,
                      contacts: bool = False) -> DataFrame:
    """Candidates after keeping the first of equal bodies, written down between steps."""
    flags = materialize(anomaly_flags(tickets, z, contacts), "ticket-flags")
    return materialize(first_duplicate(materialize(candidates(flags, by), "candidates")), "chosen")


def anomalies(tickets: DataFrame, responses: DataFrame, by: str = "ticket_id",
              z: float = SPIKE_Z, contacts: bool = False) -> DataFrame:
    """Anomaly table: ``row_seq`` plus the seven text columns."""
    return anomalies_of(chosen_candidates(tickets, by, z, contacts), responses)


def anomalies_of(cands: DataFrame, responses: DataFrame) -> DataFrame:
    """The anomaly table for chosen candidates."""
    found = statistical_only(cands).unionByName(merge_verdict(cands, responses))
    return found.select("row_seq", *[F.col(c).cast("string").alias(c) for c in ANOMALY_COLUMNS])


def anomaly_summary(found: DataFrame) -> DataFrame:
    """``(section, name, value)`` counts by type and by severity, from one grouping."""
    small = found.groupBy("anomaly_type", "severity").agg(F.count("*").alias("n"))

    def side(section: str, column: str) -> DataFrame:
        return small.groupBy(column).agg(F.sum("n").alias("value")).select(
            F.lit(section).alias("section"), F.col(column).alias("name"), "value"
        )

    return side("by_type", "anomaly_type").unionByName(side("by_severity", "severity"))


def alerts(found: DataFrame) -> DataFrame:
    """High-severity anomalies with channel and message."""
    action = F.col("recommended_action")
    return found.filter(F.col("severity") == "high").select(
        "ticket_id", "anomaly_type", "severity", "reason", "recommended_action",
        F.when(action == "escalate", "slack").when(action == "create_task", "email")
        .otherwise("monitor").alias("alert_channel"),
        F.format_string(
            ALERT_TEXT, "ticket_id", "anomaly_type", "recommended_action", "reason",
        ).alias("message"),
    )


def anomaly_trend(current: DataFrame, previous: DataFrame) -> DataFrame:
    """``(name, delta)``: total, and each type whose count changed."""
    return summary_trend(anomaly_summary(current), anomaly_summary(previous))


def summary_trend(current: DataFrame, previous: DataFrame) -> DataFrame:
    """The same from two stored summaries."""
    of_type = F.col("section") == "by_type"
    now = current.filter(of_type).select(F.col("name").alias("anomaly_type"), F.col("value").alias("now"))
    before = previous.filter(of_type).select(F.col("name").alias("anomaly_type"), F.col("value").alias("before"))
    both = now.join(before, "anomaly_type", "full").select(
        "anomaly_type", (F.coalesce("now", F.lit(0)) - F.coalesce("before", F.lit(0))).alias("delta")
    )
    total = both.agg(F.coalesce(F.sum("delta"), F.lit(0)).alias("delta")).select(
        F.lit("anomalies_found").alias("name"), "delta"
    )
    return total.unionByName(
        both.filter(F.col("delta") != 0).select(F.concat(F.lit("type:"), "anomaly_type").alias("name"), "delta")
    )


def detection_totals(tickets: DataFrame, found: DataFrame) -> DataFrame:
    """Tickets read, anomalies found and candidates sent to a model."""
    return tally(tickets, {("totals", "total_tickets"): F.count("*")}).unionByName(tally(found, {
        ("totals", "anomalies_found"): F.count("*"),
        ("totals", "scored"): F.count_if(F.col("detection_method") == "hybrid"),
    }))
