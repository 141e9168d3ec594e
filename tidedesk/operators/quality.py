"""The data-quality gate: row flags, nine checks, trend, dead letters, profile."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from tidedesk.schema import CHANNELS, STATUSES, UNKNOWN

# Share that must hold, and allowed share (with a floor) of bad rows.
MIN_RATES = {
    "completeness_subject": 0.90, "completeness_priority": 0.80,
    "validity_channel": 0.95, "validity_status": 0.95,
}
MAX_SHARES = {
    "uniqueness_ticket_id": (0.05, 1), "validity_created_at": (0.10, 1),
    "short_body": (0.01, 1), "future_created_at": (0.0, 0), "closed_without_agent": (0.05, 0),
}
CHECK_ORDER = [*MIN_RATES, *MAX_SHARES]
HARD_CHECK = "uniqueness_ticket_id"
SHORT_BODY = 10


class QualityGateError(RuntimeError):
    """The hard check failed."""


def as_of_literal(as_of: dt.datetime | str) -> Column:
    return F.lit(str(as_of)).cast("timestamp")


def row_checks(as_of: dt.datetime | str) -> dict[str, Column]:
    """Flag name -> predicate, in the order in which flags are written."""
    no, yes = F.lit(False), F.lit(True)
    return {
        "missing_subject": F.col("subject").isNull(),
        "missing_priority": F.col("priority").isNull(),
        "invalid_channel": F.coalesce(~F.col("channel").isin([*CHANNELS, UNKNOWN]), yes),
        "invalid_status": F.coalesce(~F.col("status").isin([*STATUSES, UNKNOWN]), yes),
        "null_created_at": F.col("created_at").isNull(),
        "short_body": F.coalesce(F.length("body") < SHORT_BODY, no),
        "future_created_at": F.coalesce(F.col("created_at") > as_of_literal(as_of), no),
        "closed_without_agent": F.coalesce(F.col("status") == "closed", no)
        & F.col("agent_id").isNull(),
    }


def join_flags(checks: dict[str, Column]) -> Column:
    """Names of the true predicates joined by ``|``; empty text when none holds."""
    return F.concat_ws("|", *[F.when(p, F.lit(name)) for name, p in checks.items()])


def quality_flags(df: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    return df.withColumn("quality_flags", join_flags(row_checks(as_of)))


def dead_letter(df: DataFrame) -> DataFrame:
    """Copies of the rows that carry a flag."""
    return df.filter(F.col("quality_flags") != "")


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Rows minus distinct keys, a null counting as one key."""
    return (
        df.groupBy(key).agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))
    )


def _tallies(df: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    """One row with everything the checks need except duplicates; one scan."""
    p = row_checks(as_of)

    def rate(bad: str) -> Column:
        return F.coalesce(F.avg((~p[bad]).cast("int")), F.lit(1.0))

    return df.agg(
        F.count("*").alias("total"),
        rate("missing_subject").alias("completeness_subject"),
        rate("missing_priority").alias("completeness_priority"),
        rate("invalid_channel").alias("validity_channel"),
        rate("invalid_status").alias("validity_status"),
        F.count_if(p["null_created_at"]).alias("validity_created_at"),
        F.count_if(p["short_body"]).alias("short_body"),
        F.count_if(p["future_created_at"]).alias("future_created_at"),
        F.count_if(p["closed_without_agent"]).alias("closed_without_agent"),
    )


def _limit(name: str) -> Column:
    share, least = MAX_SHARES[name]
    return F.greatest(F.lit(least), F.floor(F.col("total") * F.lit(share))).cast("double")


def _rows_of(tallies: DataFrame, names: list[str]) -> DataFrame:
    entries = []
    for name in names:
        v = F.col(name).cast("double")
        if name in MIN_RATES:
            limit = F.lit(MIN_RATES[name])
            entries.append((name, v >= limit, F.round(v, 4), limit))
        else:
            entries.append((name, v <= _limit(name), v, _limit(name)))
    cells = F.array(*[
        F.struct(F.lit(n).alias("check"), ok.alias("passed"), v.alias("value"), t.alias("threshold"))
        for n, ok, v, t in entries
    ])
    return tallies.select(F.explode(cells).alias("c")).select("c.*")


def rate_checks(df: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    """The four share checks, decided before rounding."""
    return _rows_of(_tallies(df, as_of), list(MIN_RATES))


def count_checks(df: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    """The four count checks that need no key."""
    return _rows_of(_tallies(df, as_of), [n for n in MAX_SHARES if n != HARD_CHECK])


def quality_report(df: DataFrame, as_of: dt.datetime | str, key: str = "ticket_id") -> DataFrame:
    """Nine rows ``(check, passed, value, threshold)``.

    Two scans on purpose: the wide one needs no shuffle, and the one that
    shuffles reads the key column alone.
    """
    dup = duplicate_count(df, key).select(F.col("duplicates").alias(HARD_CHECK))
    return _rows_of(_tallies(df, as_of).crossJoin(F.broadcast(dup)), CHECK_ORDER)


def with_trend(current: DataFrame, previous: DataFrame | None) -> DataFrame:
    """Add ``trend`` = value now minus value before; null without a previous value."""
    if previous is None:
        return current.withColumn("trend", F.lit(None).cast("double"))
    before = previous.select("check", F.col("value").alias("_before"))
    return current.join(before, "check", "left").select(
        *current.columns, F.round(F.col("value") - F.col("_before"), 4).alias("trend")
    )


def enforce(report: DataFrame) -> None:
    """Raise when the hard check failed. Call it after the outputs are written."""
    bad = report.filter((F.col("check") == HARD_CHECK) & ~F.col("passed")).collect()
    if bad:
        raise QualityGateError(
            f"{HARD_CHECK}: {bad[0]['value']:.0f} duplicates exceed {bad[0]['threshold']:.0f}"
        )


def contract_violations(df: DataFrame) -> DataFrame:
    """Add ``violations``: names of the record-contract rules a row breaks."""
    rules = {
        **{f"{c}_required": F.col(c).isNull() for c in ("ticket_id", "customer_id", "channel", "status")},
        "channel_value": ~F.col("channel").isin([*CHANNELS, UNKNOWN]),
        "status_value": ~F.col("status").isin([*STATUSES, UNKNOWN]),
    }
    named = F.array(*[F.when(p, F.lit(n)) for n, p in rules.items()])
    return df.withColumn("violations", F.filter(named, lambda x: x.isNotNull()))


def profile(df: DataFrame) -> DataFrame:
    """Totals, defect counts, distributions and null counts as ``(section, name, value)``.

    The one scan groups by channel and status; the report is made from that small table.
    """
    counters = {
        ("totals", "total_records"): F.count("*"),
        ("totals", "parse_errors"): F.count_if("parse_error"),
        ("totals", "html_stripped"): F.count_if("html_stripped"),
        ("totals", "invalid_ticket_ids"): F.count_if("invalid_ticket_id"),
        ("totals", "priority_nulled"): F.count_if(~F.col("priority_normalized")),
        **{("null_counts", c): F.count_if(F.col(c).isNull())
           for c in ("subject", "body", "priority", "agent_id")},
    }
    small = df.groupBy("channel", "status").agg(
        *[c.alias(f"{s}.{n}") for (s, n), c in counters.items()]
    )
    names = [f"{s}.{n}" for s, n in counters]
    totals = small.agg(*[F.coalesce(F.sum(F.col(f"`{n}`")), F.lit(0)).alias(n) for n in names])
    cells = F.array(*[
        F.struct(F.lit(s).alias("section"), F.lit(n).alias("name"), F.col(f"`{s}.{n}`").alias("value"))
        for s, n in counters
    ])
    out = totals.select(F.explode(cells).alias("c")).select("c.*")
    for c in ("channel", "status"):
        out = out.unionByName(
            small.filter(F.col(c).isNotNull()).groupBy(c)
            .agg(F.sum("`totals.total_records`").alias("value"))
            .select(F.lit(f"{c}_distribution").alias("section"), F.col(c).alias("name"), "value")
        )
    return out
