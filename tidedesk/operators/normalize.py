"""Raw ticket text to the normalised 16-column table (narrow, no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidedesk.functions.clean import (
    enum_violation, is_uuid4, norm_enum, norm_priority, parse_ts,
)
from tidedesk.functions.text import blank_to_null, strip, strip_html
from tidedesk.schema import (
    CATEGORIES, CHANNELS, PRIORITIES, SCHEMA_VERSION, STATUSES, TICKET_COLUMNS,
)
from tidedesk.session import require_utc, scratch_dir
from tidedesk.sources.sinks import write_table

ENUMS = {
    "channel": CHANNELS, "priority": PRIORITIES, "status": STATUSES, "category": CATEGORIES,
}


class MissingColumnsError(ValueError):
    """The input lacks columns of the ticket contract."""


class InvalidEnumError(ValueError):
    """Strict mode found values outside an enumeration."""


def missing_columns(df: DataFrame, columns: list[str] = TICKET_COLUMNS) -> list[str]:
    return [c for c in columns if c not in df.columns]


def require_columns(df: DataFrame, columns: list[str] = TICKET_COLUMNS) -> DataFrame:
    """Fail with the name of every missing column, before anything runs."""
    if missing := missing_columns(df, columns):
        raise MissingColumnsError(f"missing column(s) {missing}; expected {columns}")
    return df


def enum_violations(df: DataFrame) -> DataFrame:
    """Distinct ``(column_name, bad_value)`` pairs; nulls are not violations.

    One scan: bad values are exploded, and distinct combines before the shuffle.
    """
    pairs = F.array(*[
        F.struct(F.lit(name).alias("column_name"), enum_violation(F.col(name), valid).alias("bad_value"))
        for name, valid in ENUMS.items()
    ])
    return (
        df.select(F.explode(F.filter(pairs, lambda p: p["bad_value"].isNotNull())).alias("p"))
        .select("p.column_name", "p.bad_value")
        .distinct()
    )


def with_meta(df: DataFrame, processed_at: str, version: str = SCHEMA_VERSION) -> DataFrame:
    """Provenance constants; the run time is passed in so results can be repeated."""
    return df.withColumns({"_schema_version": F.lit(version), "_processed_at": F.lit(processed_at)})


def check_enums(df: DataFrame) -> None:
    """Raise if a value is outside its enumeration; the message counts the bad values per column
    and names the table that lists every one of them."""
    path = scratch_dir(df.sparkSession, "enum-violations")
    bad = write_table(enum_violations(df), path)
    counts = {r.column_name: r.n for r in bad.groupBy("column_name").agg(F.count("*").alias("n")).collect()}
    if counts:
        raise InvalidEnumError(
            "values outside their enumeration: "
            + ", ".join(f"{c}: {counts[c]}" for c in sorted(counts)) + f"; all are listed in {path}")


def normalize(df: DataFrame, processed_at: str, strict: bool = False) -> DataFrame:
    """Apply every field rule; one row in, one row out, extra columns kept.

    ``strict`` runs :func:`check_enums` first.
    """
    require_utc(df.sparkSession)
    require_columns(df)
    if strict:
        check_enums(df)
    text = {c: blank_to_null(F.col(c)) for c in ("subject", "body")}
    ids = {c: strip(F.col(c)) for c in ("ticket_id", "customer_id", "agent_id")}
    cleaned = df.withColumns({
        "created_at": parse_ts(F.col("created_at").cast("string")),
        "channel": norm_enum(F.col("channel"), CHANNELS),
        "priority": norm_priority(F.col("priority"), PRIORITIES),
        "status": norm_enum(F.col("status"), STATUSES),
        "category": norm_enum(F.col("category"), CATEGORIES),
        **text, **ids,
    }).withColumn("_plain", strip_html(F.col("body")))
    flagged = cleaned.withColumns({
        "parse_error": F.col("created_at").isNull(),
        "priority_normalized": F.col("priority").isNotNull(),
        "html_stripped": F.coalesce(F.col("_plain") != F.col("body"), F.lit(False)),
        "invalid_ticket_id": ~is_uuid4(F.col("ticket_id")),
        "body": F.col("_plain"),
    }).drop("_plain")
    return with_meta(flagged, processed_at)
