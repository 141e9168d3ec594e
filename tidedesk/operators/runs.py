"""Run history and freshness of outputs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tidedesk.operators.quality import as_of_literal

RANK = {"ok": 0, "degraded": 1, "failed": 2}


def _one(df: DataFrame | None, count, name: str, spark) -> DataFrame:
    if df is None:
        return spark.range(1).select(F.lit(0).cast("long").alias(name))
    return df.agg(count.cast("long").alias(name))


def run_metrics(
    spark,
    *,
    run_id: str,
    timestamp: str,
    status: str = "success",
    duration_ms: int = 0,
    ingested: DataFrame | None = None,
    validated: DataFrame | None = None,
    checks: DataFrame | None = None,
    anomalies: DataFrame | None = None,
    actions: DataFrame | None = None,
) -> DataFrame:
    """One row of counts for a run; a part that is not given counts 0."""
    every = F.count("*")
    parts = [
        _one(ingested, every, "records_ingested", spark),
        _one(validated, every, "records_validated", spark),
        _one(checks, F.count_if(~F.col("passed")), "quality_checks_failed", spark),
        _one(anomalies, every, "anomalies_found", spark),
        _one(actions, every, "agent_actions_taken", spark),
    ]
    row = spark.range(1).select(
        F.lit(run_id).alias("run_id"), F.lit(timestamp).alias("timestamp"),
        F.lit(status).alias("pipeline_status"), F.lit(duration_ms).cast("long").alias("total_duration_ms"),
    )
    for p in parts:
        row = row.crossJoin(F.broadcast(p))
    return row


def last_runs(history: DataFrame, n: int = 10) -> DataFrame:
    """The latest ``n`` runs, oldest first."""
    newest = history.orderBy(F.desc("timestamp"), F.desc("run_id")).limit(n)
    return newest.orderBy("timestamp", "run_id")


def freshness(expected: DataFrame, observed: DataFrame, as_of: dt.datetime | str,
              max_age_hours: float = 24) -> DataFrame:
    """Compare what should exist with what was seen.

    ``expected`` (name, missing_status), ``observed`` (name, seen_at, any number of
    rows). Missing gives its own status, too old gives degraded. ``overall`` is the
    worst status of all.
    """
    newest = observed.groupBy("name").agg(F.max("seen_at").alias("seen_at"))
    age = (F.unix_micros(as_of_literal(as_of)) - F.unix_micros(F.col("seen_at").cast("timestamp"))) / F.lit(3.6e9)
    joined = expected.join(newest, "name", "left").withColumn("age_hours", age)
    status = (
        F.when(F.col("seen_at").isNull(), F.col("missing_status"))
        .when(F.col("age_hours") > max_age_hours, "degraded").otherwise("ok")
    )
    checked = joined.select("name", status.alias("status"), F.round("age_hours", 1).alias("age_hours"))
    rank = F.when(F.col("status") == "failed", RANK["failed"]).when(
        F.col("status") == "degraded", RANK["degraded"]).otherwise(RANK["ok"])
    worst = checked.agg(F.max(rank).alias("_w")).select(
        F.when(F.col("_w") == RANK["failed"], "failed").when(F.col("_w") == RANK["degraded"], "degraded")
        .otherwise("ok").alias("overall")
    )
    return checked.crossJoin(F.broadcast(worst))
