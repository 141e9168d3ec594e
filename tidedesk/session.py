"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tidedesk", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators rely on.

    On a cluster leave ``master`` unset and pass sizing through ``conf``;
    shuffle partitions start wide and AQE merges them.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Timestamps without a zone mean UTC here, so the session must run in UTC."""
    tz = spark.conf.get("spark.sql.session.timeZone")
    if tz not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC (it is {tz!r})")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Used where several later steps need the same costly rows. The written table
    outlives lost executors and cuts the plan.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder that all executors share.

    The folder is ``spark.checkpoint.dir``. A local session without that setting uses a
    folder in its warehouse; a cluster session without it is an error. A ``file:`` path on
    a cluster must be a mount that all machines share, which Spark cannot tell.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
