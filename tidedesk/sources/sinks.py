"""Parquet, JSON report and JSON-lines outputs."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Replace the Parquet table at ``path`` and return a reader over it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_by_channel(df: DataFrame, path: str) -> int:
    """Replace the channel-partitioned copy; returns the number of partitions.

    No shuffle: each task writes its own file per channel, so one large channel
    stays spread over all tasks.
    """
    df.write.mode("overwrite").partitionBy("channel").parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    return back.filter("channel IS NOT NULL").select("channel").distinct().count()


def report_json(df: DataFrame, path: str) -> DataFrame:
    """Write a report (a handful of rows by construction) as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return df.sparkSession.read.schema(df.schema).json(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Add rows to a JSON-lines table."""
    df.write.mode("append").json(path)


def replace_rows(df: DataFrame, path: str) -> None:
    """Start a JSON-lines table over, as run logs do at the start of a run."""
    df.write.mode("overwrite").json(path)


def read_rows(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Rows of a JSON-lines table; blank lines are skipped, no table means no rows."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)
