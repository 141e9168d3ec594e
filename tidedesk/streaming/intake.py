"""Normalise and flag tickets as files arrive.

The row rules keep no state, so the batch functions run on a stream as they are.
The nine-check report needs the whole table and stays a batch job over the output.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidedesk.operators.normalize import normalize
from tidedesk.operators.quality import quality_flags


def clean_stream(raw: DataFrame, processed_at: str, as_of: dt.datetime | str) -> DataFrame:
    """Normalised, flagged rows of a streaming (or batch) ticket frame."""
    return quality_flags(normalize(raw, processed_at), as_of)


def write_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to a Parquet table, exactly once, and stop when the input is used up."""
    return (
        rows.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
