"""CSV ticket files to one table with a stable row order."""

from __future__ import annotations

import csv
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tidedesk.schema import NA_TOKENS
from tidedesk.session import materialize

_FILE_BITS = 40
_RANK_BITS = 63 - _FILE_BITS


class NoInputError(FileNotFoundError):
    """No file matched."""


def list_files(spark: SparkSession, path: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """``(name, uri, bytes, seen_at)`` of the matching files below ``path``, nested too.

    Only the listing is read; the file contents are pruned away.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
        .load(path)
        .select(F.col("path").alias("name"), F.col("_metadata.file_path").alias("uri"),
                F.col("length").alias("bytes"), F.col("modificationTime").alias("seen_at"))
    )


def headers(spark: SparkSession, path: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """``(name, uri, bytes, head)``: the header line of every matching file, found by a Spark job.

    ``head`` lists the column names, empty for an empty file. The line is read through Spark, so
    any store that Spark reaches will do; a header must fit on one line.
    """
    # a file's first line is the one in its first block that has the smallest number
    in_task = F.monotonically_increasing_id()
    lines = (
        spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(path)
        .select("value", F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_block_start").alias("_at"), in_task.alias("_n"))
        .filter("_at = 0").groupBy("uri").agg(F.min_by("value", "_n").alias("line"))
    )

    @F.pandas_udf("array<string>")
    def names(line: pd.Series) -> pd.Series:
        return line.map(lambda x: next(csv.reader([x.lstrip("\ufeff")]), []))

    files = list_files(spark, path, pattern)
    return files.join(lines, "uri", "left").select(
        "name", "uri", "bytes", F.coalesce(names(F.coalesce("line", F.lit(""))), F.array().cast("array<string>")).alias("head"))


def null_tokens(df: DataFrame, tokens: list[str] = NA_TOKENS) -> DataFrame:
    """Text cells that equal a token become null, in every string column."""
    return df.select(*[
        F.when(~F.col(f"`{f.name}`").isin(tokens), F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def _scan(spark: SparkSession, head: tuple[str, ...], names: str | list[str], multi_line: bool,
          pattern: str | None = None, check: bool = False) -> DataFrame:
    """Files of one header: those of a list, or all below a folder that match ``pattern``. With ``check``
    each task looks at its own file's header and fails if it is another."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in head])
    reader = spark.read.schema(schema).options(
        header=True, enforceSchema=not check, multiLine=multi_line, quote='"', escape='"', encoding="UTF-8")
    if pattern is not None:
        reader = reader.options(pathGlobFilter=pattern, recursiveFileLookup=True)
    rows = reader.csv(names)
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return rows.select(
        *[F.col(f"`{c}`") for c in head],
        F.col("_metadata.file_path").alias("_uri"),
        (F.col("_metadata.file_block_start") + in_task).alias("_place"),
    )


def read_tickets(
    spark: SparkSession,
    path: str | list[str],
    *,
    pattern: str = "*.csv",
    columns: list[str] | None = None,
    multi_line: bool = True,
    tokens: list[str] = NA_TOKENS,
) -> DataFrame:
    """All matching CSV files, matched by column name, as text columns plus ``row_seq``.

    Files are grouped by their header and each group is read in one scan, because
    Spark binds CSV columns by position; the headers are found by a Spark job, and the
    driver gets the distinct ones, with their files if there are several (``sources.ranges``
    needs no such list). Columns a file lacks are null. Pass
    ``columns`` when all files share that one header: then nothing is listed on the
    driver and a file with another header fails the read. Pass ``multi_line=False``
    when no cell contains a line break, and large files are split; otherwise a file is
    one task.

    ``row_seq`` is file rank (by path), then place in the file. It needs no shuffle of
    rows: the place is the block's byte offset plus the running number within the task,
    and a task reads fewer rows than a block has bytes. Values have gaps; they are unique,
    ordered and the same on every run with the same split size. Files of a tebibyte or
    more, and more than 8 million files, are refused.
    """
    if columns is not None:
        known = list_files(spark, path, pattern).select("name", "uri", "bytes")
    else:
        known = materialize(headers(spark, path, pattern), "csv-headers")
    size = known.agg(F.count("*").alias("n"), F.max("bytes").alias("b")).first()
    if not size.n:
        raise NoInputError(f"no file matches {pattern} below {path}")
    if size.b >= 1 << _FILE_BITS or size.n > 1 << _RANK_BITS:
        raise ValueError(f"row_seq cannot number {size.n} files of up to {size.b} bytes")
    if columns is not None:
        every = _scan(spark, tuple(columns), path, multi_line, pattern, check=True)
    else:
        filled = known.filter(F.size("head") > 0)
        heads = [tuple(r["head"]) for r in filled.groupBy("head").agg(F.min("name").alias("name")).orderBy("name").collect()]
        if not heads:
            raise NoInputError(f"every file below {path} is empty")
        if len(heads) == 1:  # empty files have no rows under any header
            every = _scan(spark, heads[0], path, multi_line, pattern)
        else:
            parts = [_scan(spark, h, [r["name"] for r in filled.filter(F.col("head") == F.array(*map(F.lit, h))).select("name").collect()], multi_line)
                     for h in heads]
            every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    # ranks without one window over all files: files of a folder are ranked, folders follow one another
    folder = F.regexp_extract("name", r"^(.*)/", 1)
    named = known.select("name", "uri", folder.alias("_folder"))
    within = F.row_number().over(Window.partitionBy("_folder").orderBy("name"))
    before = named.groupBy("_folder").agg(F.count("*").alias("_n")).withColumn(
        "_before", F.coalesce(F.sum("_n").over(Window.orderBy("_folder").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranks = named.withColumn("_within", within).join(before, "_folder").select(
        F.col("uri").alias("_uri"), (F.col("_before") + F.col("_within") - 1).cast("long").alias("_rank"))
    ranks = materialize(ranks, "csv-ranks")  # so Spark knows its size and broadcasts it while it is small
    ranked = every.join(ranks, "_uri").withColumn(
        "row_seq", F.shiftleft("_rank", _FILE_BITS) + F.col("_place")
    )
    return null_tokens(ranked.drop("_uri", "_place", "_rank"), tokens)
