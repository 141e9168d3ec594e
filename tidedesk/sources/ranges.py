"""CSV and JSON-lines files as a partitioned source of our own, for batch and streams.

A file is read in byte ranges: a line belongs to the range that its first byte lies in, so ranges need not know each
other. Headers are read from the first bytes of a file, in the tasks. ``row_seq`` is the file's rank (by path) and the
byte its row begins at: unique, in order, and the same however files are split. A stream takes files in order of their
time of change and remembers the last one; its rows carry the file's time in place of a rank.

Paths are those pyarrow reads by itself (local and mounted folders, ``hdfs``, ``s3``, ``gs``, ``abfs``); files in any
other store are read by ``read_tickets``. Files whose names begin with ``_`` or ``.`` are left out.
"""

from __future__ import annotations

import csv
import fnmatch
import json
import posixpath
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tidedesk.schema import NA_TOKENS
from tidedesk.sources.tickets import NoInputError, null_tokens

FORMAT = "ticket_files"
SPLIT_BYTES = 64 << 20
_PLACE_BITS = 40
_READ, _ROWS = 1 << 20, 4096


@dataclass
class Range(InputPartition):
    """Bytes ``start`` to ``stop`` of a file; ``rank`` goes into ``row_seq``."""

    uri: str
    rank: int
    start: int
    stop: int


@dataclass
class Heads(InputPartition):
    """Files whose headers one task reads."""

    uris: list[str]


def _open(uri: str) -> pa.NativeFile:
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def listed(root: str, pattern: str) -> list[tuple[int, str, int]]:
    """``(changed, uri, bytes)`` of the matching files at or below ``root``, by path."""
    system, path = fs.FileSystem.from_uri(root)
    scheme = root.split("://", 1)[0] + "://" if "://" in root else ""
    info = system.get_file_info(path)
    if info.type == fs.FileType.NotFound:
        return []
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(path, recursive=True))
    hidden = lambda p: any(x[:1] in ("_", ".") for x in posixpath.relpath(p, path).split("/")) and p != path
    return sorted(((f.mtime_ns or 0, scheme + f.path, f.size) for f in found
                   if f.type == fs.FileType.File and fnmatch.fnmatch(f.base_name, pattern) and not hidden(f.path)), key=lambda x: x[1])


def lines(f: pa.NativeFile, start: int, stop: int) -> Iterator[tuple[int, bytes]]:
    """``(offset, line)`` of the lines that begin in the range, line ends left off; the last one may end beyond it."""
    at = max(start - 1, 0)
    f.seek(at)
    held, skip = b"", start > 0
    while True:
        more = f.read(_READ)
        data = held + more
        *whole, held = data.split(b"\n")
        if not more and held:
            whole.append(held)
            held = b""
        for line in whole:
            if not skip:
                if at >= stop:
                    return
                yield at, line[:-1] if line.endswith(b"\r") else line
            skip = False
            at += len(line) + 1
        if not more or at >= stop and not skip:
            return


def header(f: pa.NativeFile) -> list[str]:
    """The column names of a CSV file, from its first line."""
    for _, line in lines(f, 0, 1):
        return next(csv.reader([line.decode("utf-8").lstrip("﻿")]), [])
    return []


def records(uri: str, start: int, stop: int, kind: str, multi_line: bool, columns: list[str]) -> Iterator[tuple[int, list[str | None]]]:
    """``(offset, cells)`` of the rows that begin in the range, cells in the order of ``columns``."""
    with _open(uri) as f:
        if kind == "json":
            for at, line in lines(f, start, stop):
                if line.strip():
                    row = json.loads(line)
                    yield at, [None if (v := row.get(c)) is None else v if isinstance(v, str) else json.dumps(v) for c in columns]
            return
        head = header(f)
        place = {c: i for i, c in reversed(list(enumerate(head)))}
        picks = [place.get(c, -1) for c in columns]
        offsets: list[int] = []

        def text() -> Iterator[str]:
            for at, line in lines(f, start, stop):
                offsets.append(at)
                yield line.decode("utf-8") + ("\n" if multi_line else "")

        source = text()
        if start == 0:
            next(source, None)
            offsets.clear()
        rows = csv.reader(source) if multi_line else (next(csv.reader([t]), []) for t in source)
        for row in rows:
            at = offsets[0]
            offsets.clear()
            if row:
                yield at, [row[i] if 0 <= i < len(row) else None for i in picks]


class _Options:
    def __init__(self, options: dict, schema: T.StructType):
        self.root = options.get("path") or ""
        self.pattern, self.kind = options.get("pattern", "*.csv"), options.get("kind", "csv")
        self.multi_line = options.get("multiline", "false") == "true"
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.heads = options.get("heads", "false") == "true"
        self.columns = [f.name for f in schema.fields if f.name != "row_seq"]

    def ranges(self, files: list[tuple[int, str, int]]) -> list[Range]:
        """``files`` as ``(rank, uri, bytes)``; a file is one range where cells may hold line breaks."""
        out = []
        for rank, uri, size in files:
            if size >= 1 << _PLACE_BITS or rank >= 1 << (63 - _PLACE_BITS):
                raise ValueError(f"row_seq cannot number {uri}: rank {rank}, {size} bytes")
            step = max(size, 1) if self.multi_line and self.kind == "csv" else self.split
            out += [Range(uri, rank, a, min(a + step, size)) for a in range(0, size, step)]
        return out

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.string()) for c in self.columns] + [("row_seq", pa.int64())])
        held: list[list] = []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

        size = 0
        for at, cells in records(part.uri, part.start, part.stop, self.kind, self.multi_line, self.columns):
            held.append([*cells, (part.rank << _PLACE_BITS) + at])
            size += sum(len(c) for c in cells if c)
            if len(held) >= _ROWS or size > 4 * _READ:
                yield batch()
                held.clear()
                size = 0
        if held:
            yield batch()


class _Reader(DataSourceReader):
    def __init__(self, options: _Options):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        files = listed(self.options.root, self.options.pattern)
        if not files:
            raise NoInputError(f"no file matches {self.options.pattern} below {self.options.root}")
        if self.options.heads:
            return [Heads([u for _, u, _ in files[i:i + 64]]) for i in range(0, len(files), 64)]
        return self.options.ranges([(i, u, n) for i, (_, u, n) in enumerate(files)]) or [Range(files[0][1], 0, 0, 0)]

    def read(self, partition: InputPartition) -> Iterator:
        if isinstance(partition, Heads):
            for uri in partition.uris:
                with _open(uri) as f:
                    yield uri, header(f)
        else:
            yield from self.options.read(partition)


class _StreamReader(DataSourceStreamReader):
    """An offset is the time and path of the last file taken: files are taken in that order."""

    def __init__(self, options: _Options):
        self.options = options

    def initialOffset(self) -> dict:
        return {"changed": -1, "uri": ""}

    def latestOffset(self) -> dict:
        files = listed(self.options.root, self.options.pattern)
        last = max(((t, u) for t, u, _ in files), default=(-1, ""))
        return {"changed": last[0], "uri": last[1]}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        low, high = (start["changed"], start["uri"]), (end["changed"], end["uri"])
        files = [f for f in listed(self.options.root, self.options.pattern) if low < (f[0], f[1]) <= high]
        files.sort()
        # seconds of change modulo 2**23 stand for the rank
        return self.options.ranges([((t // 1_000_000_000) % (1 << 23), u, n) for t, u, n in files])

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        yield from self.options.read(partition)


class TicketFiles(DataSource):
    """``spark.read.format("ticket_files")``; options ``pattern``, ``kind`` (csv, json), ``multiLine``, ``splitBytes``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "uri string, head array<string>"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(_Options(self.options, schema))

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _StreamReader(_Options(self.options, schema))


def _schema(columns: list[str]) -> T.StructType:
    return T.StructType([*[T.StructField(c, T.StringType()) for c in columns], T.StructField("row_seq", T.LongType())])


def headers(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """``uri, head`` of every matching file; only first bytes are read, in tasks of 64 files."""
    spark.dataSource.register(TicketFiles)
    return spark.read.format(FORMAT).options(pattern=pattern, heads="true").load(path)


def read_files(
    spark: SparkSession, path: str, columns: list[str] | None = None, *, pattern: str = "*.csv", kind: str = "csv",
    multi_line: bool = False, split_bytes: int = SPLIT_BYTES, tokens: list[str] = NA_TOKENS,
) -> DataFrame:
    """The rows of all matching files as text columns and ``row_seq``, matched by column name whatever each file's header.

    Without ``columns`` a first job reads the headers and the driver gets the distinct column names, in order of the
    first file that has them; JSON lines need ``columns``. A column a file lacks is null, tokens for missing values are
    null. ``multi_line`` allows line breaks in cells, and a file is one task then.
    """
    if columns is None:
        if kind != "csv":
            raise ValueError("columns must be given for JSON lines")
        spread = headers(spark, path, pattern).select("uri", F.posexplode("head").alias("i", "name"))
        first = spread.groupBy("name").agg(F.min(F.struct("uri", "i")).alias("at"))
        columns = [r["name"] for r in sorted(first.collect(), key=lambda r: tuple(r["at"]))]
        if not columns:
            raise NoInputError(f"every file below {path} is empty")
    spark.dataSource.register(TicketFiles)
    rows = spark.read.format(FORMAT).schema(_schema(columns)).options(
        pattern=pattern, kind=kind, multiLine=str(multi_line).lower(), splitBytes=str(split_bytes)).load(path)
    return null_tokens(rows, tokens)


def follow_files(
    spark: SparkSession, path: str, columns: list[str], *, pattern: str = "*.csv", kind: str = "csv", multi_line: bool = False,
    split_bytes: int = SPLIT_BYTES, tokens: list[str] = NA_TOKENS,
) -> DataFrame:
    """The same as a streaming frame. Files must be complete when they appear and not keep an older time of change."""
    spark.dataSource.register(TicketFiles)
    rows = spark.readStream.format(FORMAT).schema(_schema(columns)).options(
        pattern=pattern, kind=kind, multiLine=str(multi_line).lower(), splitBytes=str(split_bytes)).load(path)
    return null_tokens(rows, tokens)
