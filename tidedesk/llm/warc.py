"""WARC archives: write captures, read them back, assemble transactions.

A capture is three records: a ``response`` (or a ``revisit`` of an earlier equal payload), the
``request`` and a ``metadata`` record. The last two name the first in ``WARC-Concurrent-To``.

Defined cases: a null payload is empty; a null URL has no target header; equal payloads of at
least ``min_bytes`` bytes share one response, that of the smallest page id (every row that bears
this id, if rows repeat); shorter payloads are always responses. A record's id depends on page id and
payload, so rows that repeat an id with other payloads are captures of their own. A null page id is never the
smallest unless all ids are null. Further input columns are ignored. An empty table gives an
archive without records and an empty result.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CRLF = "\r\n"
RECORD = ("record_id string, warc_type string, concurrent_to string, refers_to string, target_uri string, "
          "payload_digest string, http_header binary, payload binary")
_TYPES = pa.schema([
    ("record_id", pa.string()), ("warc_type", pa.string()), ("concurrent_to", pa.string()),
    ("refers_to", pa.string()), ("target_uri", pa.string()), ("payload_digest", pa.string()),
    ("http_header", pa.binary()), ("payload", pa.binary()),
])


def _urn(kind: str, page_id: Column, digest: Column) -> Column:
    """A record id that depends on page id and payload alone, so that a revisit can name its response."""
    h = F.sha2(F.concat_ws("|", F.lit(kind), F.coalesce(page_id.cast("string"), F.lit("null")), digest), 256)
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """The text of a record without the two line ends that close it; null headers are left out."""
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)) for name, value in headers]
    return F.concat(
        F.lit("WARC/1.1" + CRLF), *[F.coalesce(line, F.lit("")) for line in lines],
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF + CRLF), block)


def with_roles(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """Adds ``payload``, ``digest`` and ``first_id`` (null, or the page whose payload this repeats).

    Digests are counted before they are joined, and only repeated ones are joined; a digest that
    many pages share lies on the side of the join that Spark can split. Payloads below ``min_bytes``
    have nothing to join and are spread by page.
    """
    base = pages.select(
        "page_id", "url", F.coalesce(F.col("html"), F.lit("")).alias("payload"),
    ).withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))
    firsts = (
        base.filter(F.octet_length("payload") >= min_bytes)
        .groupBy(F.col("digest").alias("_digest"))
        .agg(F.count("*").alias("_n"), F.min("page_id").alias("_first"))
        .filter("_n > 1").drop("_n")
    )
    spread = F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))
    key = F.when(F.octet_length("payload") >= min_bytes, F.col("digest")).otherwise(spread)
    return base.withColumn("_key", key).join(firsts, F.col("_key") == F.col("_digest"), "left").select(
        "page_id", "url", "payload", "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first")).alias("first_id"))


def write_archive(captures: DataFrame, path: str, date: str = "2024-02-01T00:00:00Z", records_per_file: int = 30_000) -> None:
    """Writes the rows of :func:`with_roles` as gzipped WARC files below ``path``.

    Spark's text writer ends every record with the two line ends that the format asks for, so
    archives can lie in any store that Spark reaches.
    """
    uri = F.regexp_replace("url", r"[\r\n]", "")
    host = F.coalesce(F.regexp_extract(uri, r"^[a-z]+://([^/?#]+)", 1), F.lit(""))
    target = F.coalesce(F.regexp_extract(uri, r"^[a-z]+://[^/?#]+([^#]*)", 1), F.lit(""))
    own, stamp = _urn("response", F.col("page_id"), F.col("digest")), F.lit(date)
    again = F.col("first_id").isNotNull()
    original = F.when(again, _urn("response", F.col("first_id"), F.col("digest")))
    digest = F.concat(F.lit("sha256:"), F.col("digest"))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.octet_length("payload").cast("string"), F.lit(CRLF + CRLF))
    response = _record(
        [("WARC-Type", F.when(again, "revisit").otherwise("response")), ("WARC-Record-ID", own), ("WARC-Date", stamp),
         ("WARC-Target-URI", uri), ("WARC-Payload-Digest", digest), ("WARC-Refers-To", original),
         ("WARC-Profile", F.when(again, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
         ("Content-Type", F.lit("application/http;msgtype=response"))],
        F.when(again, head).otherwise(F.concat(head, F.col("payload"))))
    request = _record(
        [("WARC-Type", F.lit("request")), ("WARC-Record-ID", _urn("request", F.col("page_id"), F.col("digest"))),
         ("WARC-Date", stamp), ("WARC-Target-URI", uri), ("WARC-Concurrent-To", own),
         ("Content-Type", F.lit("application/http;msgtype=request"))],
        F.concat(F.lit("GET "), F.when(target == "", "/").otherwise(target), F.lit(f" HTTP/1.1{CRLF}Host: "), host, F.lit(CRLF + CRLF)))
    metadata = _record(
        [("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", _urn("metadata", F.col("page_id"), F.col("digest"))),
         ("WARC-Date", stamp), ("WARC-Target-URI", uri), ("WARC-Concurrent-To", own),
         ("Content-Type", F.lit("application/warc-fields"))],
        F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit(CRLF)), F.lit("")))
    captures.select(F.explode(F.array(response, request, metadata)).alias("value")).write.option(
        "lineSep", CRLF + CRLF).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def parse_archive(data: bytes) -> Iterator[dict]:
    """The records of one archive, read one after the other; a broken record is an error."""
    src: io.BufferedIOBase = io.BytesIO(data)
    if data[:2] == b"\x1f\x8b":
        src = io.BufferedReader(gzip.GzipFile(fileobj=src))
    while version := src.readline():
        if version == b"\r\n":
            continue
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {version[:40]!r}")
        head: dict[str, str] = {}
        while (line := src.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8").partition(":")
            head[name.strip().lower()] = value.strip()
        size = int(head["content-length"])
        block = src.read(size)
        if len(block) != size:
            raise ValueError(f"record {head.get('warc-record-id')} is cut short")
        http, body = None, block
        if head.get("content-type", "").startswith("application/http"):
            end = block.find(b"\r\n\r\n") + 4
            http, body = block[:end], block[end:]
        yield {"record_id": head.get("warc-record-id"), "warc_type": head.get("warc-type"),
               "concurrent_to": head.get("warc-concurrent-to"), "refers_to": head.get("warc-refers-to"),
               "target_uri": head.get("warc-target-uri"), "payload_digest": head.get("warc-payload-digest"),
               "http_header": http, "payload": body}


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record (``RECORD``). A task reads whole files and holds one batch of records."""

    def records(batches):
        for batch in batches:
            for content in batch.column(0):
                held, size = [], 0
                for rec in parse_archive(content.as_py()):
                    held.append(rec)
                    size += len(rec["payload"]) + 500
                    if size > 8_000_000:
                        yield pa.RecordBatch.from_pylist(held, _TYPES)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, _TYPES)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(records, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id, response, request, metadata``.

    Requests and metadata name their response; if several name the same, the one with the smallest
    record id stays. Records whose partner is missing give a row with nulls in its place.
    """
    names = [f.name for f in records.schema]
    response = records.filter(F.col("warc_type").isin("response", "revisit")).select(
        F.col("record_id").alias("_r"), F.struct(*names).alias("response"))

    def partner(kind: str, key: str) -> DataFrame:
        own = records.filter(F.col("warc_type") == kind)
        return own.groupBy(F.col("concurrent_to").alias(key)).agg(
            F.min_by(F.struct(*names), F.col("record_id")).alias(kind))

    joined = response.join(partner("request", "_q"), F.col("_r") == F.col("_q"), "full")
    joined = joined.withColumn("_c", F.coalesce("_r", "_q"))
    return joined.join(partner("metadata", "_m"), F.col("_c") == F.col("_m"), "full").select(
        F.coalesce("_c", "_m").alias("capture_id"), "response", "request", "metadata")


def measured(records: DataFrame) -> DataFrame:
    """``records`` with the digest and size of what is stored in place of the payload of responses.

    For callers that need no bodies: taken before :func:`assemble`, no page crosses a shuffle.
    """
    body = F.col("warc_type").isin("response", "revisit")
    return records.select(
        *[c for c in records.columns if c != "payload"], F.when(~body, F.col("payload")).alias("payload"),
        F.when(body, F.sha2("payload", 256)).alias("stored_digest"),
        F.when(body, F.octet_length("payload").cast("long")).alias("stored_bytes"))


def page_roles(captures: DataFrame) -> DataFrame:
    """``capture_id, page_id, payload_bytes, payload_digest, record_type, original`` of each response or revisit
    among assembled :func:`measured` records.

    Of a response both are those of the stored payload; a revisit, which stores none, tells them in its own headers.
    """
    stored = F.col("response.warc_type") == "response"
    page = F.regexp_extract(F.decode(F.col("metadata.payload"), "UTF-8"), r"page-id: (-?[0-9]+)", 1)
    told = F.regexp_extract(F.decode(F.col("response.http_header"), "UTF-8"), r"(?i)\r\nContent-Length: ([0-9]+)", 1)
    return captures.filter(F.col("response").isNotNull()).select(
        "capture_id", F.when(page != "", page).cast("long").alias("page_id"),
        F.when(stored, F.col("response.stored_bytes")).when(told != "", told.cast("long")).alias("payload_bytes"),
        F.when(stored, F.col("response.stored_digest")).otherwise(
            F.regexp_replace("response.payload_digest", "^sha256:", "")).alias("payload_digest"),
        F.col("response.warc_type").alias("record_type"), F.col("response.refers_to").alias("original"))


def resolve_revisits(roles: DataFrame) -> DataFrame:
    """Gives every revisit the page of its original; ``roles`` should be a written table.

    Only revisits are joined; an original with very many of them lies on the side that Spark can split.
    """
    responses = roles.filter("record_type = 'response'")
    originals = responses.groupBy(F.col("capture_id").alias("_o")).agg(F.min("page_id").alias("_page"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    revisits = roles.filter("record_type = 'revisit'").join(originals, F.col("original") == F.col("_o"), "left").select(
        *columns, F.col("_page").alias("refers_to"))
    return responses.select(*columns, F.lit(None).cast("long").alias("refers_to")).unionByName(revisits)
