import hashlib

from tidedesk.llm import queries, warc

SCHEMA = "page_id long, url string, html string, response string"


def run(spark, pages, path):
    warc.write_archive(warc.with_roles(pages), path, records_per_file=4)
    return warc.read_archives(spark, path)


def test_round_trip_and_roles(spark, tmp_path, tuples):
    long = "é" * 60 + "\r\n\r\nWARC/1.1\r\n"
    data = [(3, "http://a/x?y#z", long, "c"), (1, "http://a/1", long, "c"), (2, None, "short", "c"), (5, "u\r\nX: y", None, "c"),
            (4, "http://a/4", "short", "c"), (7, "http://a/7", long, "c")]
    pages = spark.createDataFrame(data, SCHEMA)
    records = run(spark, pages, str(tmp_path / "w"))
    assert records.count() == 18
    got = tuples(warc.resolve_revisits(warc.page_roles(warc.assemble(warc.measured(records)))),
                 "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    want = []
    for page_id, _, html, _ in data:
        b = (html or "").encode()
        again = html == long and page_id != 1
        want.append((page_id, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", 1 if again else None))
    assert got == sorted(want, key=str)
    nested = warc.assemble(records).collect()
    assert all(r.request.concurrent_to == r.capture_id == r.metadata.concurrent_to == r.response.record_id for r in nested)
    bodies = {bytes(r.response.payload).decode() for r in nested if r.response.warc_type == "response"}
    assert bodies == {long, "short", ""}


def test_empty_and_repeated_rows(spark, tmp_path, tuples):
    none = spark.createDataFrame([], SCHEMA)
    warc.write_archive(warc.with_roles(none), str(tmp_path / "e"))
    assert warc.assemble(warc.read_archives(spark, str(tmp_path / "e"))).count() == 0
    twice = spark.createDataFrame([(1, "http://a/1", "x" * 200, "c")] * 2 + [(None, "http://a/n", "x" * 200, "c")], SCHEMA)
    roles = warc.resolve_revisits(warc.page_roles(warc.assemble(warc.measured(run(spark, twice, str(tmp_path / "r"))))))
    assert tuples(roles, "page_id", "record_type", "refers_to") == [(1, "response", None), (1, "response", None), (None, "revisit", 1)]


def test_ids_repeated_with_other_payloads(spark, tmp_path, tuples):
    a, b = "a" * 200, "b" * 300
    pages = spark.createDataFrame([(1, "http://a/1", a, "c"), (1, "http://a/1", b, "c"), (2, "http://a/2", b, "c"), (2, None, "s", "c"), (None, None, b, "c"),
                                   (None, None, "s", "c")], SCHEMA)
    got = tuples(warc.resolve_revisits(warc.page_roles(warc.assemble(warc.measured(run(spark, pages, str(tmp_path / "w")))))),
                 "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    sha = {t: hashlib.sha256(t.encode()).hexdigest() for t in (a, b, "s")}
    assert got == sorted([(1, 200, sha[a], "response", None), (1, 300, sha[b], "response", None), (2, 300, sha[b], "revisit", 1), (2, 1, sha["s"], "response", None),
                          (None, 300, sha[b], "revisit", 1), (None, 1, sha["s"], "response", None)], key=str)


def test_a_very_long_page(spark, tmp_path, tuples):
    long = "ü<p>" * 2_000_000
    pages = spark.createDataFrame([(1, "u", long, "c"), (2, "u", long, "c")], SCHEMA)
    got = tuples(warc.resolve_revisits(warc.page_roles(warc.assemble(warc.measured(run(spark, pages, str(tmp_path / "w")))))),
                 "page_id", "payload_bytes", "record_type", "refers_to")
    assert got == [(1, 10_000_000, "response", None), (2, 10_000_000, "revisit", 1)]


def test_orphans_keep_a_row(spark):
    base = {"concurrent_to": None, "refers_to": None, "target_uri": None, "payload_digest": None, "http_header": None, "payload": b""}
    rows = [{**base, "record_id": "r1", "warc_type": "response"}, {**base, "record_id": "q2", "warc_type": "request", "concurrent_to": "r2"},
            {**base, "record_id": "m2", "warc_type": "metadata", "concurrent_to": "r2"}]
    names = [c.split()[0] for c in warc.RECORD.split(", ")]
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], warc.RECORD)
    got = {r.capture_id: (r.response is not None, r.request is not None, r.metadata is not None) for r in warc.assemble(df).collect()}
    assert got == {"r1": (True, False, False), "r2": (False, True, True)}


def test_query_parses_archives_once(spark, tmp_path, tuples, monkeypatch):
    """Assembly reads its records three times, so they must be a written table and not the parser's output."""
    pages = [(1, "http://h.example/a", "x" * 200), (2, "http://h.example/b", "x" * 200), (3, None, None)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    plans, assemble = [], warc.assemble
    monkeypatch.setattr(warc, "assemble", lambda r: plans.append(r._jdf.queryExecution().toString()) or assemble(r))
    got = queries.QUERIES["op1_warc_transactions"](spark, str(tmp_path))
    assert tuples(got, "page_id", "payload_bytes", "record_type", "refers_to") == [
        (1, 200, "response", None), (2, 200, "revisit", 1), (3, 0, "response", None)]
    assert len(plans) == 1 and "MapInArrow" not in plans[0]
