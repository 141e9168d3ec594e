import os

import pytest

from tidedesk.sources import sinks
from tidedesk.sources.tickets import NoInputError, list_files, null_tokens, read_tickets
from tidedesk.streaming.intake import clean_stream, write_stream


def put(base, name, text):
    path = base / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_columns_are_matched_by_name(spark, tmp_path):
    put(tmp_path, "a one.csv", "ticket_id,subject\n1,first\n2,\"two, and\n a half\"\n")
    put(tmp_path, "nested/b.csv", "subject,extra,ticket_id\n\"say \"\"hi\"\"\",x,3\nN/A,null,4\n")
    put(tmp_path, "c.txt", "ticket_id,subject\n9,no\n")
    rows = read_tickets(spark, str(tmp_path)).orderBy("row_seq").collect()
    assert [(r.ticket_id, r.subject, r.extra) for r in rows] == [
        ("1", "first", None), ("2", "two, and\n a half", None), ("3", 'say "hi"', "x"), ("4", None, None)]
    assert [r.row_seq >> 40 for r in rows] == [0, 0, 1, 1]
    assert list_files(spark, str(tmp_path)).count() == 2


def test_empty_files_have_no_rows(spark, tmp_path):
    put(tmp_path, "a.csv", "")
    with pytest.raises(NoInputError):
        read_tickets(spark, str(tmp_path))
    put(tmp_path, "b.csv", "ticket_id\n1\n")
    put(tmp_path, "c.csv", "ticket_id\n")
    assert [r.ticket_id for r in read_tickets(spark, str(tmp_path)).collect()] == ["1"]


def test_one_header_needs_no_list_of_files(spark, tmp_path):
    for i in range(5):
        put(tmp_path, f"d{i}/{i}.csv", f"ticket_id,subject\n{i},x\n")
    put(tmp_path, "empty.csv", "")
    put(tmp_path, "other.txt", "ticket_id\n9\n")
    df = read_tickets(spark, str(tmp_path))
    assert [r.ticket_id for r in df.orderBy("row_seq").collect()] == list("01234")
    assert "InMemoryFileIndex(1 paths)" in df._jdf.queryExecution().executedPlan().toString().split("Scan csv")[1]


def test_no_files(spark, tmp_path):
    put(tmp_path, "readme.txt", "x")
    with pytest.raises(NoInputError):
        read_tickets(spark, str(tmp_path))


def test_row_order_survives_splits(spark, tmp_path):
    for f in range(3):
        put(tmp_path, f"{f}.csv", "ticket_id\n" + "".join(f"{f}{i:05d}\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        df = read_tickets(spark, str(tmp_path), columns=["ticket_id"], multi_line=False)
        assert df.rdd.getNumPartitions() > 6
        ids = [r.ticket_id for r in df.orderBy("row_seq").collect()]
        seqs = {r.row_seq for r in df.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert ids == sorted(ids) and len(ids) == len(seqs) == 9000


def test_null_tokens(spark):
    df = spark.createDataFrame([("NA", 1), ("nan", 2), ("", 3), ("na", 4), ("<NA>", 5)], "a string, b int")
    assert [r.a for r in null_tokens(df).orderBy("b").collect()] == [None, None, None, "na", None]


def test_channel_copy_is_replaced(spark, make_tickets, tmp_path):
    path = str(tmp_path / "by")
    assert sinks.write_by_channel(make_tickets({}, {"channel": "chat"}), path) == 2
    assert sinks.write_by_channel(make_tickets({"channel": "phone"}), path) == 1
    assert sorted(n for n in os.listdir(path) if n.startswith("channel=")) == ["channel=phone"]


def test_json_lines(spark, tmp_path):
    path, schema = str(tmp_path / "log"), "a long, m map<string,string>"
    assert sinks.read_rows(spark, path, schema).count() == 0
    one = spark.createDataFrame([(1, {"k": "v"})], schema)
    sinks.append_rows(one, path)
    sinks.append_rows(one, path)
    put(tmp_path / "log", "part-x.json", '\n{"a": 7}\n   \n')
    assert sorted((r.a, r.m) for r in sinks.read_rows(spark, path, schema).collect() if r.a == 1) == [(1, {"k": "v"})] * 2
    assert sinks.read_rows(spark, path, schema).count() == 3
    sinks.replace_rows(one, path)
    assert sinks.read_rows(spark, path, schema).count() == 1


def test_table_and_report(spark, make_tickets, tmp_path):
    t = sinks.write_table(make_tickets({}, {}), str(tmp_path / "t"))
    assert t.count() == 2
    r = sinks.report_json(t.groupBy("channel").count(), str(tmp_path / "r"))
    assert [tuple(x) for x in r.collect()] == [("web", 2)]
    assert len([f for f in os.listdir(tmp_path / "r") if f.endswith(".json")]) == 1


def test_the_row_stages_run_on_a_stream(spark, make_tickets, tmp_path):
    raw = make_tickets({}, {"subject": " "}, {"body": "<br>"})
    raw.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(raw.schema).parquet(str(tmp_path / "in"))
    q = write_stream(clean_stream(stream, "t", "2024-02-01"), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert q.awaitTermination(60)
    got = sorted(map(str, spark.read.parquet(str(tmp_path / "out")).collect()))
    assert got == sorted(map(str, clean_stream(raw, "t", "2024-02-01").collect()))
