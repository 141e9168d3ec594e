"""The byte-range source: the same rows as the CSV scan whatever the split, headers from first bytes, offsets of a stream."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tidedesk.sources import ranges
from tidedesk.sources.tickets import NoInputError, read_tickets


def put(base, name, text, changed=None):
    path = base / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode("utf-8"))
    if changed:
        os.utime(path, (changed, changed))


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("row_seq").collect()]


def test_same_rows_and_order_as_the_csv_scan(spark, tmp_path):
    rng = random.Random(3)
    for f in range(4):
        names = ["ticket_id", "subject", "extra"][: 2 + f % 2]
        rng.shuffle(names)
        body = [",".join({"ticket_id": f"{f}-{i}", "subject": rng.choice(["", "NA", '"a, ""b"""', "ünï", "x" * 50]), "extra": "e"}[n] for n in names) for i in range(300)]
        put(tmp_path, f"d{f}/part {f}.csv", "﻿" * (f == 1) + ",".join(names) + "\n" + "\n".join(body) + "\n" * (f % 2))
    put(tmp_path, "_hidden/x.csv", "ticket_id\n9\n")
    put(tmp_path, "x.txt", "ticket_id\n9\n")
    put(tmp_path, "z empty.csv", "")
    want = rows(read_tickets(spark, str(tmp_path), multi_line=False), "ticket_id", "subject", "extra")
    assert len(want) == 1200
    seqs = set()
    for split in (17, 1000, 1 << 20):
        df = ranges.read_files(spark, str(tmp_path), split_bytes=split)
        assert rows(df, "ticket_id", "subject", "extra") == want
        seqs.add(tuple(r.row_seq for r in df.orderBy("row_seq").collect()))
    assert len(seqs) == 1 and len(set(*seqs)) == 1200
    assert ranges.read_files(spark, str(tmp_path), split_bytes=1000).rdd.getNumPartitions() > 12
    assert ranges.read_files(spark, str(tmp_path), ["extra"], split_bytes=1000).columns == ["extra", "row_seq"]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_every_split_of_a_small_file(tmp_path, end):
    text = end.join(["a,b", "1,x", "", "22,ü", "333,", '4,"q"']) + end
    put(tmp_path, "f.csv", text)
    size, uri = len(text.encode()), str(tmp_path / "f.csv")
    whole = list(ranges.records(uri, 0, size, "csv", False, ["b", "a", "c"]))
    assert [c for _, c in whole] == [["x", "1", None], ["ü", "22", None], ["", "333", None], ["q", "4", None]]
    for step in range(1, size + 1):
        parts = [x for a in range(0, size, step) for x in ranges.records(uri, a, min(a + step, size), "csv", False, ["b", "a", "c"])]
        assert parts == whole


def test_line_breaks_in_cells(spark, tmp_path):
    put(tmp_path, "f.csv", 'a,b\n1,"two\nlines"\n2,"\n\n"\n3,x')
    df = ranges.read_files(spark, str(tmp_path), multi_line=True, split_bytes=4)
    assert rows(df, "a", "b") == [("1", "two\nlines"), ("2", "\n\n"), ("3", "x")]
    assert [r.row_seq for r in df.orderBy("row_seq").collect()] == [4, 18, 25]


def test_headers_come_from_first_bytes(spark, tmp_path, monkeypatch):
    for i in range(70):
        put(tmp_path, f"{i:03d}.csv", f"a,c{i % 3}\n" + "x,y\n" * 10)
    df = ranges.headers(spark, str(tmp_path))
    assert df.rdd.getNumPartitions() == 2
    assert {tuple(r.head) for r in df.collect()} == {("a", "c0"), ("a", "c1"), ("a", "c2")}
    assert ranges.read_files(spark, str(tmp_path)).columns == ["a", "c0", "c1", "c2", "row_seq"]


def test_json_lines(spark, tmp_path):
    put(tmp_path, "a.json", '{"a": "x", "b": 1}\n\n{"b": {"c": [1]}, "a": null}\n{"a": "ü"}')
    df = ranges.read_files(spark, str(tmp_path), ["a", "b"], pattern="*.json", kind="json", split_bytes=7)
    assert rows(df, "a", "b") == [("x", "1"), (None, '{"c": [1]}'), ("ü", None)]
    with pytest.raises(ValueError, match="columns"):
        ranges.read_files(spark, str(tmp_path), kind="json")


def test_nothing_to_read(spark, tmp_path):
    with pytest.raises(Exception, match="no file matches"):
        ranges.read_files(spark, str(tmp_path), ["a"]).collect()
    with pytest.raises(Exception, match="no file matches"):
        ranges.read_files(spark, str(tmp_path / "absent"), ["a"]).collect()
    put(tmp_path, "a.csv", "")
    with pytest.raises(NoInputError, match="empty"):
        ranges.read_files(spark, str(tmp_path))
    put(tmp_path, "b.csv", "a\n")
    assert ranges.read_files(spark, str(tmp_path)).count() == 0


def test_a_stream_goes_on_from_its_offset(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    put(source, "b.csv", "a,k\n" + "".join(f"b{i},1\n" for i in range(50)), 1_700_000_000)

    def run():
        frame = ranges.follow_files(spark, str(source), ["a", "k", "more"], split_bytes=64)
        query = frame.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/ck").trigger(availableNow=True).start()
        query.awaitTermination()
        return [r.a for r in spark.read.parquet(f"{out}/rows").orderBy("row_seq").collect()]

    first = [f"b{i}" for i in range(50)]
    assert run() == first
    assert run() == first
    put(source, "a.csv", "k,a,more\n1,later,m\n", 1_700_000_009)
    assert run() == [*first, "later"]
    put(source, "c.csv", "a\nsame time\n", 1_700_000_009)
    assert sorted(run()) == sorted([*first, "later", "same time"])
    assert spark.read.parquet(f"{out}/rows").filter(F.col("more").isNotNull()).count() == 1
