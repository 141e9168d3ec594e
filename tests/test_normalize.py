import datetime as dt

import pytest

from tidedesk.operators.normalize import (
    InvalidEnumError, MissingColumnsError, enum_violations, normalize, require_columns,
)
from tidedesk.schema import TICKET_COLUMNS

AT = "2024-02-01T00:00:00Z"


def norm(df):
    return normalize(df, AT).orderBy("row_seq").collect()


def test_sixteen_columns(make_tickets):
    out = normalize(make_tickets().drop("row_seq"), AT)
    assert len(out.columns) == 16
    assert out.columns[:10] == TICKET_COLUMNS
    assert out.columns[-2:] == ["_schema_version", "_processed_at"]


def test_extra_columns_pass(make_tickets):
    assert "row_seq" in normalize(make_tickets(), AT).columns


def test_missing_columns_are_all_named(make_tickets):
    with pytest.raises(MissingColumnsError) as e:
        require_columns(make_tickets().drop("body", "status"))
    assert "body" in str(e.value) and "status" in str(e.value)


@pytest.mark.parametrize("text, want", [
    ("2024-01-15T10:30:00Z", dt.datetime(2024, 1, 15, 10, 30)),
    ("2024-01-15 10:30:00+02:00", dt.datetime(2024, 1, 15, 8, 30)),
    ("2024-01-15", dt.datetime(2024, 1, 15)),
    (" 2024-01-15 10:30:00 ", dt.datetime(2024, 1, 15, 10, 30)),
    ("2024", dt.datetime(2024, 1, 1)),
    ("01/02/2024", dt.datetime(2024, 1, 2)),
    ("13/02/2024", dt.datetime(2024, 2, 13)),
    ("2024/03/04 05:06:07", dt.datetime(2024, 3, 4, 5, 6, 7)),
    ("Jan 5 2024", dt.datetime(2024, 1, 5)),
    ("5 Jan 2024", dt.datetime(2024, 1, 5)),
    ("20240115", dt.datetime(2024, 1, 15)),
    ("31/02/2024", None), ("yesterday", None), ("now", None), ("today", None), ("10:30", None),
    ("", None), (None, None),
])
def test_created_at(make_tickets, text, want):
    r = norm(make_tickets({"created_at": text}))[0]
    assert r.created_at == want
    assert r.parse_error is (want is None)


def test_enums(make_tickets):
    rows = norm(make_tickets(
        {"channel": " Web ", "status": "CLOSED", "category": "Technical", "priority": " LOW"},
        {"channel": "fax", "status": "", "category": None, "priority": "urgent"},
        {"channel": None, "status": None, "category": "x", "priority": None},
    ))
    assert [(r.channel, r.status, r.category, r.priority, r.priority_normalized) for r in rows] == [
        ("web", "closed", "technical", "low", True),
        ("unknown", "unknown", "unknown", None, False),
        ("unknown", "unknown", "unknown", None, False),
    ]


def test_strip_knows_unicode_space(make_tickets):
    r = norm(make_tickets({"subject": "   hi\tthere 　", "customer_id": " c 1\x1f"}))[0]
    assert (r.subject, r.customer_id) == ("hi\tthere", "c 1")


def test_blank_text_is_null_but_blank_id_stays(make_tickets):
    r = norm(make_tickets({"subject": " \n", "body": "", "agent_id": "  "}))[0]
    assert (r.subject, r.body, r.agent_id) == (None, None, "")


@pytest.mark.parametrize("body, want, flag", [
    ("<p>Hello <b>you</b></p>", "Hello you", True),
    ("<br>", "", True),
    (" <br> x", " x", True),
    ("1 < 2 and 3 > 1", "1  1", True),
    ("a < b", "a < b", False),
    ("<>", "<>", False),
    ("line <a\nhref=x>y", "line y", True),
    (None, None, False),
])
def test_html(make_tickets, body, want, flag):
    r = norm(make_tickets({"body": body}))[0]
    assert (r.body, r.html_stripped) == (want, flag)


@pytest.mark.parametrize("ident, bad", [
    ("6f1c2f3e-8a52-4c1d-9b3a-0123456789ab", False),
    (" 6F1C2F3E-8A52-4C1D-9B3A-0123456789AB ", False),
    ("6f1c2f3e-8a52-1c1d-9b3a-0123456789ab", True),
    ("6f1c2f3e-8a52-4c1d-cb3a-0123456789ab", True),
    ("6f1c2f3e-8a52-4c1d-9b3a-0123456789ab0", True),
    ("6f1c2f3e-8a52-4c1d-9b3a-0123456789ab\nx", True),
    (None, True),
])
def test_uuid(make_tickets, ident, bad):
    assert norm(make_tickets({"ticket_id": ident}))[0].invalid_ticket_id is bad


def test_strict(make_tickets):
    bad = make_tickets({"channel": "Fax"}, {"status": ""}, {"priority": None})
    with pytest.raises(InvalidEnumError) as e:
        normalize(bad, AT, strict=True)
    assert "channel: 1" in str(e.value) and "status: 1" in str(e.value) and "priority" not in str(e.value)
    listed = bad.sparkSession.read.parquet(str(e.value).rsplit(" ", 1)[1])
    assert {tuple(r) for r in listed.collect()} == {("channel", "fax"), ("status", "")}
    assert normalize(make_tickets({"priority": None}), AT, strict=True).count() == 1
    assert enum_violations(bad).count() == 2


def test_rows_kept_and_repeatable(make_tickets):
    df = make_tickets({"channel": "fax", "body": "<p>a</p>"}, {"created_at": "broken"}, {"subject": " "})
    once = normalize(df, AT)
    again = normalize(once.withColumn("created_at", once.created_at.cast("string")), AT)
    keep = [c for c in once.columns if c not in ("html_stripped",)]
    assert once.count() == 3
    assert sorted(map(str, once.select(*keep).collect())) == sorted(map(str, again.select(*keep).collect()))


def test_needs_utc(spark, make_tickets):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError):
            normalize(make_tickets(), AT)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_empty(make_tickets):
    assert normalize(make_tickets().limit(0), AT).count() == 0


def test_narrow_plan(make_tickets):
    plan = normalize(make_tickets(), AT)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
