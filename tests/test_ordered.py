"""Ordered scans, as-of joins and interval joins against plain Python, and their balance under hot keys."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from tidedesk.operators import intervals, ordered

T0 = dt.datetime(2024, 1, 1)


def at(s):
    return None if s is None else T0 + dt.timedelta(seconds=s)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().toString()


def test_scan_against_plain_python(spark):
    rng = random.Random(1)
    rows = [(i, "hot" if i % 3 == 0 else f"c{i % 20}", rng.randrange(40), rng.choice([None, 1, 2, 5]), "x") for i in range(600)]
    rows += [(900, None, 3, 1, "x"), (901, None, 4, 1, "x")]
    df = spark.createDataFrame(rows, "id long, k string, t long, v long, _range string").repartition(3)
    got = ordered.scan(df, "k", ["t", "id"], count="n", sums={"total": "v"}, previous={"before": "v", "before_id": "id"}, last={"seen": "v"}, ranges=16)
    assert got.columns == [*df.columns, "n", "total", "before", "before_id", "seen"]
    want = {}
    for k in {r[1] for r in rows if r[1]}:
        total, seen, prev = None, None, (None, None)
        for n, (i, _, _, v, _) in enumerate(sorted((r for r in rows if r[1] == k), key=lambda r: (r[2], r[0])), 1):
            total = total if v is None else (total or 0) + v
            seen = seen if v is None else v
            want[i] = (n, total, prev[0], prev[1], seen)
            prev = (v, i)
    want |= {900: (None,) * 5, 901: (None,) * 5}
    assert {r.id: (r.n, r.total, r.before, r.before_id, r.seen) for r in got.collect()} == want


def test_scan_spreads_a_hot_key(spark):
    """A third of the rows under one key: no task of the window has more than twice the mean."""
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        df = spark.range(60_000).select(F.col("id").alias("row_seq"), F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 900).alias("customer_id"),
                                        F.timestamp_seconds("id").alias("created_at"))
        out = ordered.contact_gaps(df)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 60_000 and len(sizes) >= 38 and max(sizes) <= 2 * 60_000 / len(sizes)
        hot = out.filter("customer_id = -1").agg(F.max("contact_no"), F.expr("count_if(gap_seconds = 3)"), F.expr("count_if(gap_seconds is null)")).first()
        assert tuple(hot) == (20_000, 19_999, 1)
        text = plan(out)
        assert "shufflepartitionidpassthrough" in text and "SinglePartition" not in text
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_gaps_without_time_or_customer(spark):
    df = spark.createDataFrame([(1, "a", at(5)), (2, "a", None), (3, None, at(1)), (4, "a", at(2)), (5, "a", at(2)), (5, "a", at(2))],
                               "row_seq long, customer_id string, created_at timestamp")
    got = sorted(((r.row_seq, r.contact_no, r.gap_seconds) for r in ordered.contact_gaps(df).collect()), key=str)
    assert got == [(1, 4, 3.0), (2, None, None), (3, None, None), (4, 1, None), (5, 2, 0.0), (5, 3, 0.0)]
    assert ordered.contact_gaps(df.limit(0)).count() == 0


LEFT = [(1, "a", 10), (2, "a", 5), (3, "a", 4), (4, "b", 10), (5, None, 10), (6, "a", None), (7, "a", 30), (7, "a", 30), (8, "c", 1)]
RIGHT = [("a", 5, 1, "a5-1"), ("a", 5, 2, "a5-2"), ("a", 10, 3, "a10"), ("b", 11, 4, "b11"), (None, 1, 5, "none"), ("a", None, 6, "never"), ("a", 20, 7, None)]


def brute_asof(strict, forward, tolerance):
    out = []
    for i, k, t in LEFT:
        best = None
        for rk, rt, seq, v in RIGHT:
            if k is None or t is None or rk != k or rt is None:
                continue
            gap = (rt - t) if forward else (t - rt)
            if gap < 0 or (strict and gap == 0) or (tolerance is not None and gap > tolerance):
                continue
            if best is None or (gap, -seq) < best[0]:
                best = ((gap, -seq), v, seq)
        out.append((i, best[1] if best else None, best[2] if best else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("tolerance", [None, 5])
def test_asof_against_brute_force(spark, strict, forward, tolerance):
    left = spark.createDataFrame([(i, k, at(t), "w") for i, k, t in LEFT], "id long, k string, t timestamp, found string")
    right = spark.createDataFrame([(k, at(t), s, v) for k, t, s, v in RIGHT], "rk string, rt timestamp, seq long, v string")
    got = ordered.asof_join(left, right, "k", "t", "rt", ["v", "seq"], right_key="rk", right_seq="seq", strict=strict, forward=forward, tolerance_seconds=tolerance)
    assert got.columns == ["id", "k", "t", "found", "v", "seq"]
    assert sorted(((r.id, r.v, r.seq) for r in got.collect()), key=str) == brute_asof(strict, forward, tolerance)


def test_asof_moves_wide_rows_once_and_splits_a_hot_key(spark, no_broadcast):
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        left = spark.range(30_000).select("id", F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 2 + 1).alias("t"), F.repeat(F.col("id").cast("string"), 10).alias("body"))
        right = spark.range(3_000).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 20).alias("rt"), F.col("id").alias("v"))
        got = ordered.asof_join(left, right, "k", "t", "rt", ["v"], left_id="id")
        assert got.filter(F.col("v") != F.floor((F.col("id") * 2 + 1) / 20)).count() == 0 and got.filter("v is null").count() == 0
        text = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
        assert len(re.findall(r"\) Exchange\nInput \[\d+\]: \[[^\]]*\bbody#", text)) == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_asof_refuses_clashing_columns_and_takes_empty_sides(spark):
    left = spark.createDataFrame([(1, "a", at(1))], "id long, k string, t timestamp")
    with pytest.raises(ValueError, match="both sides: id"):
        ordered.asof_join(left, left, "k", "t", "t", ["id"])
    none = spark.createDataFrame([], "k string, rt timestamp, v long")
    assert [tuple(r)[3] for r in ordered.asof_join(left, none, "k", "t", "rt", ["v"]).collect()] == [None]
    assert ordered.asof_join(left.limit(0), none, "k", "t", "rt", ["v"]).count() == 0


def spans(rng, n, long):
    out = []
    for i in range(n):
        a = rng.randrange(-3000, 3000)
        width = rng.choice([0, 0, 1, 7, 60, 61, 240, long])
        out.append((i, f"k{i % 2}" if i % 9 else None, a, a + width))
    return out + [(n, "k0", 5, 4), (n + 1, "k0", None, 4), (n + 2, "k0", 4, None), (3, "k1", 10, 20), (3, "k1", 10, 20)]


def meets(a, b, key):
    if None in (*a[2:], *b[2:]) or a[3] < a[2] or b[3] < b[2] or (key and (a[1] is None or a[1] != b[1])):
        return False
    tiny = 1e-6
    return max(a[2], b[2]) < min(max(a[3], a[2] + tiny), max(b[3], b[2] + tiny))


@pytest.mark.parametrize("key", [None, "k"])
def test_overlaps_against_brute_force(spark, no_broadcast, key):
    rng = random.Random(3)
    a, b = spans(rng, 120, 5000), spans(rng, 90, 100_000)
    left = spark.createDataFrame([(i, k, at(x), at(y), "w") for i, k, x, y in a], "id long, k string, a timestamp, b timestamp, _level string")
    right = spark.createDataFrame([(i, k, at(x), at(y)) for i, k, x, y in b], "other long, k string, c timestamp, d timestamp")
    right = right if key else right.withColumnRenamed("k", "k2")
    got = intervals.overlap_join(left, right, ("a", "b"), ("c", "d"), key=key, width_seconds=30)
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
    pairs = sorted((r.id, r.other) for r in got.collect())
    assert pairs == sorted((x[0], y[0]) for x in a for y in b if meets(x, y, key)) and len(pairs) > 500


def test_wide_intervals_meet_few_buckets(spark):
    wide = spark.createDataFrame([(1, at(0), at(10 ** 9)), (2, at(0), at(1))], "id long, a timestamp, b timestamp")
    placed = intervals._placed(intervals._spans(wide, ("a", "b"), None, 1_000_000), [0, 15], 1_000_000)
    assert {(r.id, r.n) for r in placed.groupBy("_row.id").agg(F.count("*").alias("n")).select("id", "n").collect()} <= {(1, 1), (1, 2), (2, 2)}


def test_hot_instant_is_cut(spark, no_broadcast):
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        points = spark.range(20_000).select("id", F.timestamp_seconds(F.when(F.col("id") % 3 == 0, 50_000).otherwise(F.col("id"))).alias("t"))
        points = points.withColumn("u", F.col("t"))
        windows = spark.createDataFrame([(1, dt.datetime(1970, 1, 1, 13), dt.datetime(1970, 1, 1, 15)), (2, dt.datetime(1970, 1, 1), dt.datetime(1970, 1, 1, 1))],
                                        "w long, a timestamp, b timestamp")
        met = intervals.overlap_join(points, windows, ("t", "u"), ("a", "b"))
        by = {r.w: r.n for r in met.groupBy("w").agg(F.count("*").alias("n")).collect()}
        assert by == {1: 6667, 2: 2400}
        sizes = [r["count"] for r in met.filter("w = 1").groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) > 10 and max(sizes) < 6667 / 4
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("key", [None, "k"])
def test_points_within_against_brute_force(spark, no_broadcast, key):
    rng = random.Random(4)
    a = [(i if i % 7 else None, k, x, x) for i, k, x, _ in spans(rng, 700, 0) if x is not None] + [(9999, "k0", None, None)]
    b = spans(rng, 150, 100_000)
    points = spark.createDataFrame([(i, k, at(x)) for i, k, x, _ in a], "id long, k string, t timestamp").repartition(3)
    windows = spark.createDataFrame([(i, k, at(x), at(y)) for i, k, x, y in b], "other long, k string, c timestamp, d timestamp")
    got = intervals.points_within(points, windows, "t", ("c", "d"), "id", key=key)
    expected = []
    for y in b:
        ids = [x[0] for x in a if meets(x, y, key)]
        known = [i for i in ids if i is not None]
        if ids:
            expected.append((y[0], y[1], at(y[2]), at(y[3]), len(ids), min(known, default=None), max(known, default=None)))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str) and 60 < len(expected) < len(b)
    assert {1, 2} <= {e[4] for e in expected} and max(e[4] for e in expected) > (300 if key else 600)


def test_points_within_makes_no_pairs(spark, no_broadcast, monkeypatch):
    # 5,000 points and 1,000 spans over three levels of blocks: two and a half million pairs
    monkeypatch.setattr(intervals, "BLOCK_BITS", 4)
    points = spark.range(5_000).select("id", F.timestamp_seconds("id").alias("t"))
    windows = spark.range(1_000).select(F.col("id").alias("w"), F.timestamp_seconds("id").alias("c"), F.timestamp_seconds(F.lit(4_000) + F.col("id") % 900).alias("d"))
    got = intervals.points_within(points, windows, "t", ("c", "d"), "id")
    rows = got.collect()
    assert {(r.w, r.n_points, r.least, r.most) for r in rows} == {(w, 4_000 + w % 900 - w, w, 3_999 + w % 900) for w in range(1_000)}


def test_points_within_nothing(spark):
    none = spark.createDataFrame([], "id long, t timestamp")
    some = spark.createDataFrame([(1, at(0), at(1))], "o long, c timestamp, d timestamp")
    assert intervals.points_within(none, some, "t", ("c", "d"), "id").count() == 0
    one = spark.createDataFrame([(1, at(0))], "id long, t timestamp")
    assert intervals.points_within(one, some.limit(0), "t", ("c", "d"), "id").count() == 0
    with pytest.raises(ValueError, match="least"):
        intervals.points_within(one, some.withColumnRenamed("o", "least"), "t", ("c", "d"), "id")


def test_overlap_of_nothing(spark):
    none = spark.createDataFrame([], "id long, a timestamp, b timestamp")
    some = spark.createDataFrame([(1, at(0), at(1))], "o long, c timestamp, d timestamp")
    assert intervals.overlap_join(none, some, ("a", "b"), ("c", "d")).count() == 0
    with pytest.raises(ValueError, match="both sides"):
        intervals.overlap_join(some, some, ("c", "d"), ("c", "d"))
