"""Cubes, multiset differences, stored sketches and signed deltas."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidedesk.operators import deltas, difference, sketches, totals


def test_cube_tells_nulls_from_totals(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["web", "chat", None]), rng.choice(["open", "closed"]), rng.choice([None, 5, 7, 11])) for _ in range(200)]
    df = spark.createDataFrame(rows, "channel string, status string, size int")
    small = totals.cells(df, ["channel", "status"], {"size": F.col("size")})
    got = {}
    for r in totals.subtotals(small, ["channel", "status"], ["size"]).collect():
        got[r.grouping_id, r.channel, r.status] = (r.n, r.size_sum, r.size_mean, r.size_min, r.size_max)
    want = {}
    for gid, (a, b) in {0: (1, 1), 1: (1, 0), 2: (0, 1), 3: (0, 0)}.items():
        for c, s in {(x[0] if a else None, x[1] if b else None) for x in rows}:
            mine = [x[2] for x in rows if (not a or x[0] == c) and (not b or x[1] == s)]
            v = [x for x in mine if x is not None]
            want[gid, c, s] = (len(mine), sum(v), sum(v) / len(v), min(v), max(v))
    assert got == want
    assert len([k for k in got if k[1] is None and k[2] is None]) == 2 and len([k for k in got if k[1] is None]) == 6
    named = {(r.channel, r.status): r.n for r in totals.named_totals(totals.subtotals(small, ["channel", "status"]), ["channel", "status"]).collect()}
    assert named["(all)", "(all)"] == 200 and named["(none)", "(all)"] == got[1, None, None][0]


def test_rollup_and_chosen_sets_in_one_scan(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", None), ("b", "x", None)], "p string, q string, v int")
    small = totals.cells(df, ["p", "q"], {"v": F.col("v")})
    rolled = {(r.grouping_id, r.p, r.q): (r.n, r.v_mean) for r in totals.subtotals(small, ["p", "q"], ["v"], "rollup").collect()}
    assert rolled == {(0, "a", "x"): (1, 1.0), (0, "a", "y"): (1, None), (0, "b", "x"): (1, None), (1, "a", None): (2, 1.0), (1, "b", None): (1, None), (3, None, None): (3, 1.0)}
    sets = totals.subtotals(small, ["p", "q"], sets=[["p"], ["q"], []])
    assert sorted((r.grouping_id, r.n) for r in sets.collect()) == [(1, 1), (1, 2), (2, 1), (2, 2), (3, 3)]
    assert sets._jdf.queryExecution().toString().count("Scan ExistingRDD") <= 3  # one per printed plan
    none = totals.subtotals(totals.cells(df.limit(0), ["p", "q"]), ["p", "q"])
    assert [r.n for r in none.collect()] in ([], [0])


SCHEMA = "k string, a int, b string, l array<int>, s struct<x:int,y:int>, _bucket double"


def multiset(seed, n):
    rng = random.Random(seed)
    return [(rng.choice([None, "p", "q", "r", "s"]), rng.choice([None, 1, 2]), rng.choice([None, "", "u"]), rng.choice([None, [1, None], [None, 1]]),
             rng.choice([None, (1, None), (None, 1)]), rng.choice([None, 0.0, float("nan")])) for _ in range(n)]


def frozen(r):
    return str(tuple(r))


def test_difference_against_counters(spark):
    a, b = multiset(1, 150), multiset(2, 140)
    before, after = spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)
    got = difference.row_differences(before, after.select(*reversed(after.columns)), ["k"], buckets=8).collect()
    x, y = Counter(map(frozen, [tuple(r) for r in before.collect()])), Counter(map(frozen, [tuple(r) for r in after.collect()]))
    want = {k: y[k] - x[k] for k in set(x) | set(y) if y[k] != x[k]}
    assert {frozen(tuple(r)[:-1]): r.copies for r in got} == want
    keys = {r.k: (r.n_added, r.n_removed, r.n_changed) for r in difference.key_differences(before, after, ["k"]).collect()}
    assert sum(v[0] + v[2] for v in keys.values()) == sum(n for n in want.values() if n > 0)
    assert sum(v[1] + v[2] for v in keys.values()) == -sum(n for n in want.values() if n < 0) and None in keys


def test_nulls_that_change_places_are_seen(spark):
    schema = "k int, a int, b int, s struct<x:int,y:int>"
    before = spark.createDataFrame([(1, None, 7, (None, 2)), (2, 1, 1, (None, 2))], schema)
    after = spark.createDataFrame([(1, 7, None, (None, 2)), (2, 1, 1, (2, None))], schema)
    assert sorted(tuple(r) for r in difference.key_differences(before, after, ["k"]).collect()) == [(1, 0, 0, 1), (2, 0, 0, 1)]


def test_equal_runs_compare_no_row(spark):
    rows = multiset(3, 400)
    before = spark.createDataFrame(rows, SCHEMA).repartition(3)
    after = spark.createDataFrame(list(reversed(rows)), SCHEMA).repartition(5, "a")
    ours = [difference.digests(df, ["k"]) for df in (before, after)]
    assert difference.unequal_buckets(*ours).count() == 0 and difference.row_differences(before, after, ["k"]).count() == 0
    one_more = after.union(after.limit(1))
    assert difference.unequal_buckets(ours[0], difference.digests(one_more, ["k"])).count() == 1
    assert [r.copies for r in difference.row_differences(before, one_more, ["k"]).collect()] == [1]
    # the rows meet their digests before any shuffle, and only digests cross one there
    text = spark._jvm.PythonSQLUtils.explainString(ours[0]._jdf.queryExecution(), "formatted")
    assert "partial_sum" in text
    empty = before.limit(0)
    assert difference.row_differences(empty, empty, ["k"]).count() == 0
    assert sum(r.copies for r in difference.row_differences(empty, before, ["k"]).collect()) == 400


def test_difference_refuses_maps_and_other_columns(spark):
    df = spark.range(1).select("id", F.create_map(F.lit("a"), F.lit(1)).alias("m"))
    with pytest.raises(ValueError, match="m is a map"):
        difference.row_differences(df, df, ["id"])
    with pytest.raises(ValueError, match="different columns"):
        difference.row_differences(df, df.drop("m"), ["id"])


def test_sketches_of_many_runs_keep_their_bounds(spark, tmp_path):
    path = str(tmp_path / "sketches")
    rng = random.Random(5)
    data = [(run, rng.choice(["web", "chat"]), rng.lognormvariate(5, 1), f"u{rng.randrange(6000)}") for run in range(5) for _ in range(8000)]
    df = spark.createDataFrame(data, "run int, channel string, size double, user string").repartition(8)
    for run in range(5):
        part = df.filter(F.col("run") == run)
        made = sketches.sketch(part, ["channel"], {"size": F.col("size")}, {"users": F.col("user")})
        sketches.store(made, path, f"run{run}")
        sketches.store(made, path, f"run{run}")  # a rerun replaces its own
    kept = sketches.stored(spark, path)
    for by, pick in ((["channel"], lambda r: True), ([], lambda r: True), ([], lambda r: r[0] < 2)):
        some = kept if pick(data[-1]) else kept.filter(F.col("run_id").isin("run0", "run1"))
        merged = sketches.merge(some, by)
        ranks = (0.01, 0.25, 0.5, 0.9, 0.99)
        for r in merged.select(*by, "n", sketches.distinct("users").alias("u"), *[sketches.quantile("size", q).alias(f"q{i}") for i, q in enumerate(ranks)],
                               sketches.share_below("size", F.lit(150.0)).alias("below")).collect():
            mine = [x for x in data if pick(x) and (not by or x[1] == r.channel)]
            v = sorted(x[2] for x in mine)
            assert r.n == len(v)
            for i, q in enumerate(ranks):
                assert abs(sum(x <= r[f"q{i}"] for x in v) / len(v) - q) <= sketches.RANK_ERROR + 1 / len(v)
            assert abs(r.below - sum(x <= 150 for x in v) / len(v)) <= sketches.RANK_ERROR
            users = len({x[3] for x in mine})
            assert abs(r.u - users) <= sketches.DISTINCT_ERROR * users
    # thresholds as of the rows: bound exact, shares within the rank error
    import statistics
    v = [x[2] for x in data]
    for r in sketches.sensitivity(sketches.merge(kept), "size").collect():
        bound = statistics.mean(v) + r.z * statistics.stdev(v)
        assert abs(r.bound - bound) < 1e-6 * bound and abs(r.share - sum(x > bound for x in v) / len(v)) <= sketches.RANK_ERROR


def test_sketches_of_nothing(spark):
    df = spark.createDataFrame([("a", None, None), ("b", 1.0, "u")], "g string, v double, u string")
    made = sketches.sketch(df, ["g"], {"v": F.col("v")}, {"u": F.col("u")})
    got = {r.g: (r.n, r.q, r.s, r.d) for r in made.select("g", "n", sketches.quantile("v", 0.5).alias("q"), sketches.share_below("v", F.lit(0.0)).alias("s"),
                                                        sketches.distinct("u").alias("d")).collect()}
    assert got == {"a": (1, None, None, 0), "b": (1, 1.0, 0.0, 1)}
    assert sketches.merge(made.limit(0)).select("n", sketches.quantile("v", 0.5), sketches.spike_bound("v", 3.0)).first()[0] == 0
    one = sketches.sensitivity(sketches.merge(made), "v").collect()
    assert [r.bound for r in one] == [None] * 3


def test_deltas_equal_a_recount(spark, tmp_path):
    path, rng = str(tmp_path / "log"), random.Random(7)
    live: list[tuple] = []
    ids = itertools.count()
    for seq in range(10):
        new = [(next(ids), rng.choice([None, "hot", *"abcdefgh"]), rng.choice([None, 1, 5])) for _ in range(60 if seq else 200)]
        gone = rng.sample(live, len(live) // 5)
        live = [r for r in live if r not in gone] + new
        schema = "id long, c string, v int"
        deltas.append(deltas.signed(spark.createDataFrame(new, schema), spark.createDataFrame(gone, schema)), path, seq, ["c"], {"total": F.col("v")})
        if seq == 4:
            deltas.append(deltas.signed(spark.createDataFrame(new, schema), spark.createDataFrame(gone, schema)), path, seq, ["c"], {"total": F.col("v")})

    def recount(rows):
        return {c: (sum(r[1] == c for r in rows), sum(r[2] or 0 for r in rows if r[1] == c)) for c in {r[1] for r in rows}}

    assert {r.c: (r.n, r.total) for r in deltas.current(spark, path, ["c"]).collect()} == recount(live)
    target = str(tmp_path / "compact")
    deltas.compact(spark, path, target, ["c"], 9)
    wipe = [(i, c, v) for i, c, v in live if c == "a"]
    deltas.append(deltas.signed(spark.createDataFrame([], "id long, c string, v int"), spark.createDataFrame(wipe, "id long, c string, v int")), target, 10, ["c"], {"total": F.col("v")})
    assert {r.c: (r.n, r.total) for r in deltas.current(spark, target, ["c"]).collect()} == recount([r for r in live if r[1] != "a"])
    near = deltas.touched(spark, target, ["c"], 10).collect()
    assert [(r.c, r.was_n, r.n) for r in near] == [("a", len(wipe), 0)]
    assert [r.repeat_contact for r in deltas.crossings(deltas.touched(spark, target, ["c"], 10)).collect()] == [False]


def test_a_small_delta_reads_little(spark, tmp_path):
    """Applying and judging a change set reads log rows of its own buckets, not the stored aggregate."""
    path = str(tmp_path / "log")
    deltas.append(deltas.signed(spark.range(20_000).select(F.col("id").cast("string").alias("c"))), path, 0, ["c"])
    deltas.append(deltas.signed(spark.createDataFrame([("5",), ("5",), ("new",)], "c string")), path, 1, ["c"])
    near = deltas.touched(spark, path, ["c"], 1)
    assert sorted(map(tuple, deltas.crossings(near).select("c", "was_n", "n", "repeat_contact").collect())) == [("5", 1, 3, True)]
    text = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(seq" in text and "bucket#" in text.split("PartitionFilters")[1].split("]")[0]
