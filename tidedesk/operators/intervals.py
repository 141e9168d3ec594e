"""Interval and overlap joins as equi-joins over time buckets of doubling size classes.

An interval belongs to the level whose bucket width is the least power of ``BASE`` (times the narrowest width)
that is at least its length, so it meets at most two buckets there, however wide it is. Two intervals meet at the
higher of their levels: every interval stands in the one or two buckets it meets at its own level and at each
higher level in use, and a pair is kept in the first bucket both meet, so it comes out once. Spark sees an
equality on (key, level, bucket) and joins by hash or sort-merge, never by nested loops.

Where only counts and extremes per interval are asked for, ``points_within`` gives them without the pairs, whose
number grows with the square of the density.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidedesk.operators.ordered import scan
from tidedesk.session import materialize

BASE_BITS = 2
#: A block holds two to this power of instants, or of blocks of the level below.
BLOCK_BITS = 6
#: A bucket is cut when it holds more than this share of an even shuffle partition.
PER_PARTITION = 16


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    *,
    key: str | None = None,
    width_seconds: float = 60.0,
) -> DataFrame:
    """Every pair of rows whose half-open time spans share an instant, under the same ``key`` if one is given.

    A span that ends where it starts is a point, and lies in a span that starts at it but not in one that ends
    there; two equal points meet. Rows without key or times, or whose end is before their start, meet nothing.
    Columns of both sides come out; they must not share names, but for ``key``. ``width_seconds`` is the narrowest
    bucket width and decides cost, not results.

    Buckets that hold many ``left`` rows are cut by a hash of the row and the ``right`` rows of such a bucket
    repeated per cut, so one hot instant is spread over tasks. Runs a Spark job when called.
    """
    shared = [c for c in left.columns if c in right.columns and c != key]
    if shared:
        raise ValueError(f"columns stand on both sides: {', '.join(shared)}")
    micros = max(1, int(width_seconds * 1_000_000))
    sides = [_spans(df, span, key, micros) for df, span in ((left, left_span), (right, right_span))]
    present = sides[0].select("_own").union(sides[1].select("_own")).distinct()
    levels = sorted(r["_own"] for r in present.collect())  # one row per level in use, some thirty at most
    a, b = (_placed(df, levels, micros) for df in sides)

    counts = materialize(a.groupBy("_k", "_level", "_bucket").agg(F.count("*").alias("n")), "interval-buckets")
    parts = PER_PARTITION * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    # fewer than ``parts`` buckets are above the share, and they have at most twice as many cuts
    share = max(total / parts, 1.0)
    heavy = counts.filter(F.col("n") > share).select(
        F.col("_k").alias("_hk"), F.col("_level").alias("_hl"), F.col("_bucket").alias("_hb"), F.ceil(F.col("n") / share).cast("int").alias("_cuts"))
    cut = (F.col("_k") == F.col("_hk")) & (F.col("_level") == F.col("_hl")) & (F.col("_bucket") == F.col("_hb"))
    cuts = F.coalesce("_cuts", F.lit(1))
    a = a.join(F.broadcast(heavy), cut, "left").withColumn("_cut", F.pmod(F.xxhash64("_row", "_lo", "_hi"), cuts).cast("int")).select(
        "_k", "_level", "_bucket", "_cut", "_own", "_first", "_lo", "_hi", "_row")
    b = b.join(F.broadcast(heavy), cut, "left").withColumn("_cut", F.explode(F.sequence(F.lit(0), cuts - 1))).select(
        *[F.col(c).alias(f"{c}2") for c in ("_k", "_level", "_bucket", "_cut", "_own", "_first", "_lo", "_hi", "_row")])

    same = [F.col(c) == F.col(f"{c}2") for c in ("_level", "_bucket", "_cut")]
    same.append(F.col("_k") == F.col("_k2"))
    once = (F.col("_level") == F.greatest("_own", "_own2")) & (F.col("_bucket") == F.greatest("_first", "_first2"))
    shares = F.greatest("_lo", "_lo2") < F.least("_hi", "_hi2")
    met = a.join(b, same, "inner").filter(once & shares)
    kept = [c for c in right.columns if c != key]
    return met.select("_row.*", *[F.col(f"_row2.{c}").alias(c) for c in kept])


def points_within(
    points: DataFrame, spans: DataFrame, at: str, span: tuple[str, str], value: str, *, key: str | None = None
) -> DataFrame:
    """The rows of ``spans`` that hold a point, with ``n_points`` and the ``least`` and ``most`` ``value`` among theirs.

    Points and spans meet as in ``overlap_join``, under the same ``key`` if one is given; nulls in ``value`` count as
    points but are no extremes. No pairs are made: instants get their place in time by an ordered scan, in which the
    ends of the spans stand too, so a count is a difference of two running totals. Extremes are kept per block of
    instants, per block of blocks and so on; a span asks two blocks per level at most, however much it holds. Runs
    Spark jobs when called.
    """
    clash = [c for c in ("n_points", "least", "most") if c in spans.columns]
    if clash:
        raise ValueError(f"columns of the result stand in spans: {', '.join(clash)}")
    asked = _spans(spans, span, key, 1).drop("_own")
    k = F.lit("") if key is None else F.col(key)
    instants = points.select(k.alias("_k"), F.unix_micros(at).alias("_t"), F.col(value).alias("_v")).filter(
        "_k is not null and _t is not null").groupBy("_k", "_t").agg(
        F.count("*").alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    ends = asked.select("_k", "_lo", "_hi").distinct().withColumn("_t", F.explode(F.array("_lo", "_hi")))
    # an end stands before the instant at its time, and so has behind it what is earlier
    both = instants.withColumns({"_side": F.lit(1), "_one": F.lit(1).cast("long")}).unionByName(
        ends.withColumn("_side", F.lit(0)), allowMissingColumns=True)
    placed = materialize(scan(both, "_k", ["_t", "_side"], sums={"_points": "_n", "_place": "_one"}), "points-placed")

    def until(total: str, end: str):
        return F.max(F.when(F.col("_t") == F.col(end), F.coalesce(total, F.lit(0))))

    reach = materialize(placed.filter("_side = 0").groupBy("_k", "_lo", "_hi").agg(
        until("_place", "_lo").alias("_a"), (until("_place", "_hi") - 1).alias("_b"),
        (until("_points", "_hi") - until("_points", "_lo")).alias("n_points")).filter("n_points > 0"), "points-reach")
    nodes = placed.filter("_side = 1").select("_k", (F.col("_place") - 1).alias("_at"), "_least", "_most")
    last = nodes.agg(F.max("_at")).first()[0] or 0

    within, found = 2**BLOCK_BITS - 1, None
    while True:
        blocks = materialize(_blocks(nodes), "points-blocks")
        block = {c: F.shiftright(c, BLOCK_BITS) for c in ("_a", "_b")}
        inside = {c: F.col(c).bitwiseAND(F.lit(within)) for c in ("_a", "_b")}
        whole = F.array(F.struct(block["_a"].alias("_block"), inside["_a"].alias("_from"), inside["_b"].alias("_to")))
        parts = F.array(F.struct(block["_a"].alias("_block"), inside["_a"].alias("_from"), F.lit(within).cast("long").alias("_to")),
                        F.struct(block["_b"].alias("_block"), F.lit(0).cast("long").alias("_from"), inside["_b"].alias("_to")))
        pieces = reach.select("_k", "_lo", "_hi", "n_points", F.inline(F.when(block["_a"] == block["_b"], whole).otherwise(parts)))
        of = F.lit(1) + F.col("_from").cast("int"), (F.col("_to") - F.col("_from") + 1).cast("int")
        here = pieces.join(blocks, ["_k", "_block"]).select(
            "_k", "_lo", "_hi", "n_points", F.array_min(F.slice("_leasts", *of)).alias("least"), F.array_max(F.slice("_mosts", *of)).alias("most"))
        found = here if found is None else found.unionByName(here)
        last >>= BLOCK_BITS
        if not last:
            break
        # what is left lies between the two blocks, and is whole blocks
        reach = reach.withColumns({"_a": block["_a"] + 1, "_b": block["_b"] - 1}).filter("_a <= _b")
        nodes = blocks.select("_k", F.col("_block").alias("_at"), F.array_min("_leasts").alias("_least"), F.array_max("_mosts").alias("_most"))

    totals = found.groupBy("_k", "_lo", "_hi", "n_points").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    return asked.join(totals, ["_k", "_lo", "_hi"]).select("_row.*", "n_points", "least", "most")


def _blocks(nodes: DataFrame) -> DataFrame:
    """``_k, _block, _leasts, _mosts``: the extremes of the nodes of each block, in their order; places have no gaps."""
    each = F.array_sort(F.collect_list(F.struct("_at", "_least", "_most")))
    rows = nodes.groupBy("_k", F.shiftright("_at", BLOCK_BITS).alias("_block")).agg(each.alias("_each"))
    return rows.select("_k", "_block", F.col("_each._least").alias("_leasts"), F.col("_each._most").alias("_mosts"))


def _spans(df: DataFrame, span: tuple[str, str], key: str | None, micros: int) -> DataFrame:
    """``_row, _k, _lo, _hi, _own``: the valid rows with their span in microseconds and their level."""
    k = F.lit("") if key is None else F.col(key)
    spans = df.select(F.struct(*[df[c] for c in df.columns]).alias("_row"), k.alias("_k"),
                      F.unix_micros(span[0]).alias("_lo"), F.unix_micros(span[1]).alias("_hi"))
    # a point becomes the microsecond that begins at it
    spans = spans.filter("_k is not null and _lo is not null and _hi is not null and _hi >= _lo").withColumn(
        "_hi", F.greatest("_hi", F.col("_lo") + 1))
    length = F.greatest(F.ceil((F.col("_hi") - F.col("_lo")) / F.lit(micros)), F.lit(1))
    # bits of (length - 1) tell the least power of two that is not below it
    bits = F.when(length <= 1, 0).otherwise(F.length(F.bin(length - 1)))
    return spans.withColumn("_own", F.ceil(bits / F.lit(BASE_BITS)).cast("int"))


def _placed(spans: DataFrame, levels: list[int], micros: int) -> DataFrame:
    """A row for each bucket that a span meets at its own level and at every higher one of ``levels``."""
    at = F.filter(F.array(*[F.lit(x) for x in levels]).cast("array<int>"), lambda x: x >= F.col("_own"))
    wide = spans.withColumn("_level", F.explode(at)).withColumn("_w", F.expr(f"shiftleft({micros}L, _level * {BASE_BITS})"))
    first, last = (F.expr(f"({x} - pmod({x}, _w)) div _w") for x in ("_lo", "(_hi - 1)"))
    return wide.withColumn("_first", first).withColumn("_bucket", F.explode(F.sequence("_first", last))).drop("_w")
