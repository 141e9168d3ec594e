"""Ordered computations per key that stay balanced whatever the keys: a two-level prefix scan.

Rows are dealt by ranges of (key, order), so a key that holds a third of the rows lies in a third of the
ranges. Every range finds its own running counts and sums, previous and last values. What its first key has
behind it in earlier ranges is a carry of one row, found on at most two rows per range and broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidedesk.session import materialize


def scan(
    rows: DataFrame,
    key: str,
    order: list[str],
    *,
    count: str | None = None,
    sums: dict[str, str] | None = None,
    previous: dict[str, str] | None = None,
    last: dict[str, str] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Add running values per ``key`` in the order of the columns ``order``.

    ``count`` names the number of the row within its key, from 1. ``sums``, ``previous`` and ``last`` map new
    columns to those they are read from: the running total, the value of the row before, and the last value that
    is not null, the row itself included. Nulls in ``order`` come first; rows that tie in it are taken in any
    order. Rows with a null key belong to no sequence and get nulls. Runs a Spark job when called: the rows dealt
    by range are a written table. Pass narrow frames; the rows cross two shuffles.
    """
    sums, previous, last = sums or {}, previous or {}, last or {}
    n = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = rows.select(F.struct(*[rows[c] for c in rows.columns]).alias("_row"), F.col(key).alias("_key"), F.struct(*order).alias("_at"))
    dealt = materialize(packed.repartitionByRange(n, "_key", "_at").withColumn("_range", F.spark_partition_id()), "ordered")
    carry = _carry(dealt, sums, previous, last)

    own = Window.partitionBy("_range", "_key").orderBy("_at")
    so_far = own.rowsBetween(Window.unboundedPreceding, 0)
    local = {"_n": F.row_number().over(own)}
    local |= {f"_sum_{o}": F.sum(f"_row.{c}").over(so_far) for o, c in sums.items()}
    # in a struct, so that a null value differs from no row
    local |= {f"_prev_{o}": F.lag(F.struct(f"_row.{c}")).over(own) for o, c in previous.items()}
    local |= {f"_last_{o}": F.last(f"_row.{c}", ignorenulls=True).over(so_far) for o, c in last.items()}
    here = dealt.repartitionById(n, F.col("_range")).select("*", *[c.alias(o) for o, c in local.items()])

    joined = here.join(F.broadcast(carry), (F.col("_range") == F.col("_c_range")) & (F.col("_key") == F.col("_c_key")), "left")
    out = {}
    if count:
        out[count] = (F.col("_n") + F.coalesce("_c_n", F.lit(0))).cast("long")
    for o in sums:
        both = F.coalesce(f"_sum_{o}", F.lit(0)) + F.coalesce(f"_c_sum_{o}", F.lit(0))
        out[o] = F.when(F.col(f"_sum_{o}").isNotNull() | F.col(f"_c_sum_{o}").isNotNull(), both)
    for o, c in previous.items():
        out[o] = F.coalesce(f"_prev_{o}", f"_c_prev_{o}").getField(c)
    for o in last:
        out[o] = F.coalesce(f"_last_{o}", f"_c_last_{o}")
    known = F.col("_key").isNotNull()
    return joined.select("_row.*", *[F.when(known, c).alias(o) for o, c in out.items()])


def _carry(dealt: DataFrame, sums: dict[str, str], previous: dict[str, str], last: dict[str, str]) -> DataFrame:
    """What each range's first key has behind it: at most one row per range.

    Only the first and the last key of a range can lie in others too.
    """
    ends = dealt.groupBy("_range").agg(F.min("_key").alias("_lo"), F.max("_key").alias("_hi"))
    edge = dealt.join(F.broadcast(ends.withColumnRenamed("_range", "_e")), F.col("_range") == F.col("_e")).filter(
        (F.col("_key") == F.col("_lo")) | (F.col("_key") == F.col("_hi")))

    def latest(c: str, where: Column | None = None) -> Column:
        return F.max_by(c, F.col("_at") if where is None else F.when(where, F.col("_at")))

    totals = [F.count("*").alias("_t_n")]
    totals += [F.sum(f"_row.{c}").alias(f"_t_sum_{o}") for o, c in sums.items()]
    totals += [F.max_by(F.struct(f"_row.{c}"), "_at").alias(f"_t_prev_{o}") for o, c in previous.items()]
    totals += [latest(f"_row.{c}", F.col(f"_row.{c}").isNotNull()).alias(f"_t_last_{o}") for o, c in last.items()]
    per_range = edge.groupBy("_range", "_key").agg(*totals)
    before = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return per_range.select(
        F.col("_range").alias("_c_range"), F.col("_key").alias("_c_key"), F.sum("_t_n").over(before).alias("_c_n"),
        *[F.sum(f"_t_sum_{o}").over(before).alias(f"_c_sum_{o}") for o in sums],
        *[F.last(f"_t_prev_{o}").over(before).alias(f"_c_prev_{o}") for o in previous],
        *[F.last(f"_t_last_{o}", ignorenulls=True).over(before).alias(f"_c_last_{o}") for o in last],
    ).filter(F.col("_c_n").isNotNull())


def contact_gaps(tickets: DataFrame, key: str = "customer_id", at: str = "created_at", seq: str = "row_seq") -> DataFrame:
    """Per contact its number within the customer (``contact_no``) and the seconds since the one before (``gap_seconds``).

    Contacts without a time have no place in the order; they and contacts without a customer get nulls.
    """
    timed = tickets.select(key, at, seq).withColumn("_k", F.when(F.col(at).isNotNull(), F.col(key)))
    out = scan(timed, "_k", [at, seq], count="contact_no", previous={"_before": at})
    gap = (F.unix_micros(at) - F.unix_micros("_before")) / F.lit(1_000_000)
    return out.select(key, at, seq, "contact_no", gap.alias("gap_seconds"))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_at: str,
    right_at: str,
    values: list[str],
    *,
    right_key: str | None = None,
    right_seq: str | None = None,
    left_id: str | None = None,
    strict: bool = False,
    forward: bool = False,
    tolerance_seconds: float | None = None,
) -> DataFrame:
    """Left-join each row with the nearest row of ``right`` under the same key that is not later (``strict``: earlier).

    ``forward`` looks for the nearest that is not earlier (later). Of right rows at one time the one with the largest
    ``right_seq`` is taken (``forward`` too). ``tolerance_seconds`` bounds the distance, the bound included. Rows of
    either side without a key or time match nothing; left rows all stay, repeats included. Columns of ``right``
    named in ``values`` are added; the times are timestamps.

    Both sides form one ordered sequence per key and each left row takes the last right value before it, so a hot
    key is cut like any other. With ``left_id``, unique and not null, only key, time and id are ordered and the
    matches joined back by it, so wide rows of ``left`` move once.
    """
    clash = [v for v in values if v in left.columns]
    if clash:
        raise ValueError(f"columns stand on both sides: {', '.join(clash)}")
    sign = -1 if forward else 1
    first_right = (0 if not strict else 1)
    narrow = left if left_id is None else left.select(left_id, key, left_at)
    carried = F.struct(*[narrow[c] for c in narrow.columns])
    found = F.struct(F.col(right_at).alias("at"), *[F.col(v).alias(f"v{i}") for i, v in enumerate(values)])
    r = right.select(
        F.col(right_key or key).alias("k"), (F.unix_micros(right_at) * sign).alias("t"), F.lit(first_right).alias("side"),
        (F.col(right_seq) if right_seq else F.lit(None).cast("long")).alias("seq"), found.alias("found"),
    ).filter(F.col("k").isNotNull() & F.col("t").isNotNull())
    probe = left.select(
        F.when(F.col(left_at).isNotNull(), F.col(key)).alias("k"), (F.unix_micros(left_at) * sign).alias("t"),
        F.lit(1 - first_right).alias("side"), carried.alias("left"))
    both = probe.unionByName(r, allowMissingColumns=True)
    matched = scan(both, "k", ["t", "side", "seq"], last={"match": "found"}).filter(F.col("side") == 1 - first_right)
    if tolerance_seconds is not None:
        apart = F.abs(F.col("t") - sign * F.unix_micros("match.at"))
        matched = matched.withColumn("match", F.when(apart <= int(tolerance_seconds * 1_000_000), F.col("match")))
    got = [F.col(f"match.v{i}").alias(v) for i, v in enumerate(values)]
    if left_id is None:
        return matched.select("left.*", *got)
    hits = matched.filter("match is not null").select(F.col(f"left.{left_id}").alias("_id"), *got)
    return left.join(hits, F.col(left_id) == F.col("_id"), "left").select(*left.columns, *values)
