"""What changed between two runs of a table, as multisets.

Both runs are cut into buckets by a hash of the key. A bucket's digest is the number of its rows and the sums of
two 64-bit row hashes, which no order and no repeat can hide. Only rows of buckets whose digests differ are
compared in full, so two equal runs shuffle a digest per task and bucket and no row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidedesk.session import materialize

#: Buckets of a comparison: digests stay small (some 200 KB a task), and one changed row has 1/4096 of the table compared.
BUCKETS = 4096
_LOW = (1 << 32) - 1


def _told_apart(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """What a hash needs of each column. Spark's hashes skip nulls, so each null is told by a flag; nested values go as JSON text."""
    out = []
    for c in columns:
        if isinstance(df.schema[c].dataType, T.MapType):
            raise ValueError(f"{c} is a map, which rows cannot be compared by")
        nested = isinstance(df.schema[c].dataType, (T.StructType, T.ArrayType))
        value = F.to_json(F.struct(c), {"ignoreNullFields": "false"}) if nested else F.col(c)
        out += [value, F.col(c).isNull()]
    return out


def _bucket(df: DataFrame, key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*_told_apart(df, key)), F.lit(buckets)).cast("int")


def digests(df: DataFrame, key: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``bucket, rows, s0..s3``: order-free digests, summed before they shuffle.

    Each hash is added in two halves of 32 bits, so a bucket may hold two billion rows. They can be stored with a run.
    """
    parts = _told_apart(df, df.columns)
    hashed = df.select(
        _bucket(df, key, buckets).alias("bucket"), F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit("second"), *parts).alias("b"))
    halves = [F.col(h).bitwiseAND(F.lit(_LOW)) if low else F.shiftrightunsigned(h, 32) for h in "ab" for low in (True, False)]
    return hashed.groupBy("bucket").agg(
        F.count("*").alias("rows"), *[F.sum(h).alias(f"s{i}") for i, h in enumerate(halves)])


def unequal_buckets(before: DataFrame, after: DataFrame) -> DataFrame:
    """``bucket`` of two tables of digests where they differ or only one has rows."""
    names = ["rows", "s0", "s1", "s2", "s3"]
    now = after.select(F.col("bucket").alias("b"), *[F.col(n).alias(f"now_{n}") for n in names])
    both = before.join(now, F.col("bucket") == F.col("b"), "full")
    same = [F.col(n).eqNullSafe(F.col(f"now_{n}")) for n in names]
    differ = ~same[0]
    for s in same[1:]:
        differ = differ | ~s
    return both.filter(differ).select(F.coalesce("bucket", "b").alias("bucket"))


def row_differences(before: DataFrame, after: DataFrame, key: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """The columns of ``before`` and ``copies``: by how many copies ``after`` has more of that row (negative: fewer).

    The two ``EXCEPT ALL`` of the tables, signed. Nulls equal nulls. ``after`` may have its columns in another order;
    map columns are refused. Runs a Spark job when called.
    """
    if sorted(before.columns) != sorted(after.columns):
        raise ValueError("the two tables have different columns")
    columns = before.columns
    if "copies" in columns:
        raise ValueError("a column has the name of the result, copies")
    sides = [before, after.select(*columns)]
    differ = materialize(unequal_buckets(*[digests(s, key, buckets) for s in sides]), "unequal-buckets")
    signed = []
    for s, sign in zip(sides, (-1, 1), strict=True):
        rows = s.select(F.struct(*[s[c] for c in columns]).alias("_row"), _bucket(s, key, buckets).alias("_in"))
        # at most ``buckets`` numbers are broadcast
        some = rows.join(F.broadcast(differ), F.col("_in") == F.col("bucket"), "left_semi")
        signed.append(some.select(F.struct("_row", F.lit(sign).cast("long").alias("sign")).alias("_s")).select("_s._row.*", F.col("_s.sign").alias("copies")))
    net = signed[0].unionByName(signed[1]).groupBy(*columns).agg(F.sum("copies").alias("copies"))
    return net.filter(F.col("copies") != 0)


def key_differences(before: DataFrame, after: DataFrame, key: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Per key that differs: ``n_added``, ``n_removed`` and ``n_changed`` rows.

    A row that goes and one that comes under the same key are one change. Repeats count; a null key is a key.
    """
    net = row_differences(before, after, key, buckets)
    more, fewer = F.sum(F.greatest("copies", F.lit(0))), F.sum(F.greatest(-F.col("copies"), F.lit(0)))
    per_key = net.groupBy(*key).agg(more.alias("_more"), fewer.alias("_fewer"))
    changed = F.least("_more", "_fewer")
    return per_key.select(*key, (F.col("_more") - changed).alias("n_added"), (F.col("_fewer") - changed).alias("n_removed"), changed.alias("n_changed"))
