"""Aggregates kept up to date from signed changes.

A change is a row with a sign: +1 for a row that came, -1 for one that went (an update is both). Counts and sums
per key are kept as a log: every change set appends its own sums, which costs what the change set costs, and a
reader adds them up. ``compact`` folds the log into one set of sums now and then.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Folders of the log are told apart by a hash of the key, so that a look at a few keys reads a few folders.
BUCKETS = 16


def signed(added: DataFrame, removed: DataFrame | None = None) -> DataFrame:
    """Rows with ``sign``."""
    plus = added.withColumn("sign", F.lit(1).cast("long"))
    return plus if removed is None else plus.unionByName(removed.withColumn("sign", F.lit(-1).cast("long")))


def sums_of(changes: DataFrame, key: Sequence[str], sums: dict[str, Column] | None = None) -> DataFrame:
    """``(*key, n, <sums>)`` of signed rows; a null value adds nothing. Combines before it shuffles."""
    return changes.groupBy(*key).agg(
        F.sum("sign").alias("n"), *[F.sum(F.coalesce(c, F.lit(0)) * F.col("sign")).alias(name) for name, c in (sums or {}).items()])


def _bucket(key: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int")


def append(changes: DataFrame, path: str, seq: int, key: Sequence[str], sums: dict[str, Column] | None = None) -> None:
    """Write the sums of change set ``seq`` to the log; writing it again replaces it, so a retried run counts once."""
    made = sums_of(changes, key, sums).withColumn("bucket", _bucket(key))
    made.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path.rstrip('/')}/seq={seq}")


def current(spark: SparkSession, path: str, key: Sequence[str], at: int | None = None) -> DataFrame:
    """The aggregate after change set ``at`` (default: the last); keys whose rows are all gone are not in it."""
    log = spark.read.parquet(path)
    if at is not None:
        log = log.filter(F.col("seq") <= at)
    values = [c for c in log.columns if c not in (*key, "seq", "bucket")]
    return log.groupBy(*key).agg(*[F.sum(c).alias(c) for c in values]).filter(F.col("n") != 0)


def touched(spark: SparkSession, path: str, key: Sequence[str], seq: int) -> DataFrame:
    """The keys of change set ``seq`` with their sums before (``was_<sum>``) and after it.

    Reads the log folders of the change set's buckets only; zero stands for a key that was or is not there.
    """
    log = spark.read.parquet(path)
    delta = log.filter(F.col("seq") == seq)
    values = [c for c in log.columns if c not in (*key, "seq", "bucket")]
    buckets = [r["bucket"] for r in delta.select("bucket").distinct().collect()]  # at most BUCKETS numbers
    near = log.filter((F.col("seq") <= seq) & F.col("bucket").isin(buckets))
    own = delta.select(*[F.col(k).alias(f"_{k}") for k in key])
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    before = F.col("seq") < seq
    return near.join(own, same, "left_semi").groupBy(*key).agg(
        *[F.coalesce(F.sum(F.when(before, F.col(c))), F.lit(0)).alias(f"was_{c}") for c in values], *[F.sum(c).alias(c) for c in values])


def compact(spark: SparkSession, path: str, target: str, key: Sequence[str], seq: int) -> None:
    """Fold the log up to change set ``seq`` into one at ``target``; later change sets go there too.

    The old log is left as it is: readers of it are not disturbed and a failed run can be repeated.
    """
    kept = current(spark, path, key, seq).withColumn("bucket", _bucket(key))
    kept.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{target.rstrip('/')}/seq={seq}")


def crossings(per_key: DataFrame, k: int = 3) -> DataFrame:
    """Of ``touched`` keys those whose count reached ``k`` or fell below it, with the flag they have now."""
    was, now = F.col("was_n") >= k, F.col("n") >= k
    return per_key.filter(was != now).withColumn("repeat_contact", now)
