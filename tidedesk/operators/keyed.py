"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: A key is heavy when it holds more than this share of a shuffle partition; so there are at most
#: ``PER_PARTITION`` heavy keys per shuffle partition.
PER_PARTITION = 16


def attach_by_key(
    rows: DataFrame,
    key: str,
    per_key: DataFrame,
    values: list[str],
    weights: DataFrame | None = None,
    spread: str = "row_seq",
    keep: Column | None = None,
) -> DataFrame:
    """Left-join ``values`` of ``per_key`` (one row per key) onto ``rows``.

    Keys that hold more rows than 1/16 of an even shuffle partition are joined by broadcast;
    there are at most 16 of them per partition, whatever the data. Their rows, and rows with
    a null key, then go through the shuffle of the second join under a per-row salt that
    spreads them evenly.

    The salt of other rows is a hash of their key on both sides. (A constant would
    be folded into the condition, and the shuffle would go by the key alone.)

    When ``per_key`` counts the rows of every present key in a column ``n``, the heavy
    keys and their values are read off it; ``keep`` then picks the keys that the second
    join needs. Otherwise ``weights`` may give those ``(key, n)`` counts, and by default
    they are computed.
    """
    heavy_values = [F.col(v).alias(f"_h_{v}") for v in values]
    if "n" in per_key.columns:
        heavy = heavy_keys(per_key, key).select(F.col(key).alias("_hk"), *heavy_values)
    else:
        top = heavy_keys(count_by_key(rows, key) if weights is None else weights, key).select(F.col(key).alias("_hk"))
        heavy = top.join(per_key, F.col("_hk") == per_key[key], "left").select("_hk", *heavy_values)
    if keep is not None:
        per_key = per_key.filter(keep)
    salted = rows.join(F.broadcast(heavy), F.col(key) == F.col("_hk"), "left").withColumn(
        "_salt",
        F.when(F.col("_hk").isNotNull() | F.col(key).isNull(), F.xxhash64(spread)).otherwise(
            F.xxhash64(key)
        ),
    )
    cold = per_key.select(
        F.col(key).alias("_ck"), F.xxhash64(key).alias("_csalt"),
        *[F.col(v).alias(f"_c_{v}") for v in values],
    )
    joined = salted.join(
        cold, (F.col(key) == F.col("_ck")) & (F.col("_salt") == F.col("_csalt")), "left"
    )
    return joined.select(
        *rows.columns,
        *[F.coalesce(F.col(f"_h_{v}"), F.col(f"_c_{v}")).alias(v) for v in values],
    )


def heavy_keys(counts: DataFrame, key: str) -> DataFrame:
    """The rows of ``counts`` (``key, n``) whose ``n`` exceeds the total over 16 times the shuffle partitions."""
    parts = PER_PARTITION * int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = counts.agg(F.sum("n").alias("_total"))  # one row
    return counts.crossJoin(F.broadcast(total)).filter(
        F.col(key).isNotNull() & (F.col("n") > F.col("_total") / parts)).drop("_total")


def count_by_key(rows: DataFrame, key: str) -> DataFrame:
    """``(key, n)`` over rows whose key is present; combines before it shuffles."""
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
