"""Mixing sources to target weights by Poisson replication; DataFrame functions only.

Every document gets a count from a Poisson distribution whose mean is the repetition rate of its
source, by inverting the distribution at a hash of (seed, id), so that the counts depend on nothing
but the row. The rate makes the expected share of a source equal to its weight.

Defined cases: documents of sources without a weight, and of none, form one group with the weight ``others``;
where that is not given (None), they are left out, as are sources whose weight is not positive, and ``rates`` tells
how many rows that is; a source whose texts are all empty has rate 0; a null text weighs 0; rows that repeat an id
get the same count each; a null id hashes as the word ``null`` and the text; an empty table stays empty. Other columns are kept; input
columns named ``copy`` or ``shuffle_key`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Means above this are drawn as the sum of several smaller draws, each with a hash of its own.
CHUNK = 8
#: P(X >= 48) is below 1e-20 for means up to CHUNK.
TERMS = 48


def _hash_long(*parts: Column) -> Column:
    """52 bits of an MD5 as a long, the same in other engines."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("long")


def _group(weights: dict[str, float]) -> Column:
    """The source of a row, or null for all that have no weight of their own."""
    return F.when(F.col("source").isin(list(weights)), F.col("source"))


def rates(docs: DataFrame, weights: dict[str, float], epochs: float = 1.0, others: float | None = None) -> DataFrame:
    """One row per weighted source and one (null) for all others: ``source, rows, mass, weight, rate``; mass is in code points.

    Rates scale so that the expected mass of the mixture is ``epochs`` times that of the sources with a positive weight; weights of sources
    without any text do not count. At most ``len(weights) + 1`` rows; those of rate 0 are what leaves the mixture.
    """
    table = F.create_map(*[F.lit(x) for pair in sorted(weights.items()) for x in pair]) if weights else F.create_map().cast("map<string,double>")
    other = F.lit(float(others or 0.0))
    grouped = docs.groupBy(_group(weights).alias("source")).agg(
        F.count("*").alias("rows"), F.sum(F.coalesce(F.length("text"), F.lit(0)).cast("long")).alias("mass"),
    ).withColumn("weight", F.when(F.col("source").isNull(), other).otherwise(F.greatest(table[F.col("source")], F.lit(0.0))))
    every = Window.partitionBy(F.lit(1))  # over len(weights) + 1 rows at most
    used = (F.col("mass") > 0) & (F.col("weight") > 0)
    total, weighed = F.sum(F.when(used, F.col("mass"))).over(every), F.sum(F.when(used, F.col("weight"))).over(every)
    rate = F.when(used, F.col("weight") / weighed * total * F.lit(float(epochs)) / F.col("mass"))
    return grouped.select("source", "rows", "mass", "weight", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def poisson_count(rate: Column, cdf: Column, seed: int, key: Column) -> Column:
    """The number of terms of ``cdf`` that do not exceed a hash in [0, 1), summed over the chunks of the rate."""
    draws = F.sequence(F.lit(1), F.greatest(F.ceil(rate / CHUNK), F.lit(1)).cast("int"))

    def one(i: Column) -> Column:
        u = _hash_long(F.lit(str(seed)), key, i.cast("string")) / F.lit(float(2**52))
        return F.size(F.filter(cdf, lambda c: c <= u))

    return F.aggregate(draws, F.lit(0), lambda acc, i: acc + one(i))


def _cdf(rate: Column) -> Column:
    """Cumulative probabilities of 0, 1, ... for the mean of one chunk."""
    mean = rate / F.greatest(F.ceil(rate / CHUNK), F.lit(1)).cast("double")
    first = F.exp(-mean)
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS - 1)),
        F.struct(first.alias("p"), first.alias("c"), F.array(first).alias("a")),
        lambda s, k: F.struct(
            (s["p"] * mean / k).alias("p"), (s["c"] + s["p"] * mean / k).alias("c"),
            F.concat(s["a"], F.array(s["c"] + s["p"] * mean / k)).alias("a")),
        lambda s: s["a"])


def mix(docs: DataFrame, weights: dict[str, float], seed: int = 17, epochs: float = 1.0, others: float | None = None) -> DataFrame:
    """``docs`` with each row repeated by its count, in a global pseudo-random order.

    Adds ``copy`` (1, 2, ...) and ``shuffle_key``: rows are dealt to partitions by a hash of the key
    and sorted by it within. The broadcast holds one row per weighted source and one for the others.
    """
    docs = docs.drop("copy", "shuffle_key")
    table = rates(docs, weights, epochs, others).filter("rate > 0").select(F.col("source").alias("_group"), "rate", _cdf(F.col("rate")).alias("cdf"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce("text", F.lit("")).cast("binary"))))
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), key.alias("key"), _group(weights).alias("group"))
    count = F.when(F.col("rate") > 0, poisson_count(F.col("rate"), F.col("cdf"), seed, F.col("key"))).otherwise(F.lit(0))
    counted = packed.join(F.broadcast(table), F.col("group").eqNullSafe(F.col("_group"))).select("row", "key", count.alias("count")).filter("count > 0")
    copies = counted.select("row", "key", F.explode(F.sequence(F.lit(1), F.col("count"))).alias("copy"))
    keyed = copies.select(
        "row.*", "copy", _hash_long(F.lit(f"{seed}:order"), F.col("key"), F.col("copy").cast("string")).alias("shuffle_key"))
    return keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
