"""Quantile and distinct-count sketches as stored state: written per part of a run, merged across runs.

A sketch has a fixed size whatever it has seen, and sketches of parts merge into that of the whole. So thresholds
over any choice of runs come from a few kilobytes per part, without the rows. Quantiles are KLL sketches:
with ``QUANTILE_K`` = 800 the rank of an answer is within ``RANK_ERROR`` of the rank asked for. Distinct counts are
HyperLogLog sketches of 2**14 registers: 99.9 % lie within ``DISTINCT_ERROR`` of the truth.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

QUANTILE_K, RANK_ERROR, GRID = 800, 0.01, 500
DISTINCT_LG, DISTINCT_ERROR = 14, 0.03


def sketch(df: DataFrame, by: Sequence[str], values: dict[str, Column], keys: dict[str, Column]) -> DataFrame:
    """One row per group of ``by``: ``n``; per value its count, sum, sum of squares and quantile sketch ``q_<name>``; per
    key a distinct-count sketch ``d_<name>``. Nulls are not seen by sketches and counts of values; a group without any
    value has a null sketch. Sketches are built before the shuffle, so a hot group moves one sketch per task.
    """
    out = [F.count("*").alias("n")]
    for name, c in values.items():
        x = c.cast("double")
        out += [F.count(x).alias(f"n_{name}"), F.sum(x).alias(f"sum_{name}"), F.sum(x * x).alias(f"squares_{name}"),
                F.kll_sketch_agg_double(x, QUANTILE_K).alias(f"q_{name}")]
    out += [F.hll_sketch_agg(c.cast("string"), DISTINCT_LG).alias(f"d_{name}") for name, c in keys.items()]
    return df.groupBy(*by).agg(*out)


def store(sketches: DataFrame, path: str, run_id: str) -> None:
    """Append the sketches of one run; a rerun of the same run replaces its own folder."""
    sketches.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run_id={run_id}")


def stored(spark: SparkSession, path: str) -> DataFrame:
    """All runs kept at ``path``, with ``run_id``; a filter on it reads the folders of those runs alone."""
    return spark.read.option("mergeSchema", "false").parquet(path).withColumn("run_id", F.col("run_id").cast("string"))


def merge(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of coarser groups: of other columns than they were made for, or of several runs."""
    names = sketches.columns
    out = [F.coalesce(F.sum("n"), F.lit(0)).alias("n")]
    for c in names:
        if c.startswith(("n_", "sum_", "squares_")):
            out.append(F.sum(c).alias(c))
        elif c.startswith("q_"):
            out.append(F.kll_merge_agg_double(c).alias(c))
        elif c.startswith("d_"):
            out.append(F.hll_union_agg(c).alias(c))
    return sketches.groupBy(*by).agg(*out)


def quantile(name: str, rank: float) -> Column:
    """The value at ``rank`` (0 to 1) of a sketched value; null where nothing was seen."""
    seen = F.coalesce(f"n_{name}", F.lit(0)) > 0
    return F.when(seen, F.kll_sketch_get_quantile_double(f"q_{name}", F.lit(float(rank))))


def share_below(name: str, bound: Column) -> Column:
    """The share of seen values that are not above ``bound``, which may differ by row; null where nothing was seen or
    without a bound. Read off ``GRID`` quantiles, which adds at most half a step to the rank error.
    """
    grid = F.array(*[F.lit((i + 0.5) / GRID) for i in range(GRID)])
    marks = F.when(F.coalesce(f"n_{name}", F.lit(0)) > 0, F.kll_sketch_get_quantile_double(f"q_{name}", grid))
    return F.when(bound.isNotNull(), F.size(F.filter(marks, lambda q: q <= bound)) / F.when(marks.isNotNull(), F.lit(GRID)))


def distinct(name: str) -> Column:
    return F.coalesce(F.hll_sketch_estimate(f"d_{name}"), F.lit(0).cast("long"))


def spike_bound(name: str, z: float) -> Column:
    """Mean and ``z`` sample deviations above it, from the stored sums; null below two values."""
    n, total = F.col(f"n_{name}"), F.col(f"sum_{name}")
    variance = (F.col(f"squares_{name}") - total * total / n) / (n - 1)
    return F.when(n >= 2, total / n + z * F.sqrt(F.greatest(variance, F.lit(0.0))))


def sensitivity(merged: DataFrame, name: str, zs: Sequence[float] = (2.0, 2.5, 3.0)) -> DataFrame:
    """``(*, z, bound, share)`` per row of ``merged``: the spike bound and the share of values above it, as of the sketches."""
    keep = [c for c in merged.columns if not c.startswith(("q_", "d_", "sum_", "squares_", "n_"))]
    cells = F.array(*[F.struct(F.lit(float(z)).alias("z"), spike_bound(name, z).alias("bound"),
                               (F.lit(1.0) - share_below(name, spike_bound(name, z))).alias("share")) for z in zs])
    return merged.select(*keep, F.explode(cells).alias("_c")).select(*keep, "_c.*")
