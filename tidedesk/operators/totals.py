"""Cubes, rollups and chosen grouping sets over pre-aggregated cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def cells(df: DataFrame, dims: Sequence[str], measures: dict[str, Column] | None = None) -> DataFrame:
    """One row per combination of ``dims``: ``n`` and, per measure, what any coarser grouping needs to go on.

    The only step that reads the rows; it combines before it shuffles, so its output has a row per cell.
    """
    parts = [F.count("*").alias("n")]
    for name, c in (measures or {}).items():
        parts += [F.count(c).alias(f"{name}_n"), F.sum(c).alias(f"{name}_sum"), F.min(c).alias(f"{name}_min"), F.max(c).alias(f"{name}_max")]
    return df.groupBy(*dims).agg(*parts)


def subtotals(
    small: DataFrame, dims: Sequence[str], measures: Sequence[str] = (), sets: str | Sequence[Sequence[str]] = "cube",
) -> DataFrame:
    """Totals of ``cells`` for the grouping sets ``cube``, ``rollup`` or a list of lists of dims.

    ``grouping_id`` has a bit per dim, the first dim's the highest, set where the row totals over that dim: it tells
    a null of the data from a total. Per measure: sum, mean, least and greatest; a mean over no value is null. An empty
    input has no rows but the grand total, where the sets ask for one.
    """
    if sets == "cube":
        grouped = small.cube(*dims)
    elif sets == "rollup":
        grouped = small.rollup(*dims)
    else:
        grouped = small.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in dims])
    out = [F.grouping_id().cast("long").alias("grouping_id"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")]
    for m in measures:
        total, seen = F.sum(f"{m}_sum"), F.sum(f"{m}_n")
        out += [total.alias(f"{m}_sum"), (total / F.nullif(seen, F.lit(0))).alias(f"{m}_mean"),
                F.min(f"{m}_min").alias(f"{m}_min"), F.max(f"{m}_max").alias(f"{m}_max")]
    return grouped.agg(*out)


def named_totals(summed: DataFrame, dims: Sequence[str], total: str = "(all)", missing: str = "(none)") -> DataFrame:
    """``subtotals`` for reading: dims as text, ``total`` where a row totals over them and ``missing`` for a null of the data."""
    text = [
        F.when(F.col("grouping_id").bitwiseAND(1 << (len(dims) - 1 - i)) != 0, F.lit(total))
        .otherwise(F.coalesce(F.col(d).cast("string"), F.lit(missing))).alias(d) for i, d in enumerate(dims)]
    return summed.select(*text, *[c for c in summed.columns if c not in dims])
