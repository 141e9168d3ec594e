"""Stopping a scoring run once its cost reaches a cap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from tidedesk.session import materialize

_MILLION = 1_000_000
_LEVEL_BITS = 16


def token_cost(tokens_in: Column, tokens_out: Column, price: tuple[float, float],
               before: float = 0.0) -> Column:
    """``before`` plus the dollars for token totals at ``price`` per million (input, output).

    Added left to right, so the sum rounds as one running total would.
    """
    return (F.lit(float(before)) + tokens_in / F.lit(_MILLION) * F.lit(price[0])
            + tokens_out / F.lit(_MILLION) * F.lit(price[1]))


def _crossing(level: DataFrame, so_far: tuple[int, int, int], spent: float,
              price: tuple[float, float], cap: float) -> Row | None:
    """First key of ``level`` at which the running cost reaches ``cap``, with the
    totals before it. ``level`` has at most 65,536 keys, one row each.
    """
    w = Window.partitionBy(F.lit(0)).orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    run = level.select("key", "rows", "ti", "to", *[
        (F.lit(base) + F.sum(c).over(w)).alias(f"run_{c}")
        for c, base in zip(("rows", "ti", "to"), so_far)
    ])
    return (
        run.filter(token_cost(F.col("run_ti"), F.col("run_to"), price, spent) >= F.lit(cap))
        .orderBy("key").limit(1)
        .select("key", *[(F.col(f"run_{c}") - F.col(c)).alias(c) for c in ("rows", "ti", "to")])
        .first()
    )


def budget_cut(
    df: DataFrame,
    cap: float | None,
    *,
    price: tuple[float, float],
    batch: int = 1,
    order: str = "row_seq",
    tokens: tuple[str, str] = ("input_tokens", "output_tokens"),
    spent: float = 0.0,
) -> DataFrame:
    """Rows that a run in ``order`` would still score under ``cap`` dollars.

    Rows go in batches of ``batch``; a batch runs when the cost before it, ``spent``
    included, is below the cap. ``order`` must be a unique long.

    Cost never falls, so the answer is a prefix in ``order``: one number, looked up
    here and applied as a plain filter that reaches the scan. Nothing wide moves.
    Token totals are pre-aggregated per block of 65,536 order values in one pass; the
    block where the cap is crossed is found level by level, never looking at more
    than 65,536 totals at once; and only the rows of that block are ordered singly.
    """
    if cap is None:
        return df
    if spent >= cap:
        return df.limit(0)
    sums = [F.sum(c).alias(c) for c in ("rows", "ti", "to")]
    rows = df.select(
        F.col(order).cast("long").alias("key"), F.lit(1).cast("long").alias("rows"),
        *[F.coalesce(F.col(t), F.lit(0)).cast("long").alias(c) for t, c in zip(tokens, ("ti", "to"))],
    )
    blocks = materialize(
        rows.groupBy(F.shiftright("key", _LEVEL_BITS).alias("key")).agg(*sums), "budget-blocks"
    )
    so_far, parent = (0, 0, 0), None
    for up in (2 * _LEVEL_BITS, _LEVEL_BITS, 0):
        level = blocks if parent is None else blocks.filter(
            F.shiftright("key", up + _LEVEL_BITS) == F.lit(parent))
        at = _crossing(level.groupBy(F.shiftright("key", up).alias("key")).agg(*sums),
                       so_far, spent, price, cap)
        if at is None:
            return df
        so_far, parent = (at.rows, at.ti, at.to), at.key

    low = parent << _LEVEL_BITS
    at = _crossing(rows.filter(F.col("key").between(low, low + (1 << _LEVEL_BITS) - 1)),
                   so_far, spent, price, cap)
    last = at.key
    # The batch that crosses the cap still finishes.
    more = batch - 1 - at.rows % batch
    if more:
        rest = df.filter(F.col(order) > F.lit(last)).select(order).orderBy(order).limit(more)
        last = max(rest.agg(F.max(order)).first()[0] or last, last)
    return df.filter(F.col(order) <= F.lit(last))


def first_rows(df: DataFrame, n: int, order: str = "row_seq") -> DataFrame:
    """The first ``n`` rows in ``order`` as a filter, for ``n`` too large for one task.

    Every row costs one dollar; the half keeps the comparison clear of rounding.
    """
    priced = df.withColumns({"_one": F.lit(1), "_none": F.lit(0)})
    return budget_cut(priced, n - 0.5, price=(float(_MILLION), 0.0), order=order,
                      tokens=("_one", "_none")).drop("_one", "_none")
