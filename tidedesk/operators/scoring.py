"""Model replies as data: scoring, validation, tier merge, cost and reports."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidedesk.functions.replies import CLASSIFICATION, parse_replies
from tidedesk.functions.text import strip
from tidedesk.operators.budget import budget_cut, first_rows, token_cost
from tidedesk.schema import ACCEPT_TIER2_FROM, CATEGORIES, PRICES, PRIORITIES, REVIEW_BELOW, UNKNOWN
from tidedesk.session import materialize

TIER1_BATCH = 10
#: A worker collects its garbage when scorers have been given this much since the last time.
COLLECT_BYTES = 16 << 20
TOKENS = ["input_tokens", "output_tokens", "cache_read_tokens"]


def scoring_input(df: DataFrame) -> DataFrame:
    """Add ``prompt``; rows whose subject and body are both blank are left out."""
    subject, body = (F.coalesce(F.col(c), F.lit("")) for c in ("subject", "body"))
    return df.filter((strip(subject) != "") | (strip(body) != "")).withColumn(
        "prompt", F.concat(F.lit("Subject: "), subject, F.lit("\n\nBody: "), body)
    )


def score_batch(
    df: DataFrame,
    make_scorer: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]],
    schema: str,
) -> DataFrame:
    """Run a user's scorer over Arrow batches.

    ``make_scorer`` is called once per partition (build clients there); what it
    returns maps one pandas batch to one pandas batch. Filter and project before
    this call: Spark moves neither through Python code.

    A pandas column whose ``.str`` or ``.dt`` has been used refers to itself, so it outlives its
    batch until Python looks for cycles, which few large objects hardly ever make it do. The worker
    therefore does so itself, and holds the same memory however many batches it is given.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score, given = make_scorer(), 0
        for batch in batches:
            given += int(batch.memory_usage(index=False, deep=True).sum())
            scored = score(batch)
            del batch
            if given >= COLLECT_BYTES:
                gc.collect()
                given = 0
            yield scored

    return df.mapInPandas(run, schema)


def classified_replies(responses: DataFrame) -> DataFrame:
    """One row per reply: row_seq, category, priority, confidence, ok, tokens.

    Tokens of a reply that failed validation are not billed.
    """
    parsed = parse_replies(responses, CLASSIFICATION)
    ok = F.col("reply").isNotNull()
    keep = [c for c in ("row_seq", "tier") if c in responses.columns]
    return parsed.select(
        *keep, "reply.category", "reply.priority", "reply.confidence", ok.alias("ok"),
        *[F.when(ok, F.col(t)).otherwise(F.lit(0)).cast("long").alias(t)
          for t in TOKENS if t in responses.columns],
    )


def first_n(df: DataFrame, n: int, order: str = "row_seq") -> DataFrame:
    """The first ``n`` rows, sorted, the same way for every ``n``; ``order`` is a long, nulls first.

    The last value is looked up and used as a filter. Of rows that tie at the cut, as many as fit
    are taken, whichever.
    """
    if n <= 0:
        return df.limit(0)
    present = df.filter(F.col(order).isNotNull())
    nulls = df.filter(F.col(order).isNull())
    rest = n - nulls.count()
    if rest <= 0:
        return nulls.limit(n)
    first = first_rows(present, rest, order)
    got, last = first.agg(F.count("*"), F.max(order)).first()
    if got > rest:
        below = first.filter(F.col(order) < last)
        first = below.unionByName(first.filter(F.col(order) == last).limit(rest - below.count()))
    return nulls.unionByName(first).orderBy(order)


def tier1_within_budget(tickets: DataFrame, tier1: DataFrame, cap: float | None,
                        batch: int = TIER1_BATCH) -> DataFrame:
    """Tier-1 results (one row per ticket) that a capped run reaches.

    Tickets without a reply still take their place in a batch, at no cost.
    """
    every = materialize(tickets.select("row_seq").join(tier1, "row_seq", "left"), "tier1-attempts")
    return every if cap is None else budget_cut(every, cap, price=PRICES[1], batch=batch)


def tier2_within_budget(tier1: DataFrame, tier2: DataFrame, cap: float | None,
                        spent: float | None = None) -> DataFrame:
    """Tier-2 results for the rows under review that a capped run reaches.

    ``tier1`` are the attempted tier-1 rows; their cost counts against the cap, or ``spent`` if given.
    """
    review = tier1.filter(F.col("ok") & (F.col("confidence") < REVIEW_BELOW)).select("row_seq")
    attempted = review.join(tier2, "row_seq", "left")
    if cap is None:
        return attempted
    attempted = materialize(attempted, "tier2-attempts")
    if spent is None:
        spent = tier1.agg(
            token_cost(F.coalesce(F.sum("input_tokens"), F.lit(0)),
                       F.coalesce(F.sum("output_tokens"), F.lit(0)), PRICES[1])
        ).first()[0]
    return budget_cut(attempted, cap, price=PRICES[2], spent=spent)


def merge_tiers(tickets: DataFrame, tier1: DataFrame, tier2: DataFrame) -> DataFrame:
    """Add the five classification columns, never null.

    A tier-1 result below the review limit is flagged. A tier-2 attempt marks the
    row escalated; its result replaces tier 1 and clears the flag when it is
    confident enough. Rows without a valid result keep the defaults.
    """
    t1 = tier1.select(
        "row_seq", F.col("ok").alias("_ok1"), F.col("category").alias("_c1"),
        F.col("priority").alias("_p1"), F.col("confidence").alias("_f1"),
    )
    t2 = tier2.select(
        "row_seq", F.lit(True).alias("_tried2"), F.col("ok").alias("_ok2"),
        F.col("category").alias("_c2"), F.col("priority").alias("_p2"),
        F.col("confidence").alias("_f2"),
    )
    no = F.lit(False)
    review1 = F.coalesce(F.col("_ok1") & (F.col("_f1") < REVIEW_BELOW), no)
    tried2 = review1 & F.coalesce(F.col("_tried2"), no)
    take2 = tried2 & F.coalesce(F.col("_ok2") & (F.col("_f2") >= ACCEPT_TIER2_FROM), no)

    def pick(two: str, one: str, default) -> Column:
        return F.when(take2, F.col(two)).otherwise(
            F.coalesce(F.when(F.col("_ok1"), F.col(one)), F.lit(default))
        )

    # the two result tables are merged first, so the tickets move once
    verdict = t1.join(t2, "row_seq", "left").select(
        "row_seq", pick("_c2", "_c1", UNKNOWN).alias("_c"), pick("_p2", "_p1", UNKNOWN).alias("_p"),
        pick("_f2", "_f1", 0.0).alias("_f"), (review1 & ~take2).alias("_n"), tried2.alias("_e"),
    )
    return tickets.join(verdict, "row_seq", "left").select(
        *[tickets[c] for c in tickets.columns],
        F.coalesce("_c", F.lit(UNKNOWN)).alias("llm_category"), F.coalesce("_p", F.lit(UNKNOWN)).alias("llm_priority"),
        F.coalesce("_f", F.lit(0.0)).alias("llm_confidence"), F.coalesce("_n", no).alias("needs_review"),
        F.coalesce("_e", no).alias("escalated"),
    )


def usage_cost(usage: DataFrame, prices: dict = PRICES, key: str = "tier") -> DataFrame:
    """Per ``key`` (a tier or a model): token sums and dollars to 6 digits. Cache reads are not priced."""
    sums = usage.groupBy(key).agg(
        *[F.coalesce(F.sum(t), F.lit(0)).alias(t) for t in TOKENS[:2]]
    )
    cost = F.lit(None).cast("double")
    for tier, price in prices.items():
        cost = F.when(
            F.col(key) == tier, token_cost(F.col("input_tokens"), F.col("output_tokens"), price)
        ).otherwise(cost)
    return sums.withColumn("cost_usd", F.round(cost, 6))


def total_cost(per_tier: DataFrame) -> DataFrame:
    """One row: the sum over tiers to 4 digits."""
    return per_tier.agg(F.round(F.coalesce(F.sum("cost_usd"), F.lit(0.0)), 4).alias("total_cost_usd"))


def tally(df: DataFrame, cells: dict[tuple[str, str], Column]) -> DataFrame:
    """One aggregate pass to ``(section, name, value)`` rows, zeros included."""
    row = df.agg(*[c.cast("double").alias(f"{s}/{n}") for (s, n), c in cells.items()])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(s).alias("section"), F.lit(n).alias("name"),
                 F.coalesce(F.col(f"`{s}/{n}`"), F.lit(0.0)).alias("value"))
        for s, n in cells
    ])).alias("c")).select("c.*")


def classification_report(merged: DataFrame, tier1: DataFrame) -> DataFrame:
    """Counts and zero-filled distributions; ``unknown`` is in no distribution.

    ``tier1`` are the attempted rows: rows the budget skipped are not failures.
    """
    tickets = tally(merged, {
        ("totals", "total_tickets"): F.count("*"),
        ("totals", "needs_review"): F.count_if("needs_review"),
        ("totals", "escalated"): F.count_if("escalated"),
        **{("category_distribution", v): F.count_if(F.col("llm_category") == v) for v in CATEGORIES},
        **{("priority_distribution", v): F.count_if(F.col("llm_priority") == v) for v in PRIORITIES},
    })
    ok = F.coalesce(F.col("ok"), F.lit(False))
    attempts = tally(tier1, {
        ("totals", "classified"): F.count_if(ok), ("totals", "failed"): F.count_if(~ok),
    })
    return tickets.unionByName(attempts)


def confidence_buckets(merged: DataFrame) -> DataFrame:
    """Histogram over [0,.5) [.5,.7) [.7,.9) [.9,1]; unscored rows hold 0.0."""
    c = F.col("llm_confidence")
    return tally(merged, {
        ("confidence_buckets", "0.0-0.5"): F.count_if(c < 0.5),
        ("confidence_buckets", "0.5-0.7"): F.count_if((c >= 0.5) & (c < 0.7)),
        ("confidence_buckets", "0.7-0.9"): F.count_if((c >= 0.7) & (c < 0.9)),
        ("confidence_buckets", "0.9-1.0"): F.count_if(c >= 0.9),
    })


def cache_hit_rate(usage: DataFrame) -> DataFrame:
    """Cache reads over all input the cache could have served; 0 without input."""
    read = F.coalesce(F.sum("cache_read_tokens"), F.lit(0))
    total = F.coalesce(F.sum("input_tokens"), F.lit(0)) + read
    return usage.agg(
        F.when(total > 0, F.round(read / F.nullif(total, F.lit(0)), 4)).otherwise(F.lit(0.0)).alias("cache_hit_rate")
    )
