"""Sentiment, entities and urgency from model replies; repeat contacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidedesk.functions.replies import ENRICHMENT, ENTITY_TYPE, SIMPLE_ENRICHMENT, parse_replies
from tidedesk.operators.keyed import attach_by_key, count_by_key
from tidedesk.operators.budget import token_cost
from tidedesk.operators.scoring import TOKENS, tally
from tidedesk.schema import ENTITY_LISTS, MODEL_PRICES, SENTIMENTS, URGENCY_DEFAULT, URGENCY_DEFAULT_REASON

FIELDS = ["sentiment", "sentiment_confidence", "entities", "summary", "urgency_score", "urgency_reason"]


def no_entities() -> Column:
    return F.struct(*[F.array().cast("array<string>").alias(n) for n in ENTITY_LISTS]).cast(ENTITY_TYPE)


def enrichment_results(full: DataFrame, simple: DataFrame) -> DataFrame:
    """One row per scored ticket: fields, ``ok``, ``model`` and billed tokens.

    The simple reply stands in when the full one is unusable. A refusal, or a
    reply without text, ends the attempt: nothing stands in for it.
    """
    f = parse_replies(full, ENRICHMENT).select(
        "row_seq", "answered", F.col("reply").alias("full"),
        F.struct(*TOKENS).alias("full_tokens"),
    )
    s = parse_replies(simple, SIMPLE_ENRICHMENT).filter(F.col("reply").isNotNull()).select(
        "row_seq", F.col("reply").alias("simple"), F.struct(*TOKENS).alias("simple_tokens"),
    )
    full_ok = F.col("full").isNotNull()
    simple_ok = ~full_ok & F.col("answered") & F.col("simple").isNotNull()
    stand_in = {
        "sentiment": F.col("simple.sentiment"), "sentiment_confidence": F.lit(0.5),
        "entities": no_entities(), "summary": F.col("simple.summary"),
        "urgency_score": F.lit(URGENCY_DEFAULT), "urgency_reason": F.lit(URGENCY_DEFAULT_REASON),
    }
    joined = f.join(s, "row_seq", "left")
    return joined.select(
        "row_seq",
        *[F.when(full_ok, F.col(f"full.{c}")).when(simple_ok, stand_in[c]).alias(c) for c in FIELDS],
        (full_ok | simple_ok).alias("ok"),
        F.when(full_ok, F.lit("small")).when(simple_ok, F.lit("large")).alias("model"),
        *[F.when(full_ok, F.col(f"full_tokens.{t}"))
          .when(simple_ok, F.lit(0) if t == "cache_read_tokens" else F.col(f"simple_tokens.{t}"))
          .otherwise(F.lit(0)).cast("long").alias(t) for t in TOKENS],
    )


def unusable_replies(full: DataFrame) -> DataFrame:
    """``row_seq`` of answered full replies that failed validation: the simple prompt is due."""
    return parse_replies(full, ENRICHMENT).filter(F.col("answered") & F.col("reply").isNull()).select("row_seq")


def _with_defaults() -> dict[str, Column]:
    got = F.coalesce(F.col("_r.ok"), F.lit(False))
    default = {
        "sentiment": F.lit(None).cast("string"), "sentiment_confidence": F.lit(None).cast("double"),
        "entities": no_entities(), "summary": F.lit(None).cast("string"),
        "urgency_score": F.lit(URGENCY_DEFAULT), "urgency_reason": F.lit(URGENCY_DEFAULT_REASON),
    }
    return {
        **{c: F.when(got, F.col(f"_r.{c}")).otherwise(default[c]) for c in FIELDS},
        "enrichment_failed": ~got,
    }


def merge_enrichment(tickets: DataFrame, results: DataFrame, contacts: bool = False) -> DataFrame:
    """Add the enrichment columns; tickets without a usable result get the defaults.

    ``contacts`` adds ``repeat_contact`` too. It is found on ids alone and joined with the results
    first, so the tickets themselves move once.
    """
    r = results.select("row_seq", F.struct("ok", *FIELDS).alias("_r"))
    base = [c for c in tickets.columns if c not in (*FIELDS, "enrichment_failed", *["repeat_contact"] * contacts)]
    more = []
    if contacts:
        r = repeat_contact(tickets.select("row_seq", "customer_id")).drop("customer_id").join(r, "row_seq", "left")
        more = ["repeat_contact"]
    return tickets.select(*base).join(r, "row_seq", "left").select(
        *base, *[c.alias(n) for n, c in _with_defaults().items()], *more
    )


def resume(previous: DataFrame, results: DataFrame) -> DataFrame:
    """Apply ``results`` to the failed rows of an earlier output, keep the rest.

    Only failed rows are joined. No customer can change, so ``repeat_contact`` is kept from
    ``previous``; it is computed over all rows if that output lacks it. Write the outcome to
    a new path: Spark reads ``previous`` while it writes.
    """
    columns = [c for c in previous.columns if c != "repeat_contact"]
    known = ["repeat_contact"] if "repeat_contact" in previous.columns else []
    failed = F.coalesce(F.col("enrichment_failed"), F.lit(True))
    kept = previous.filter(~failed).select(*columns, *known)
    redone = merge_enrichment(previous.filter(failed), results).select(*columns, *known)
    both = kept.unionByName(redone)
    return both if known else repeat_contact(both)


def entities_json(c: Column) -> Column:
    """Entities as JSON text, valid for failed rows too."""
    return F.to_json(F.coalesce(c, no_entities()))


def entity_counts(df: DataFrame) -> DataFrame:
    """Mentions per entity kind and value."""

    def named(kind: str) -> Column:
        return F.transform(
            f"entities.{kind}", lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("value")))

    mentions = F.concat(*[named(n) for n in ENTITY_LISTS])
    return df.select(F.explode(mentions).alias("m")).groupBy("m.kind", "m.value").agg(
        F.count("*").alias("mentions")
    )


def repeat_contact(df: DataFrame, k: int = 3, key: str = "customer_id") -> DataFrame:
    """Add ``repeat_contact``: the customer occurs in at least ``k`` rows."""
    counts = count_by_key(df, key).withColumn("repeat_contact", F.col("n") >= k)
    rows = df.drop("repeat_contact")
    return attach_by_key(
        rows, key, counts, ["repeat_contact"], keep=F.col("repeat_contact")
    ).withColumn("repeat_contact", F.coalesce("repeat_contact", F.lit(False)))


def run_cost(results: DataFrame) -> DataFrame:
    """``(section, name, value)``: tokens used, dollars to 4 digits, and the cache-hit rate of the small model's
    calls (the only ones that read a cache)."""
    small = F.col("model") == "small"
    tokens = {(m, t): F.coalesce(F.sum(F.when(F.col("model") == m, F.col(t))), F.lit(0)) for m in MODEL_PRICES for t in TOKENS[:2]}
    cost = F.lit(0.0)
    for m, price in MODEL_PRICES.items():
        cost = cost + token_cost(tokens[m, "input_tokens"], tokens[m, "output_tokens"], price)
    read = F.coalesce(F.sum(F.when(small, F.col("cache_read_tokens"))), F.lit(0))
    served = tokens["small", "input_tokens"] + read
    return tally(results, {
        ("totals", "tokens_used"): sum(tokens.values(), F.lit(0)),
        ("totals", "cost_usd"): F.round(cost, 4),
        ("totals", "cache_hit_rate"): F.round(read / F.nullif(served, F.lit(0)), 4),
    })


def usage_by_model(results: DataFrame) -> DataFrame:
    """Billed tokens per model."""
    return results.filter(F.col("model").isNotNull()).groupBy("model").agg(
        F.count("*").alias("replies"), *[F.sum(t).alias(t) for t in TOKENS]
    )


def enrichment_report(df: DataFrame, results: DataFrame | None = None) -> DataFrame:
    """Counts, zero-filled sentiment distribution, urgency buckets, failure share.

    ``results`` (:func:`enrichment_results`) adds tokens, dollars and the cache-hit rate of the run.
    """
    u = F.col("urgency_score")
    failed = F.count_if("enrichment_failed")
    report = tally(df, {
        ("totals", "total"): F.count("*"),
        ("totals", "enriched"): F.count_if(~F.col("enrichment_failed")),
        ("totals", "failed"): failed,
        ("totals", "repeat_contacts"): F.count_if("repeat_contact"),
        ("totals", "enrichment_failed_pct"): F.round(failed / F.nullif(F.count("*"), F.lit(0)), 4),
        **{("sentiment_distribution", s): F.count_if(F.col("sentiment") == s) for s in SENTIMENTS},
        ("urgency_distribution", "low (0.0-0.3)"): F.count_if(u <= 0.3),
        ("urgency_distribution", "medium (0.4-0.6)"): F.count_if((u > 0.3) & (u <= 0.6)),
        ("urgency_distribution", "high (0.7-1.0)"): F.count_if(u > 0.6),
    })
    return report if results is None else report.unionByName(run_cost(results))
