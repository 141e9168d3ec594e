"""Validation of model replies: JSON text in, checked struct or null out.

The steps are separate projections on purpose: each parsed value is used several
times, and one nested expression would be generated once per use.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidedesk.functions.text import strip, strip_fences
from tidedesk.schema import (
    ANOMALY_TYPES, CATEGORIES, ENTITY_LISTS, PRIORITIES, SENTIMENTS, SEVERITIES,
    VERDICT_ACTIONS,
)

_LISTS = ",".join(f"{n}:array<string>" for n in ENTITY_LISTS)
ENTITY_TYPE = f"struct<{_LISTS}>"


def reply_ok(raw: Column, stop_reason: Column) -> Column:
    """False for a refusal and for a reply without text."""
    return raw.isNotNull() & F.coalesce(stop_reason != "refusal", F.lit(True))


def reply_json(text: Column) -> Column:
    """The text as exactly one JSON value under ``r``, null when it is not that.

    Spark's JSON functions stop reading after the first value. Wrapping the text
    once in an object and once in an array makes any trailing text a syntax
    error in at least one of the two.
    """
    single = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    return F.when(single, F.try_parse_json(F.concat(F.lit('{"r":'), text, F.lit("}"))))


@dataclass(frozen=True)
class Contract:
    """What a reply must hold: its type, and per field a rule that is null when broken.

    ``typed`` lists the paths whose JSON kind a rule looks at, because a cast alone
    would accept a number where text is required.
    """

    shape: str
    rules: dict[str, Callable[[], Column]]
    typed: tuple[str, ...] = ()


def _value(name: str) -> Column:
    return F.col(f"_r.{name}")


def _kind(name: str) -> Column:
    return F.col(f"_kind_{name.replace('.', '_')}")


def _choice(name: str, allowed: list[str]) -> Callable[[], Column]:
    return lambda: F.when(_value(name).isin(allowed), _value(name))


def _unit(name: str, digits: int) -> Callable[[], Column]:
    return lambda: F.when(_value(name).between(0.0, 1.0), F.round(_value(name), digits))


def _sentence(name: str) -> Callable[[], Column]:
    return lambda: F.when(_kind(name) == "STRING", F.nullif(strip(_value(name)), F.lit("")))


def _entities() -> Column:
    """A missing list is empty; anything but a list of texts is an error."""
    good = _kind("entities").startswith("OBJECT")
    lists = []
    for n in ENTITY_LISTS:
        kind, values = _kind(f"entities.{n}"), _value(f"entities.{n}")
        texts = kind.isin("ARRAY<STRING>", "ARRAY<VOID>") & ~F.exists(values, lambda x: x.isNull())
        good = good & (kind.isNull() | texts)
        lists.append(F.coalesce(values, F.array().cast("array<string>")).alias(n))
    return F.when(good, F.struct(*lists))


CLASSIFICATION = Contract(
    "struct<category:string,priority:string,confidence:double>",
    {
        "category": _choice("category", CATEGORIES),
        "priority": _choice("priority", PRIORITIES),
        "confidence": _unit("confidence", 3),
    },
)
ENRICHMENT = Contract(
    f"struct<sentiment:string,sentiment_confidence:double,entities:{ENTITY_TYPE},"
    "summary:string,urgency_score:double,urgency_reason:string>",
    {
        "sentiment": _choice("sentiment", SENTIMENTS),
        "sentiment_confidence": _unit("sentiment_confidence", 3),
        "entities": _entities,
        "summary": _sentence("summary"),
        "urgency_score": _unit("urgency_score", 2),
        "urgency_reason": _sentence("urgency_reason"),
    },
    ("summary", "urgency_reason", "entities", *[f"entities.{n}" for n in ENTITY_LISTS]),
)
SIMPLE_ENRICHMENT = Contract(
    "struct<sentiment:string,summary:string>",
    {"sentiment": _choice("sentiment", SENTIMENTS), "summary": _sentence("summary")},
    ("summary",),
)
VERDICT = Contract(
    "struct<anomaly_type:string,severity:string,reason:string,recommended_action:string>",
    {
        "anomaly_type": _choice("anomaly_type", ANOMALY_TYPES),
        "severity": _choice("severity", SEVERITIES),
        "reason": _sentence("reason"),
        "recommended_action": _choice("recommended_action", VERDICT_ACTIONS),
    },
    ("reason",),
)


def parse_replies(responses: DataFrame, contract: Contract, *, raw: str = "raw_text",
                  stop: str = "stop_reason") -> DataFrame:
    """Replace the raw text by ``answered`` and ``reply`` (checked struct, or null).

    One broken rule voids the reply. Of a key that an object repeats the last value counts, for
    which the session setting ``spark.sql.variant.allowDuplicateKeys`` is turned on. Done before
    any join, so the text itself is never shuffled.
    """
    responses.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    keep = [c for c in responses.columns if c != raw]
    parsed = (
        responses.withColumn("answered", reply_ok(F.col(raw), F.col(stop)))
        .withColumn("_text", F.when(F.col("answered"), strip_fences(F.col(raw))))
        .withColumn("_v", reply_json(F.col("_text")))
        .withColumns({
            "_r": F.try_variant_get("_v", "$.r", contract.shape),
            **{f"_kind_{p.replace('.', '_')}":
               F.schema_of_variant(F.try_variant_get("_v", f"$.r.{p}", "variant"))
               for p in contract.typed},
        })
        .withColumns({f"_ok_{n}": rule() for n, rule in contract.rules.items()})
    )
    good = F.lit(True)
    for n in contract.rules:
        good = good & F.col(f"_ok_{n}").isNotNull()
    reply = F.when(good, F.struct(*[F.col(f"_ok_{n}").alias(n) for n in contract.rules]))
    return parsed.select(*keep, "answered", reply.alias("reply"))
