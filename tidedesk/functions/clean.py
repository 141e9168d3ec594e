"""Field-level normalisation rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidedesk.functions.text import strip
from tidedesk.schema import UNKNOWN, UUID4

# Layouts after the text is brought to one form (see ``_canonical``), tried in this order. Where day
# and month could be either, the month comes first; two-digit years lie in 1970-2069.
DATE_PATTERNS = [
    "yyyy-M-d[ H:mm[:ss]]", "yyyy-M-d h:mm[:ss] a",
    "M/d/yyyy[ H:mm[:ss]]", "M/d/yyyy h:mm[:ss] a", "d/M/yyyy[ H:mm[:ss]]", "d/M/yyyy h:mm[:ss] a",
    "M/d/yy[ H:mm[:ss]]", "M/d/yy h:mm[:ss] a", "d/M/yy[ H:mm[:ss]]",
    "MMM yyyy", "MMM d yyyy[ H:mm[:ss]]", "MMM d yyyy h:mm[:ss] a", "d MMM yyyy[ H:mm[:ss]]", "d MMM yyyy h:mm[:ss] a",
]
_MONTHS = "jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec"
_OFFSET = r"(?<=:\d{2}|:\d{2} )([+-])(\d{2}):?(\d{2})\z"


def _canonical(t: Column) -> Column:
    """One spelling for many: no weekday, commas, ordinal endings or zone words; months by three letters;
    ``-`` in year-first dates, ``/`` in the others; compact digits spread out."""
    for pattern, by in (
        (r"(?i)\A(mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+", ""),  # Mon, 15 Jan 2024
        (rf"(?i)({_MONTHS})[a-z]*\.?", "$1"),  # January, Sept.
        (r"(?i)(\d)(st|nd|rd|th)\b", "$1"),
        (r",", " "),
        (r"(\d)[- ]*-[- ]*([A-Za-z]{3})[- ]*-[- ]*(\d)", "$1 $2 $3"),  # 05-Jan-2024
        (r"\A(\d{4})(\d{2})(\d{2})[T ]?(\d{2}):?(\d{2}):?(\d{2})", "$1-$2-$3 $4:$5:$6"),
        (r"\A(\d{4})(\d{2})(\d{2})[T ]?(\d{2}):?(\d{2})(?!\d)", "$1-$2-$3 $4:$5"),
        (r"\A(\d{4})(\d{2})(\d{2})\z", "$1-$2-$3"),
        (r"\A(\d{4})[-./](\d{1,2})[-./](\d{1,2})(?!\d)", "$1-$2-$3"),
        (r"\A(\d{1,2})[-./](\d{1,2})[-./](\d{4}|\d{2})(?!\d)", "$1/$2/$3"),
        (r"\A(\d{1,2}/\d{1,2})/([7-9]\d)(?!\d)", "$1/19$2"),
        (r"(\d)T(\d)", "$1 $2"),
        (r"(:\d{2})[.]\d+", "$1"),  # fractions are kept by the ISO cast only
        (r"(?i)\s*(z|gmt|utc)\z", ""),
        (r"(?i)\s*([ap])\.?m\.?\z", " $1m"),
        (r"\s+", " "),
    ):
        t = F.regexp_replace(t, pattern, by)
    return F.upper(t)


def parse_ts(c: Column) -> Column:
    """Text in mixed formats to a UTC timestamp; anything else becomes null.

    ISO texts are cast, with their fraction and zone. Others are brought to one spelling and matched
    with ``DATE_PATTERNS``; a numeric offset behind the time is taken off. ``01/02/2024`` is the second
    of January, ``15/01/2024`` the fifteenth. Bare clock times and words such as ``now`` are no dates,
    because a result must not depend on the day it runs.
    """
    t = strip(c)
    iso = F.when(t.rlike(r"\A\d{4}(-|\z)"), t.try_cast("timestamp"))
    # a one-element array, so that the spelling is worked out once for all patterns
    return F.coalesce(iso, F.get(F.transform(F.array(_canonical(t)), _by_patterns), F.lit(0)))


def _by_patterns(plain: Column) -> Column:
    sign, hours, minutes = (F.regexp_extract(plain, _OFFSET, i) for i in (1, 2, 3))
    local = F.rtrim(F.regexp_replace(plain, _OFFSET, ""))
    parsed = F.coalesce(*[F.try_to_timestamp(local, F.lit(p)) for p in DATE_PATTERNS])
    shift = F.when(sign == "", 0).otherwise(
        (hours.try_cast("int") * 60 + minutes.try_cast("int")) * F.when(sign == "-", -1).otherwise(1))
    return parsed - F.make_dt_interval(mins=shift)


def _folded(c: Column) -> Column:
    return F.lower(strip(c))


def norm_enum(c: Column, valid: list[str]) -> Column:
    """Fold case and space; outside the set, or null, is ``unknown``."""
    n = _folded(c)
    return F.when(n.isin(valid), n).otherwise(F.lit(UNKNOWN))


def norm_priority(c: Column, valid: list[str]) -> Column:
    """Fold case and space; outside the set is null."""
    n = _folded(c)
    return F.when(n.isin(valid), n)


def enum_violation(c: Column, valid: list[str]) -> Column:
    """The folded value when it is present but not allowed, else null."""
    n = _folded(c)
    return F.when(~n.isin(valid), n)


def is_uuid4(c: Column) -> Column:
    return F.coalesce(c.rlike(rf"(?i)\A{UUID4}\z"), F.lit(False))
