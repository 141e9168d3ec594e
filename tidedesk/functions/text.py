"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The Unicode white space: the characters below U+0100 and those above it.
_LOW = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0"
_HIGH = (
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_SPACES = " " + _LOW + _HIGH
# As pattern classes. The range in front lets most characters fail after one look.
_NOT_BLANK = rf"[{_LOW}[\u1680-\u3000&&[{_HIGH}]]]"
SPACE = rf"[\x20{_LOW}[\u1680-\u3000&&[{_HIGH}]]]"
_LINE_END = r"(?:\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}])"


def strip(c: Column) -> Column:
    """Remove leading and trailing white space, Unicode spaces included."""
    return F.btrim(c, F.lit(_SPACES))


def blank_to_null(c: Column) -> Column:
    """Strip; an empty result becomes null."""
    return F.nullif(strip(c), F.lit(""))


def strip_html(c: Column) -> Column:
    """Remove ``<...>`` tags. Texts without ``>`` skip the pattern altogether."""
    return F.when(c.contains(">"), F.regexp_replace(c, "<[^>]++>", "")).otherwise(c)


def folded(c: Column) -> Column:
    """Stripped and lower-cased."""
    return F.lower(strip(c))


def collapse(c: Column) -> Column:
    """Every run of white space becomes one blank.

    The pattern leaves single blanks alone, so ordinary text is copied, not edited.
    """
    return F.regexp_replace(c, rf"\x20{SPACE}++|{_NOT_BLANK}{SPACE}*+", " ")


def fingerprint(c: Column) -> Column:
    """32 bytes that stand for a text, so shuffles never carry the text itself."""
    return F.unhex(F.sha2(c, 256))


def strip_fences(c: Column) -> Column:
    """Drop a Markdown code fence around a text.

    When the stripped text starts with three backticks its first line goes, and
    its last line too if that is a bare fence.
    """
    t = strip(c)
    no_first = F.regexp_replace(t, rf"(?s)\A```.*?(?:{_LINE_END}|\z)", "")
    no_last = F.regexp_replace(no_first, rf"(?:\A|{_LINE_END}){SPACE}*```\z", "")
    return F.when(t.startswith("```"), strip(no_last)).otherwise(t)
