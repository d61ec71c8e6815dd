"""Scalar column expressions.

All of them are built-in Spark expressions so they stay inside whole-stage
code generation; none is a Python UDF.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the source data's conventions.
# Rating labels as they appear in the raw rating column, lowest to highest.
RATING_LABELS = [
    "allstar10 rating",
    "allstar20 rating",
    "allstar30 rating",
    "allstar40 rating",
    "allstar50 rating",
]
# Role labels inside the movie writer / starring columns.
WRITER_LABEL = "编剧:"
STARRING_LABEL = "主演:"
# A writer value containing this word is really a starring list.
STARRING_WORD = "主演"
# Placeholder written into the writer column after such a move.
NOT_PROVIDED = "未提供"
# Truncated name lists end in "..." or "更多..."; both become "/更多...".
# The pattern is a regular expression: the dots after 更多 match any character.
MORE_PATTERN = r"\.{3}|更多..."
MORE_REPLACEMENT = "/更多..."
# Character position (1-based) of the star digit inside a rating label.
RATING_DIGIT_POS = 8
# ---------------------------------------------------------------------------


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def any_of(conds: list[Column]) -> Column:
    """OR of the conditions (SQL three-valued logic, like ``reduce(_||_)``)."""
    return reduce(lambda a, b: a | b, conds)


def all_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def any_null(cols: list[str]) -> Column:
    """True when at least one column is null."""
    return any_of([F.col(c).isNull() for c in cols])


def any_not_null(cols: list[str]) -> Column:
    """True unless every column is null (the 'drop all-null rows' predicate)."""
    return any_of([F.col(c).isNotNull() for c in cols])


def any_contains(cols: list[str], needle: str) -> Column:
    return any_of([F.col(c).contains(needle) for c in cols])


def has_rating_label(c="user_rating") -> Column:
    """True when the value contains one of the five rating labels."""
    return any_of([col_(c).contains(lbl) for lbl in RATING_LABELS])


def rating_from_label(c="user_rating") -> Column:
    """``allstar30 rating`` -> 3.0; anything malformed -> null (never an error)."""
    return F.substring(col_(c), RATING_DIGIT_POS, 1).try_cast("double")


def remove_literal(c, text: str) -> Column:
    """Remove every occurrence of a literal string."""
    return F.replace(col_(c), F.lit(text), F.lit(""))


def mark_truncated(c) -> Column:
    """Rewrite ``...`` / ``更多...`` tails as ``/更多...`` (regular expression)."""
    return F.regexp_replace(col_(c), MORE_PATTERN, MORE_REPLACEMENT)


def strip_brackets(c) -> Column:
    """Remove ``[`` and ``]`` characters."""
    return F.regexp_replace(col_(c), r"[\[\]]", "")


def epoch_to_year_month(c) -> Column:
    """Epoch seconds -> ``yyyyMM`` as int, in UTC.

    Computed from the day number, so the result does not depend on the
    session or JVM time zone.  Malformed values give null.
    """
    secs = col_(c).try_cast("bigint")
    day = F.date_from_unix_date(F.floor(secs / F.lit(86400)).cast("int"))
    return (F.year(day) * 100 + F.month(day)).cast("int")


def timestamp_to_epoch(c, zone_aware: bool = False) -> Column:
    """Timestamp -> epoch seconds.

    ``TIMESTAMP_NTZ`` / ``DATE`` values are wall-clock times and are read as
    UTC from their calendar fields; a zone-aware ``TIMESTAMP`` is an instant
    and converts directly.  Neither depends on the session time zone.
    """
    ts = col_(c)
    if zone_aware:
        return F.unix_seconds(ts)
    days = F.unix_date(ts.cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def truncate_toward_zero(c) -> Column:
    """``rating.toInt.toDouble``: drop the fraction, keep the sign."""
    return col_(c).try_cast("int").cast("double")


def percent_of(part, whole) -> Column:
    return F.try_divide(F.lit(100.0) * col_(part), col_(whole))


def f1(p, r) -> Column:
    """Harmonic mean; null when both are zero (instead of NaN)."""
    return F.try_divide(F.lit(2.0) * col_(p) * col_(r), col_(p) + col_(r))


def join_values(cols: list, sep: str = ",") -> Column:
    """Comma-joined text of several values (the saved result line format)."""
    return F.concat_ws(sep, *[col_(c).cast("string") for c in cols])


def date_key(c) -> Column:
    """``yyyy-MM-dd`` -> ``yyyyMMdd`` text (removes every dash)."""
    return F.replace(col_(c), F.lit("-"), F.lit(""))
