"""Column expressions shared by the models (FN1-FN22).

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; there is no Python UDF anywhere in the SQL layer.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(a, b) -> Column:
    """FN1: a / b, null when b is 0 or null (never raises under ANSI)."""
    return F.try_divide(col(a), col(b))


def ratio(a, b) -> Column:
    """Double ratio of two (decimal or integral) measures, null on a zero divisor.

    Computed in binary floating point so that any engine doing the same IEEE
    division returns the identical bits.
    """
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def countif(cond: Column) -> Column:
    """FN6: number of rows where ``cond`` is true (null counts as false)."""
    return F.count_if(cond)


def to_day(ts) -> Column:
    """FN7: calendar day of a timestamp (wall clock, no zone shift)."""
    return F.to_date(col(ts))


def week_start(d) -> Column:
    """FN8: Monday of the week containing ``d`` (returns DATE)."""
    return F.trunc(col(d), "week")


def month_start(d) -> Column:
    return F.trunc(col(d), "month")


def iso_week(d) -> Column:
    """FN12: ISO week number (2024-12-30 -> 1)."""
    return F.weekofyear(col(d))


def iso_day_of_week(d) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(col(d)) + F.lit(1)


def ntz(value) -> Column:
    """A TIMESTAMP_NTZ literal from a Python datetime/date.

    ``F.lit(datetime)`` would go through the session time zone; parsing the
    ISO text as TIMESTAMP_NTZ does not."""
    text = value.isoformat(sep=" ") if hasattr(value, "hour") else f"{value.isoformat()} 00:00:00"
    return F.lit(text).cast("timestamp_ntz")


def _interval_part(iv: Column, unit: str) -> Column:
    return F.extract(F.lit(unit), iv)


def whole_hours_between(later, earlier) -> Column:
    """FN11: whole hours from ``earlier`` to ``later``, truncated toward zero.

    Computed from the exact day-time interval ``later - earlier`` (NTZ
    subtraction is zone-free); ``timestamp_diff`` on NTZ values in a DST gap
    follows the session time zone."""
    iv = col(later) - col(earlier)
    return (_interval_part(iv, "DAY") * 24 + _interval_part(iv, "HOUR")).cast("long")


def whole_seconds_between(later, earlier) -> Column:
    """Whole seconds from ``earlier`` to ``later``, truncated toward zero."""
    iv = col(later) - col(earlier)
    return (_interval_part(iv, "DAY") * 86400 + _interval_part(iv, "HOUR") * 3600
            + _interval_part(iv, "MINUTE") * 60
            + _interval_part(iv, "SECOND").cast("long")).cast("long")


def days_between(later, earlier) -> Column:
    """FN10: ``later - earlier`` in days."""
    return F.datediff(col(later), col(earlier))


def weeks_back(d, n_weeks: int) -> Column:
    """FN9: ``d - n weeks``."""
    return F.date_sub(col(d), 7 * int(n_weeks))


def money(c) -> Column:
    """Money is carried as DECIMAL(12,2) inside the models."""
    return col(c).cast("decimal(12,2)")
