"""Scalar expressions: cleaning, safe casts, ratios, restatement and repair.

Everything is a built-in Spark expression, so plans stay inside code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INTEGRAL = {"tinyint", "smallint", "int", "integer", "bigint", "long"}


def named(column: str | Column) -> Column:
    """Column by exact name, also when the name holds dots or blanks."""
    if isinstance(column, Column):
        return column
    return F.col("`" + column.replace("`", "``") + "`")


def clean_id(column: str | Column) -> Column:
    """Identifier without surrounding blanks; blank becomes NULL."""
    return F.nullif(F.trim(named(column)), F.lit(""))


def safe_cast(column: str | Column, to: str) -> Column:
    """Cast that yields NULL for anything unreadable, with ANSI mode on.

    Text such as ``3.0`` is a readable integer (exports of nullable integers
    look like that), so a fraction is cut before an integral cast. Going through
    double instead would lose long precision and accept ``1e3``.
    """
    value = named(column)
    if to.lower() not in INTEGRAL:
        return value.try_cast(to)
    text = value.cast("string")
    whole = F.regexp_replace(F.trim(text), r"^([+-]?\d+)\.\d*$", "$1")
    # One cast: a failed one costs an exception, and none reads text with a point. The pattern runs
    # only for such text.
    return F.when(F.contains(text, F.lit(".")), whole).otherwise(text).try_cast(to)


def ratio(top: str | Column, bottom: str | Column, digits: int = 2) -> Column:
    """``top / bottom`` rounded; NULL when the bottom is zero or missing."""
    return F.round(F.try_divide(named(top).cast("double"), named(bottom).cast("double")), digits)


def guarded_ratio(top: str | Column, bottom: str | Column, digits: int = 2) -> Column:
    """Like :func:`ratio`, but 0 unless the bottom is positive."""
    return F.when(named(bottom) > 0, ratio(top, bottom, digits)).otherwise(F.lit(0.0))


def pct(part: str | Column, whole: str | Column, digits: int = 2) -> Column:
    """Share of ``part`` in ``whole`` as a percentage."""
    share = F.try_divide(named(part).cast("double"), named(whole).cast("double"))
    return F.round(share * 100, digits)


def full_name(*parts: str | Column) -> Column:
    """Parts joined by one blank; missing parts are skipped."""
    return F.concat_ws(" ", *[named(p) for p in parts])


def event_date(timestamp: str | Column) -> Column:
    """Calendar date of an event in the session time zone."""
    return named(timestamp).cast("date")


def restate_cancelled(
    value: str | Column, status: str | Column, cancelled: str = "CANCELLED"
) -> Column:
    """Zero for cancelled rows; a missing status keeps the value."""
    return F.when(F.upper(named(status)) == cancelled, F.lit(0.0)).otherwise(named(value))


def _known(column: Column) -> Column:
    return column.isNotNull() & ~F.isnan(column)


def clamp(value: str | Column, low: float, high: str | Column) -> Column:
    """``value`` limited to [low, high]; unknown when either side is unknown.

    ``least``/``greatest`` skip NULL, hence the explicit guard.
    """
    value, high = named(value), named(high)
    limited = F.greatest(F.least(value, high), F.lit(low))
    return F.when(_known(value) & _known(high), limited)


def floor_at(value: str | Column, low: float) -> Column:
    """``value`` raised to ``low``; unknown stays unknown."""
    value = named(value)
    return F.when(_known(value), F.greatest(value, F.lit(low)))


def ordered_actual(scheduled: str | Column, actual: str | Column) -> Column:
    """Actual time, moved up to the schedule when it lies before it."""
    scheduled, actual = named(scheduled), named(actual)
    return F.when(actual < scheduled, scheduled).otherwise(actual)


def on_time(scheduled: str | Column, actual: str | Column) -> Column:
    """True when the actual time is not after the schedule; unknown counts as late."""
    return F.coalesce(named(actual) <= named(scheduled), F.lit(False))
