"""Sums, averages and conditional counts.

A sum of doubles changes in its last digits with the order in which partitions arrive, and over
billions of rows that drift exceeds a one-cent control-total tolerance. Measures with a declared
number of decimals are therefore summed as decimals, which is exact in any order; for all other
doubles the plain sum is taken. The declaration decides, never the values.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.columns import named

DIGITS = 28  # of a declared measure; its sums have ten more
PART = 26  # bits of the lower part of a whole number of units
NOISE = 2.0**-40  # relative error that arithmetic on doubles may leave in a measure


def measure(column: str | Column, scale: int) -> Column:
    """A double as a decimal of ``scale`` places; one that needs more of them raises.

    Only what arithmetic leaves is rounded off: NOISE of the value, or a millionth of the last place.
    """
    x = named(column).cast("double")
    exact = x.try_cast(f"decimal({DIGITS},{scale})")
    noise = F.greatest(F.abs(x) * F.lit(NOISE), F.lit(10.0 ** -(scale + 6)))
    fits = F.abs(exact.cast("double") - x) <= noise
    problem = F.concat(F.lit(f"no measure of {scale} decimals: "), x.cast("string"))
    return F.when(x.isNull() | fits, exact).otherwise(F.raise_error(problem))


def exact_sum(column: str | Column, scale: int) -> Column:
    """The sum of a measure as a decimal, exact in any order.

    Values are counted in units of the last place, as whole numbers in two parts whose sums stay
    far from 64 bits; only values too large for that go through decimals row by row.
    """
    x = named(column).cast("double")
    units = F.rint(x * F.lit(10.0**scale))
    noise = F.greatest(F.abs(x) * F.lit(NOISE), F.lit(10.0 ** -(scale + 6)))
    # below 2 ** 50 the product is off by less than a quarter of a unit; NaN is above everything
    plain = (F.abs(units) < 2.0**50) & (F.abs(units / F.lit(10.0**scale) - x) <= noise)
    whole = F.when(plain, units.cast("long"))
    high, low = F.sum(F.shiftright(whole, PART)), F.sum(whole.bitwiseAND((1 << PART) - 1))
    both = high.cast("decimal(20,0)") * F.lit(Decimal(1 << PART)) + low.cast("decimal(20,0)")
    common = both.cast("decimal(30,0)") * F.lit(Decimal(1).scaleb(-scale))
    rare = F.sum(F.when(x.isNotNull() & ~plain, measure(x, scale)))
    zero = F.lit(Decimal(0)).cast(f"decimal(38,{scale})")
    return F.when(F.count(x) > 0, F.coalesce(common, zero) + F.coalesce(rare, zero))


def _fractional(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType))


def total(df: DataFrame, column: str, scale: int | None = None) -> Column:
    """Sum of ``column``; doubles with a declared ``scale`` are added as decimals."""
    if scale is not None and _fractional(df, column):
        return exact_sum(column, scale).cast("double")
    return F.sum(named(column))


def mean(df: DataFrame, column: str, scale: int | None = None) -> Column:
    """Average over the non-NULL values of ``column``."""
    return F.try_divide(total(df, column, scale).cast("double"), F.count(named(column)))


def count_true(flag: str | Column) -> Column:
    """Rows whose flag is true; a missing flag counts as false."""
    return F.count_if(named(flag))
