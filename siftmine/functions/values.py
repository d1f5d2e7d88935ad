"""Column expressions for cleaning numbers held as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Pay periods per year, by the survey's own labels.
PERIODS_PER_YEAR = {"Monthly": 12, "Weekly": 52}

# Range of a 32-bit integer.
INT_MIN, INT_MAX = -2147483648, 2147483647


def strip_commas(column: Column) -> Column:
    return F.replace(column, F.lit(","), F.lit(""))


def lenient_double(column: Column) -> Column:
    """Text to double; text that is no number gives null."""
    return column.try_cast("double")


def per_year(amount: Column, period: Column, factors: dict[str, int] | None = None) -> Column:
    """``amount`` times the yearly factor of its ``period``; unknown periods count once."""
    factor = F.lit(1)
    for label, times in (factors or PERIODS_PER_YEAR).items():
        factor = F.when(period == label, times).otherwise(factor)
    return amount * factor


def saturating_int(column: Column) -> Column:
    """Cut a double to a 32-bit integer, holding values beyond the range at its ends."""
    bounded = F.least(F.greatest(column, F.lit(float(INT_MIN))), F.lit(float(INT_MAX)))
    # The bounds skip null, which must stay null.
    return F.when(column.isNotNull(), bounded.cast("int"))
