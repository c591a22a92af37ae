"""Rates and means that round half away from zero without float error.

Counts and sums of whole minutes are exact as bigint or double (up to 2**53), so
they are aggregated in their cheap native types; only the division and rounding,
once per group, use decimals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMERATOR = "decimal(24,6)"
_COUNT = "decimal(20,0)"
_RESULT = "decimal(18,{})"


def row_count() -> Column:
    """Aggregate: count(*)."""
    return F.count(F.lit(1))


def ratio(numerator: Column, count: Column) -> Column:
    """numerator / count to 20 decimal places; NULL when count is 0."""
    return numerator.cast(_NUMERATOR) / F.nullif(count, F.lit(0)).cast(_COUNT)


def rounded(value: Column, scale: int = 2) -> Column:
    return F.round(value, scale).cast(_RESULT.format(scale))


def mean(total: Column, count: Column, scale: int = 2) -> Column:
    return rounded(ratio(total, count), scale)


def percent_unrounded(part: Column, whole: Column) -> Column:
    return ratio(part * 100, whole)


def percent(part: Column, whole: Column, scale: int = 2) -> Column:
    """100 * part / whole for counts."""
    return rounded(percent_unrounded(part, whole), scale)


def percent_of_sum(part: Column, whole: Column, scale: int = 2) -> Column:
    """100 * part / whole where both are sums of minutes."""
    whole = F.nullif(whole, F.lit(0.0)).cast(_NUMERATOR)
    return rounded((part * 100).cast(_NUMERATOR) / whole, scale)


def mean_where(value: Column, keep: Column, scale: int = 2) -> Column:
    """Aggregate: mean of ``value`` over the rows where ``keep`` is true; NULL if none."""
    return mean(F.sum(F.when(keep, value)), F.count(F.when(keep, value)), scale)


def mean_of_means(value: Column, scale: int) -> Column:
    """Aggregate: unweighted mean of an already rounded decimal column, NULLs ignored."""
    return mean(F.sum(value), F.count(value), scale)
