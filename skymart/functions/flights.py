"""Derived flight columns, all built-in expressions that stay inside codegen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from skymart import schema


def first_match(cases: list[tuple[Column, str | None]], otherwise: str | None = None) -> Column:
    """Label of the first true condition, as one CASE: small enough code to be compiled."""
    return reduce(lambda case, c: case.when(c[0], c[1]), cases, F).otherwise(otherwise)


def minutes_or_zero(minutes: Column) -> Column:
    return F.coalesce(minutes, F.lit(0.0))


def hhmm_hour(hhmm: Column) -> Column:
    """First two digits of a clock number padded to four: 5 -> 0, 2400 -> 24."""
    padded = F.lpad(hhmm.cast("string"), 4, "0")
    return F.when(hhmm.between(0, 9999), F.floor(hhmm / 100).cast("int")).otherwise(
        F.left(padded, F.lit(2)).try_cast("int")
    )


def time_period(hour: Column) -> Column:
    """Unmatched hours, 24 and NULL included, fall into the last bucket."""
    return first_match(
        [(hour.between(low, high), name) for name, low, high in schema.TIME_PERIODS],
        schema.OTHER_PERIOD,
    )


def weekday_name(day: Column) -> Column:
    names = F.array(*map(F.lit, schema.WEEKDAYS))
    return F.get(names, F.dayofweek(day) - 1)  # unlike element_at, NULL for a NULL day


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def total_delay(parts: dict[str, Column]) -> Column:
    return reduce(lambda a, b: a + b, parts.values())


def primary_cause(parts: dict[str, Column]) -> Column:
    """Label of the largest positive part; on a tie the earlier label."""
    top = F.greatest(*parts.values())
    none = (~(top > 0), schema.NO_CAUSE)
    return first_match([none, *((part == top, label) for label, part in parts.items())])


def route(origin: Column, dest: Column) -> Column:
    """NULL when either end is NULL."""
    return F.concat(origin, F.lit("-"), dest)


def distance_bucket(miles: Column) -> Column:
    """NULL distance counts as the longest bucket."""
    return first_match(
        [(miles < limit, name) for name, limit in schema.HAULS], schema.LONGEST_HAUL
    )


def same_state(origin_state: Column, dest_state: Column) -> Column:
    """Unknown origin state is false; known origin with unknown destination is NULL."""
    return origin_state.isNotNull() & (origin_state == dest_state)


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def us_state(city: Column, country: Column) -> Column:
    """The part after the comma of "City, ST", for airports in the United States only."""
    state = blank_to_null(F.split_part(F.trim(city), F.lit(", "), F.lit(2)))
    return F.when(F.trim(country) == "United States", state)


def degrees(value: Column) -> Column:
    return F.round(value.cast("decimal(28,12)"), 4).cast("decimal(18,4)")


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")
