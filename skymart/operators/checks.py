"""Data checks on tables. A check counts its violations; ``violating`` shows them."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skymart import schema
from skymart.functions import exact

RESULT_COLUMNS = ("check", "table_name", "column_name", "violations")


@dataclass(frozen=True)
class Check:
    """A rule on one column; NULL passes every rule but not_null."""

    kind: str
    table: str
    column: str
    values: tuple = field(default=())

    def broken(self) -> Column:
        """True for the rows that break the rule; not defined for ``unique``."""
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "accepted_values":
            return ~c.isin(*self.values)
        low, high = self.values
        if self.kind == "accepted_range":
            return ~c.between(low, high)
        if self.kind == "range_exclusive":
            return ~((c > low) & (c < high))
        if self.kind == "valid_delays":
            return (F.col("arr_delay_minutes") > high) | (F.col("dep_delay_minutes") > high)
        if self.kind == "positive_distance":
            return (c.isNull() | (c <= low)) & ~F.col("is_cancelled")
        raise ValueError(f"unknown check {self.kind}")


def _checks(kind: str, table: str, *columns: str, values: tuple = ()) -> list[Check]:
    return [Check(kind, table, column, values) for column in columns]


_DELAY_LABELS = tuple(label for label, _, _ in schema.DELAY_CATEGORIES)
_PERIODS = (*(name for name, _, _ in schema.TIME_PERIODS), schema.OTHER_PERIOD)
_CAUSES = (*(label for label, _ in schema.DELAY_CAUSES), schema.NO_CAUSE)
_HAULS = (*(name for name, _ in schema.HAULS), schema.LONGEST_HAUL)

# Which rule holds for which column, and its bounds.
DECLARED: tuple[Check, ...] = (
    *_checks("unique", "stg_flights", "flight_id"),
    *_checks(
        "not_null", "stg_flights", "flight_id", "fl_date", "reporting_airline", "origin", "dest"
    ),
    *_checks("accepted_range", "stg_flights", "distance", values=(1, 6000)),
    *_checks("accepted_range", "stg_flights", "dep_hour", values=(0, 23)),
    *_checks("accepted_range", "stg_flights", "arr_delay_minutes", values=(-120, 1500)),
    *_checks("accepted_values", "stg_flights", "dep_time_period", values=_PERIODS),
    *_checks("accepted_values", "stg_flights", "primary_delay_cause", values=_CAUSES),
    *_checks("unique", "stg_airlines", "iata_code"),
    *_checks("not_null", "stg_airlines", "iata_code", "carrier_name"),
    *_checks("unique", "stg_airports", "iata_code"),
    *_checks("not_null", "stg_airports", "iata_code", "airport_name"),
    *_checks("accepted_range", "stg_airports", "latitude", values=(-90, 90)),
    *_checks("accepted_range", "stg_airports", "longitude", values=(-180, 180)),
    *_checks("unique", "int_flights_enriched", "flight_id"),
    *_checks(
        "not_null", "int_flights_enriched", "flight_id", "fl_date", "reporting_airline",
        "carrier_name", "origin", "origin_airport_name", "dest", "dest_airport_name",
    ),
    *_checks("accepted_values", "int_flights_enriched", "delay_label", values=_DELAY_LABELS),
    *_checks("accepted_values", "int_flights_enriched", "distance_bucket", values=_HAULS),
    *_checks("accepted_range", "int_flights_enriched", "distance", values=(1, 6000)),
    *_checks("accepted_range", "int_flights_enriched", "arr_delay_minutes", values=(-120, 1500)),
    *_checks(
        "not_null", "mart_carrier_performance", "carrier_name", "reporting_airline",
        "flight_month", "total_flights",
    ),
    *_checks(
        "accepted_range", "mart_carrier_performance", "cancellation_rate",
        "on_time_arrival_rate", "on_time_departure_rate", values=(0, 100),
    ),
    *_checks(
        "range_exclusive", "mart_carrier_performance", "avg_arr_delay_minutes", values=(0, 1500)
    ),
    *_checks("unique", "mart_airport_performance", "iata_code"),
    *_checks(
        "not_null", "mart_airport_performance", "iata_code", "airport_name",
        "total_departures", "airport_rank",
    ),
    *_checks(
        "accepted_range", "mart_airport_performance", "departure_cancellation_rate",
        values=(0, 100),
    ),
    *_checks(
        "range_exclusive", "mart_airport_performance", "avg_departure_delay", values=(0, 1500)
    ),
    *_checks(
        "not_null", "mart_delay_analysis", "delay_label", "primary_delay_cause", "flight_count"
    ),
    *_checks("accepted_values", "mart_delay_analysis", "delay_label", values=_DELAY_LABELS),
    *_checks("accepted_range", "mart_delay_analysis", "avg_arr_delay_minutes", values=(-120, 1500)),
    *_checks("not_null", "mart_route_analysis", "route", "carrier_name", "total_flights"),
    *_checks(
        "accepted_range", "mart_route_analysis", "on_time_rate", "cancellation_rate",
        values=(0, 100),
    ),
    *_checks("range_exclusive", "mart_route_analysis", "avg_arr_delay_minutes", values=(0, 1500)),
    *_checks("valid_delays", "stg_flights", "arr_delay_minutes", values=(None, 1500)),
    *_checks("positive_distance", "stg_flights", "distance", values=(0, None)),
)


def _repeated(df: DataFrame, column: str) -> DataFrame:
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(exact.row_count().alias("n"))
    return counts.filter(F.col("n") > 1)


def violating(df: DataFrame, check: Check) -> DataFrame:
    """The rows that break the rule; for ``unique`` the repeated values with their count."""
    return _repeated(df, check.column) if check.kind == "unique" else df.filter(check.broken())


def _result(check: Check, violations: Column) -> Column:
    return F.struct(
        F.lit(check.kind).alias("check"),
        F.lit(check.table).alias("table_name"),
        F.lit(check.column).alias("column_name"),
        violations.alias("violations"),
    )


def _row_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All row rules of one table in a single aggregate, then one output row per rule."""
    names = [f"v{i}" for i in range(len(checks))]
    counts = df.agg(*[F.count_if(c.broken()).alias(n) for c, n in zip(checks, names)])
    results = F.array(*[_result(c, F.col(n)) for c, n in zip(checks, names)])
    return counts.select(F.inline(results))


def _unique_check(df: DataFrame, check: Check) -> DataFrame:
    repeated = _repeated(df, check.column).agg(exact.row_count().alias("n"))
    return repeated.select(F.inline(F.array(_result(check, F.col("n")))))


def run_checks(tables: dict[str, DataFrame], checks: Iterable[Check] = DECLARED) -> DataFrame:
    """(check, table_name, column_name, violations), one row per check on a given table."""
    by_table: dict[str, list[Check]] = {}
    for check in checks:
        if check.table in tables:
            by_table.setdefault(check.table, []).append(check)
    parts = []
    for table, rules in by_table.items():
        row_rules = [rule for rule in rules if rule.kind != "unique"]
        if row_rules:
            parts.append(_row_checks(tables[table], row_rules))
        parts += [_unique_check(tables[table], rule) for rule in rules if rule.kind == "unique"]
    return reduce(DataFrame.unionByName, parts)
