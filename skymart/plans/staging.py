"""Cleaned views of the three raw tables, one output row per kept input row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skymart import schema
from skymart.functions import flights as fn

_ZERO_WHEN_MISSING = {
    "dep_delay",
    "dep_delay_minutes",
    "arr_delay",
    "arr_delay_minutes",
    *(component for _, component in schema.DELAY_CAUSES),
}


def stg_flights(raw: DataFrame) -> DataFrame:
    """Missing delay minutes read as zero, but the delayed flags stay NULL where they were.

    Everything is derived in one select, so each expression sees the raw columns.
    """
    c = F.col
    parts = {label: fn.minutes_or_zero(c(name)) for label, name in schema.DELAY_CAUSES}
    dep_hour = fn.hhmm_hour(c("crs_dep_time"))
    late = schema.DELAYED_AFTER_MINUTES
    kept = [
        fn.minutes_or_zero(c(name)).alias(name) if name in _ZERO_WHEN_MISSING else c(name)
        for name in schema.FLIGHT_RAW.fieldNames()
    ]
    derived = {
        "dep_hour": dep_hour,
        "arr_hour": fn.hhmm_hour(c("crs_arr_time")),
        "is_cancelled": c("cancelled") == 1,
        "is_diverted": c("diverted") == 1,
        "is_delayed_departure": c("dep_delay_minutes") > late,
        "is_delayed_arrival": c("arr_delay_minutes") > late,
        "total_delay_minutes": fn.total_delay(parts),
        "primary_delay_cause": fn.primary_cause(parts),
        "route": fn.route(c("origin"), c("dest")),
        "dep_time_period": fn.time_period(dep_hour),
        "day_of_week_name": fn.weekday_name(c("fl_date")),
        "is_weekend": fn.is_weekend(c("fl_date")),
    }
    return raw.select(*kept, *[column.alias(name) for name, column in derived.items()])


def stg_airlines(raw: DataFrame) -> DataFrame:
    c = F.col
    return raw.select(
        fn.blank_to_null(c("iata_code")).alias("iata_code"),
        fn.blank_to_null(c("icao_code")).alias("icao_code"),
        F.trim("airline_name").alias("carrier_name"),
        F.trim("country").alias("country"),
        F.trim("active").alias("active"),
        "ingested_at",
    ).filter(c("iata_code").isNotNull())


def stg_airports(raw: DataFrame) -> DataFrame:
    c = F.col
    code = c("iata_code")
    return raw.select(
        fn.blank_to_null(code).alias("iata_code"),
        fn.blank_to_null(c("icao_code")).alias("icao_code"),
        F.trim("airport_name").alias("airport_name"),
        F.trim("city").alias("city"),
        F.trim("country").alias("country"),
        fn.degrees(c("latitude")).alias("latitude"),
        fn.degrees(c("longitude")).alias("longitude"),
        "altitude",
        F.trim("timezone").alias("timezone"),
        F.trim("dst").alias("dst"),
        fn.us_state(c("city"), c("country")).alias("us_state"),
        "ingested_at",
    ).filter(code.isNotNull() & (code != "\\N") & (F.length(code) == 3))
