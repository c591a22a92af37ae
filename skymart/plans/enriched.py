"""The enriched flight table: one pass over the flights, no shuffle of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skymart.functions import flights as fn
from skymart.operators import lookups

COLUMNS = (
    "flight_id", "fl_date", "reporting_airline", "tail_number", "flight_number", "route",
    "carrier_name",
    "origin", "origin_airport_name", "origin_city", "origin_state_name", "origin_lat",
    "origin_lon",
    "dest", "dest_airport_name", "dest_city", "dest_state_name", "dest_lat", "dest_lon",
    "crs_dep_time", "dep_time", "dep_hour", "dep_time_period",
    "crs_arr_time", "arr_time", "arr_hour", "day_of_week_name", "is_weekend",
    "dep_delay", "dep_delay_minutes", "arr_delay", "arr_delay_minutes",
    "carrier_delay", "weather_delay", "nas_delay", "security_delay", "late_aircraft_delay",
    "total_delay_minutes", "primary_delay_cause", "delay_label",
    "is_cancelled", "is_diverted", "is_delayed_departure", "is_delayed_arrival",
    "cancellation_code", "cancellation_reason",
    "distance", "air_time", "actual_elapsed_time", "crs_elapsed_time", "taxi_out", "taxi_in",
    "distance_bucket", "is_same_state_flight",
    "ingested_at", "source_file",
)


def with_carrier(flights: DataFrame, airlines: DataFrame) -> DataFrame:
    small = lookups.within(airlines, lookups.BROADCAST_ROWS)
    carrier = airlines.select(F.col("iata_code").alias("_carrier"), "carrier_name")
    return lookups.equi_lookup(flights, carrier, "reporting_airline", "_carrier", small)


def with_airports(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """The same airport table in two roles; Spark broadcasts it once and reuses it."""
    small = lookups.within(airports, lookups.BROADCAST_ROWS)
    for role in ("origin", "dest"):
        side = airports.select(
            F.col("iata_code").alias(f"_{role}"),
            F.col("airport_name").alias(f"{role}_airport_name"),
            F.col("city").alias(f"{role}_city"),
            F.col("us_state").alias(f"{role}_state_name"),
            F.col("latitude").alias(f"{role}_lat"),
            F.col("longitude").alias(f"{role}_lon"),
        )
        flights = lookups.equi_lookup(flights, side, role, f"_{role}", small)
    return flights


def with_cancellation_reason(flights: DataFrame, codes: DataFrame) -> DataFrame:
    small = lookups.within(codes, lookups.BROADCAST_ROWS)
    reason = codes.select("code", F.col("reason").alias("cancellation_reason"))
    return lookups.equi_lookup(flights, reason, "cancellation_code", "code", small)


def with_delay_label(flights: DataFrame, categories: DataFrame) -> DataFrame:
    ranges = categories.select(F.col("label").alias("delay_label"), "min_minutes", "max_minutes")
    return lookups.range_lookup(
        flights, ranges, "arr_delay_minutes", "min_minutes", "max_minutes"
    )


def int_flights_enriched(
    flights: DataFrame,
    airlines: DataFrame,
    airports: DataFrame,
    cancellation_codes: DataFrame,
    delay_categories: DataFrame,
) -> DataFrame:
    """Cleaned flights with carrier, both airports, cancellation reason and delay label."""
    flights = with_carrier(flights, airlines)
    flights = with_airports(flights, airports)
    flights = with_cancellation_reason(flights, cancellation_codes)
    flights = with_delay_label(flights, delay_categories)
    return flights.withColumns(
        {
            "distance_bucket": fn.distance_bucket(F.col("distance")),
            "is_same_state_flight": fn.same_state(
                F.col("origin_state_name"), F.col("dest_state_name")
            ),
        }
    ).select(*COLUMNS)
