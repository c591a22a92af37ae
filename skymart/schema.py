"""Table contracts: raw tables, the two seed tables and the derived labels."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """One column of a raw table; ``header`` is its name in the source file."""

    name: str
    type: str
    header: str | None = None
    max_length: int | None = None


# The flight file's headers, the column names and types they load into.
FLIGHT_FIELDS = (
    Field("fl_date", "date", "FlightDate"),
    Field("reporting_airline", "string", "Reporting_Airline", 10),
    Field("tail_number", "string", "Tail_Number", 20),
    Field("flight_number", "string", "Flight_Number_Reporting_Airline", 10),
    Field("origin_airport_id", "int", "OriginAirportID"),
    Field("origin", "string", "Origin", 10),
    Field("origin_city_name", "string", "OriginCityName", 100),
    Field("origin_state", "string", "OriginStateName", 100),
    Field("dest_airport_id", "int", "DestAirportID"),
    Field("dest", "string", "Dest", 10),
    Field("dest_city_name", "string", "DestCityName", 100),
    Field("dest_state", "string", "DestStateName", 100),
    Field("crs_dep_time", "int", "CRSDepTime"),
    Field("dep_time", "double", "DepTime"),
    Field("dep_delay", "double", "DepDelay"),
    Field("dep_delay_minutes", "double", "DepDelayMinutes"),
    Field("taxi_out", "double", "TaxiOut"),
    Field("wheels_off", "double", "WheelsOff"),
    Field("wheels_on", "double", "WheelsOn"),
    Field("taxi_in", "double", "TaxiIn"),
    Field("crs_arr_time", "int", "CRSArrTime"),
    Field("arr_time", "double", "ArrTime"),
    Field("arr_delay", "double", "ArrDelay"),
    Field("arr_delay_minutes", "double", "ArrDelayMinutes"),
    Field("cancelled", "double", "Cancelled"),
    Field("cancellation_code", "string", "CancellationCode", 5),
    Field("diverted", "double", "Diverted"),
    Field("crs_elapsed_time", "double", "CRSElapsedTime"),
    Field("actual_elapsed_time", "double", "ActualElapsedTime"),
    Field("air_time", "double", "AirTime"),
    Field("distance", "double", "Distance"),
    Field("carrier_delay", "double", "CarrierDelay"),
    Field("weather_delay", "double", "WeatherDelay"),
    Field("nas_delay", "double", "NASDelay"),
    Field("security_delay", "double", "SecurityDelay"),
    Field("late_aircraft_delay", "double", "LateAircraftDelay"),
)

# Positions of the headerless lookup files.
AIRPORT_FILE_COLUMNS = (
    "openflights_id", "airport_name", "city", "country", "iata_code", "icao_code",
    "latitude", "longitude", "altitude", "utc_offset", "dst", "timezone", "type", "source",
)
AIRLINE_FILE_COLUMNS = (
    "openflights_id", "airline_name", "alias", "iata_code", "icao_code", "callsign",
    "country", "active",
)

AIRPORT_FIELDS = (
    Field("iata_code", "string", max_length=10),
    Field("icao_code", "string", max_length=10),
    Field("airport_name", "string", max_length=200),
    Field("city", "string", max_length=100),
    Field("country", "string", max_length=100),
    Field("latitude", "double"),
    Field("longitude", "double"),
    Field("altitude", "double"),
    Field("timezone", "string", max_length=100),
    Field("dst", "string", max_length=5),
)
AIRLINE_FIELDS = (
    Field("iata_code", "string", max_length=10),
    Field("icao_code", "string", max_length=10),
    Field("airline_name", "string", max_length=200),
    Field("country", "string", max_length=100),
    Field("active", "string", max_length=5),
)


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
}


def _table(key: str, fields: tuple[Field, ...]) -> T.StructType:
    table = T.StructType([T.StructField(key, T.LongType(), False)])
    for field in fields:
        table = table.add(field.name, _TYPES[field.type])
    return table.add("ingested_at", T.TimestampNTZType())


FLIGHT_RAW = _table("flight_id", FLIGHT_FIELDS).add("source_file", T.StringType())
AIRPORT_RAW = _table("airport_id", AIRPORT_FIELDS)
AIRLINE_RAW = _table("airline_id", AIRLINE_FIELDS)

# Namespaces of the four layers.
LAYERS = ("staging", "intermediate", "marts", "seeds")

# Seed contents are configurable; these are the defaults. Bounds are inclusive.
CANCELLATION_CODES = (
    ("A", "Carrier"),
    ("B", "Weather"),
    ("C", "National Air System"),
    ("D", "Security"),
)
DELAY_CATEGORIES = (
    ("On Time", -9999, 15),
    ("Minor Delay", 16, 30),
    ("Moderate Delay", 31, 60),
    ("Significant Delay", 61, 120),
    ("Severe Delay", 121, 99999),
)

# Labels of the derived columns.
DELAY_CAUSES = (  # label, component column; ties go to the earlier one
    ("Carrier", "carrier_delay"),
    ("Weather", "weather_delay"),
    ("NAS", "nas_delay"),
    ("Security", "security_delay"),
    ("Late Aircraft", "late_aircraft_delay"),
)
NO_CAUSE = "None"
TIME_PERIODS = (("Morning", 5, 11), ("Afternoon", 12, 16), ("Evening", 17, 20))
OTHER_PERIOD = "Night"
WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
HAULS = (("Short Haul", 500), ("Medium Haul", 1500))
LONGEST_HAUL = "Long Haul"
DELAYED_AFTER_MINUTES = 15


CANCELLATION_CODE_TABLE = T.StructType().add("code", "string").add("reason", "string")
DELAY_CATEGORY_TABLE = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("min_minutes", T.IntegerType()),
        T.StructField("max_minutes", T.IntegerType()),
    ]
)


def _seed(spark: SparkSession, rows, table: T.StructType) -> DataFrame:
    """Seed rows as a local relation, whose size Spark knows."""
    columns = dict(zip(table.fieldNames(), zip(*rows)))
    return spark.createDataFrame(pa.table({k: list(v) for k, v in columns.items()}), table)


def cancellation_codes(spark: SparkSession, rows=CANCELLATION_CODES) -> DataFrame:
    return _seed(spark, rows, CANCELLATION_CODE_TABLE)


def delay_categories(spark: SparkSession, rows=DELAY_CATEGORIES) -> DataFrame:
    return _seed(spark, rows, DELAY_CATEGORY_TABLE)
