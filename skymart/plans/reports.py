"""Ready-made questions over the raw flights and the marts.

Each returns an ordered DataFrame. NULL order is always written out, and top-k reports
sort by all their output columns last, so that ties come back the same way every time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skymart import schema
from skymart.functions import exact

TOP = 10
TOP_CARRIERS = 5
MIN_ROUTE_FLIGHTS = 100
MIN_DEPARTURES = 500
#: The column each mart is read by, from high to low.
MART_ORDER = {
    "mart_carrier_performance": "reliability_score",
    "mart_airport_performance": "total_departures",
    "mart_delay_analysis": "flight_count",
    "mart_route_analysis": "total_flights",
}


def _ordered(df: DataFrame, *order: Column, limit: int | None = None) -> DataFrame:
    df = df.orderBy(*order, *[F.asc_nulls_last(name) for name in df.columns])
    return df if limit is None else df.limit(limit)


# Questions about the loaded flights


def _by_carrier_and_origin(flights: DataFrame) -> DataFrame:
    """Partial figures per airline and origin: a few thousand rows, whatever the flights."""
    arrival = F.when(F.col("arr_delay_minutes") > 0, F.col("arr_delay_minutes"))
    return flights.groupBy("reporting_airline", "origin").agg(
        exact.row_count().alias("rows"),
        F.min("fl_date").alias("first_date"),
        F.max("fl_date").alias("last_date"),
        F.count_if(F.col("cancelled") == 1).alias("cancelled"),
        F.sum(arrival).alias("late_minutes"),
        F.count(arrival).alias("late"),
    )


def _distinct(column: str) -> Column:
    """Aggregate over partial figures: the number of distinct values, without copying rows."""
    return F.size(F.collect_set(column)).cast("long")


def load_report(flights: DataFrame) -> DataFrame:
    """One row: size, date span, carriers, origins, cancellations and mean late arrival."""
    rows, cancelled = F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("cancelled"), F.lit(0))
    return _by_carrier_and_origin(flights).agg(
        rows.alias("total_rows"),
        F.min("first_date").alias("min_date"),
        F.max("last_date").alias("max_date"),
        _distinct("reporting_airline").alias("unique_airlines"),
        _distinct("origin").alias("unique_origins"),
        cancelled.alias("total_cancelled"),
        exact.mean(F.sum("late_minutes"), F.sum("late")).alias("avg_arr_delay_minutes"),
        F.coalesce(exact.percent(cancelled, rows), F.lit(0)).alias("cancellation_rate"),
    )


def in_order(mart: DataFrame, name: str) -> DataFrame:
    """A mart in its own order, with NULLs last: stored tables have none."""
    return _ordered(mart, F.desc_nulls_last(MART_ORDER[name]))


def require_loaded(flights: DataFrame) -> DataFrame:
    """The load report, or an error if there are no flights."""
    if flights.isEmpty():
        raise ValueError("no flights were loaded")
    return load_report(flights)


def date_span(flights: DataFrame) -> DataFrame:
    return flights.agg(
        exact.row_count().alias("total_rows"),
        F.min("fl_date").alias("min_date"),
        F.max("fl_date").alias("max_date"),
    )


def headline_metrics(flights: DataFrame) -> DataFrame:
    cells = flights.groupBy("reporting_airline", "origin").agg(exact.row_count().alias("rows"))
    return cells.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_flights"),
        _distinct("reporting_airline").alias("airlines"),
        _distinct("origin").alias("airports"),
    )


def sample_rows(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)


# Questions about carriers


def carrier_leaderboard(carriers: DataFrame) -> DataFrame:
    return _ordered(
        carriers.select("carrier_name", "reliability_score", "total_flights", "cancellation_rate"),
        F.desc_nulls_first("reliability_score"),
    )


def carriers_ascending(carriers: DataFrame) -> DataFrame:
    """The leaderboard from the least reliable upwards."""
    board = carrier_leaderboard(carriers)
    return _ordered(board, F.asc_nulls_last("reliability_score"))


def top_delayed_carriers(carriers: DataFrame) -> DataFrame:
    """Carriers by the unweighted mean of their monthly mean late arrivals."""
    means = carriers.groupBy("carrier_name").agg(
        exact.mean_of_means(F.col("avg_arr_delay_minutes"), 2).alias("avg_delay_min"),
        F.sum("total_flights").alias("total_flights"),
    )
    return _ordered(means, F.desc_nulls_last("avg_delay_min"), limit=TOP_CARRIERS)


# Questions about delays


def _mean_delay_by(delays: DataFrame, key: str, flights: str | None = None) -> DataFrame:
    figures = [exact.mean_of_means(F.col("avg_arr_delay_minutes"), 1).alias("avg_delay")]
    if flights:
        figures.append(F.sum("flight_count").alias(flights))
    return delays.groupBy(key).agg(*figures)


def delay_causes(delays: DataFrame) -> DataFrame:
    caused = delays.filter(F.col("primary_delay_cause") != schema.NO_CAUSE)
    return _ordered(
        caused.groupBy("primary_delay_cause").agg(F.sum("flight_count").alias("flights")),
        F.desc("flights"),
    )


def delay_cause_share(delays: DataFrame) -> DataFrame:
    """Each cause with its percentage of all flights that have a cause."""
    causes = delay_causes(delays)
    caused = delays.filter(F.col("primary_delay_cause") != schema.NO_CAUSE)
    total = caused.agg(F.sum("flight_count")).scalar()
    return causes.withColumn("share_pct", exact.percent(F.col("flights"), total))


def time_of_day(delays: DataFrame) -> DataFrame:
    return _ordered(_mean_delay_by(delays, "dep_time_period"), F.desc_nulls_first("avg_delay"))


def weekend_split(delays: DataFrame) -> DataFrame:
    return _mean_delay_by(delays, "is_weekend", "total_flights")


def distance_delay(delays: DataFrame) -> DataFrame:
    known = delays.filter(F.col("distance_bucket").isNotNull())
    return _ordered(
        _mean_delay_by(known, "distance_bucket", "total_flights"),
        F.desc_nulls_first("avg_delay"),
    )


def cause_breakdown(delays: DataFrame) -> DataFrame:
    """All causes, flights without one included."""
    figures = delays.groupBy("primary_delay_cause").agg(
        F.sum("flight_count").alias("occurrences"),
        exact.mean_of_means(F.col("avg_arr_delay_minutes"), 2).alias("avg_delay_min"),
    )
    return _ordered(figures, F.desc("occurrences"))


# Questions about routes and airports


def worst_routes(routes: DataFrame) -> DataFrame:
    busy = routes.filter(F.col("total_flights") >= MIN_ROUTE_FLIGHTS)
    return _ordered(
        busy.select("route", "carrier_name", "total_flights", "on_time_rate", "cancellation_rate"),
        F.asc_nulls_last("on_time_rate"),
        limit=TOP,
    )


def most_cancelled_routes(routes: DataFrame) -> DataFrame:
    return _ordered(
        routes.select("route", "cancellation_rate", "total_flights"),
        F.desc_nulls_first("cancellation_rate"),
        limit=TOP,
    )


def _airport_columns(airports: DataFrame) -> DataFrame:
    return airports.select("iata_code", "airport_name", "total_departures", "avg_departure_delay")


def busiest_airports(airports: DataFrame) -> DataFrame:
    return _ordered(_airport_columns(airports), F.desc("total_departures"), limit=TOP)


def delayed_airports(airports: DataFrame) -> DataFrame:
    busy = airports.filter(F.col("total_departures") >= MIN_DEPARTURES)
    return _ordered(_airport_columns(busy), F.desc_nulls_last("avg_departure_delay"), limit=TOP)


def busiest_by_rank(airports: DataFrame) -> DataFrame:
    return _ordered(
        airports.select("iata_code", "airport_name", "total_departures", "airport_rank"),
        F.asc("airport_rank"),
        limit=TOP,
    )
