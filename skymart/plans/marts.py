"""The four marts, aggregated from the enriched flights and stored without an order.

Every mart reads the flights once per group-by below and shuffles partial counts and
sums only; a busy carrier, airport or route is combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skymart import schema
from skymart.functions import exact
from skymart.functions import flights as fn
from skymart.functions.exact import row_count
from skymart.operators import aggregates

AIRPORT_KEYS = ("iata_code", "airport_name", "city", "state")
DELAY_KEYS = (
    "delay_label", "primary_delay_cause", "dep_time_period", "day_of_week_name", "is_weekend",
    "distance_bucket", "flight_month",
)
ROUTE_KEYS = (
    "route", "origin", "dest", "origin_airport_name", "dest_airport_name", "origin_city",
    "dest_city", "distance_bucket", "carrier_name",
)
MIN_ROUTE_FLIGHTS = 10


def on_time(delayed: str) -> Column:
    """Flown and known not to be late; an unknown flag counts as late."""
    return ~F.col("is_cancelled") & ~F.col(delayed)


def late_mean(minutes: str) -> Column:
    """Aggregate: mean over late flights only."""
    value = F.col(minutes)
    return exact.mean_where(value, value > schema.DELAYED_AFTER_MINUTES)


def nonzero_mean(minutes: str) -> Column:
    """Aggregate: mean over the flights that have any of these minutes."""
    value = F.col(minutes)
    return exact.mean_where(value, value != 0)


def carrier_month_facts(flights: DataFrame) -> DataFrame:
    """Counts, rates and means per carrier and month."""
    return flights.groupBy(
        "carrier_name", "reporting_airline", fn.month_start(F.col("fl_date")).alias("flight_month")
    ).agg(
        row_count().alias("total_flights"),
        F.count_if("is_cancelled").alias("total_cancelled"),
        F.count_if("is_diverted").alias("total_diverted"),
        exact.percent(F.count_if(on_time("is_delayed_departure")), row_count()).alias(
            "on_time_departure_rate"
        ),
        exact.percent(F.count_if(on_time("is_delayed_arrival")), row_count()).alias(
            "on_time_arrival_rate"
        ),
        late_mean("dep_delay_minutes").alias("avg_dep_delay_minutes"),
        late_mean("arr_delay_minutes").alias("avg_arr_delay_minutes"),
        nonzero_mean("carrier_delay").alias("avg_carrier_delay"),
        nonzero_mean("weather_delay").alias("avg_weather_delay"),
        nonzero_mean("nas_delay").alias("avg_nas_delay"),
        nonzero_mean("late_aircraft_delay").alias("avg_late_aircraft_delay"),
        exact.percent_of_sum(F.sum("carrier_delay"), F.sum("total_delay_minutes")).alias(
            "pct_carrier_caused"
        ),
    )


def mart_carrier_performance(flights: DataFrame) -> DataFrame:
    cancelled = exact.percent_unrounded(F.col("total_cancelled"), F.col("total_flights"))
    facts = carrier_month_facts(flights).withColumns(
        {
            "cancellation_rate": exact.rounded(cancelled),
            "reliability_score": exact.rounded(F.col("on_time_arrival_rate") - cancelled),
        }
    )
    return aggregates.global_rank(facts, "total_flights", "total_flights_rank")


def _airport_cells(flights: DataFrame) -> DataFrame:
    """Counts and sums per origin, destination and airline: the base of all airport figures."""
    late = schema.DELAYED_AFTER_MINUTES
    dep, arr = F.col("dep_delay_minutes"), F.col("arr_delay_minutes")
    return flights.groupBy(
        F.col("origin").alias("iata_code"),
        F.col("origin_airport_name").alias("airport_name"),
        F.col("origin_city").alias("city"),
        F.col("origin_state_name").alias("state"),
        "dest",
        "reporting_airline",
    ).agg(
        row_count().alias("flights"),
        F.count_if("is_cancelled").alias("cancelled"),
        F.sum(F.when(dep > late, dep)).alias("dep_minutes"),
        F.count_if(dep > late).alias("dep_late"),
        F.sum(F.when(arr > late, arr)).alias("arr_minutes"),
        F.count_if(arr > late).alias("arr_late"),
        F.count_if(F.col("weather_delay") > 0).alias("weather"),
        F.count_if(F.col("nas_delay") > 0).alias("nas"),
        *[
            F.count_if(F.col("day_of_week_name") == day).alias(f"on_{day}")
            for day in schema.WEEKDAYS
        ],
    )


_AIRPORT_SUMS = (
    "flights", "cancelled", "dep_minutes", "dep_late", "arr_minutes", "arr_late", "weather",
    "nas", *(f"on_{day}" for day in schema.WEEKDAYS),
)


def _departures(cells: DataFrame, hours: DataFrame) -> DataFrame:
    """One row per origin from its destination, airline and hour counts.

    The three kinds of rows are stacked and combined in one group-by, which matches NULL
    keys without null-safe joins.
    """
    by_dest = cells.groupBy(*AIRPORT_KEYS, "dest").agg(
        *[F.sum(name).alias(name) for name in _AIRPORT_SUMS]
    )
    by_airline = cells.select(*AIRPORT_KEYS, "reporting_airline").distinct()
    stacked = by_dest.unionByName(by_airline, allowMissingColumns=True).unionByName(
        hours, allowMissingColumns=True
    )
    has_origin = F.col("iata_code").isNotNull()
    total = F.sum("flights")
    return stacked.groupBy(*AIRPORT_KEYS).agg(
        total.alias("total_departures"),
        F.sum("cancelled").alias("total_cancelled_departures"),
        exact.mean(F.sum("dep_minutes"), F.sum("dep_late")).alias("avg_departure_delay"),
        exact.mean(F.sum("arr_minutes"), F.sum("arr_late")).alias("avg_arrival_delay"),
        exact.percent(F.sum("weather"), total).alias("pct_weather_delayed"),
        exact.percent(F.sum("nas"), total).alias("pct_nas_delayed"),
        aggregates.most_frequent("dep_hour", "hour_flights").alias("busiest_hour"),
        aggregates.most_frequent_of({day: F.sum(f"on_{day}") for day in schema.WEEKDAYS}).alias(
            "busiest_day_of_week"
        ),
        aggregates.most_frequent("dest", "flights").alias("top_destination"),
        F.count(F.when(has_origin, F.col("dest"))).alias("unique_routes"),
        F.count("reporting_airline").alias("unique_carriers"),
        exact.percent(F.sum("cancelled"), total).alias("departure_cancellation_rate"),
    )


def airport_facts(flights: DataFrame) -> DataFrame:
    """Departure figures per origin airport with the number of arrivals there."""
    cells = _airport_cells(flights)
    hours = flights.groupBy(
        F.col("origin").alias("iata_code"),
        F.col("origin_airport_name").alias("airport_name"),
        F.col("origin_city").alias("city"),
        F.col("origin_state_name").alias("state"),
        "dep_hour",
    ).agg(row_count().alias("hour_flights"))
    arrivals = cells.groupBy(F.col("dest").alias("iata_code")).agg(
        F.sum("flights").alias("total_arrivals")
    )
    return (
        _departures(cells, hours)
        .join(arrivals, "iata_code", "left")
        .withColumn("total_arrivals", F.coalesce("total_arrivals", F.lit(0)))
    )


def mart_airport_performance(flights: DataFrame) -> DataFrame:
    return aggregates.global_rank(airport_facts(flights), "total_departures", "airport_rank")


_COMPONENTS = ("carrier", "weather", "nas", "late_aircraft", "security")


#: Delay keys with a few fixed values: a flight carries their numbers in one whole number.
_PACKED = {
    "primary_delay_cause": (*(label for label, _ in schema.DELAY_CAUSES), schema.NO_CAUSE),
    "dep_time_period": (*(name for name, _, _ in schema.TIME_PERIODS), schema.OTHER_PERIOD),
    "day_of_week_name": schema.WEEKDAYS,
    "is_weekend": (False, True),
    "distance_bucket": (*(name for name, _ in schema.HAULS), schema.LONGEST_HAUL),
}


def _packed() -> Column:
    """One number for the labels of a flight: their places from 1, 0 for NULL."""
    number = F.lit(0)
    for name, labels in _PACKED.items():
        place = F.coalesce(F.array_position(F.array(*map(F.lit, labels)), F.col(name)), F.lit(0))
        number = number * (len(labels) + 1) + place.cast("int")
    return number.cast("int")


def _unpacked(number: Column) -> dict[str, Column]:
    found = {}
    for name, labels in reversed(_PACKED.items()):
        place = (number % (len(labels) + 1)).cast("int")
        found[name] = F.get(F.array(*map(F.lit, labels)), place - 1)
        number = F.floor(number / (len(labels) + 1))
    return found


def delay_facts(flights: DataFrame) -> DataFrame:
    """Counts, means and most frequent carrier and route per delay segment.

    Measures are summed per segment and carrier, routes counted per segment and route;
    the two partial results are stacked and combined in one group-by per segment. The labels of a
    segment travel as one number.
    """
    keys = ("delay_label", "flight_month", "_labels")
    months = flights.withColumns(
        {"flight_month": fn.month_start(F.col("fl_date")), "_labels": _packed()}
    )
    sums = {"flights": row_count(), "arr_minutes": F.sum("arr_delay_minutes")}
    for part in _COMPONENTS:
        minutes = F.col(f"{part}_delay")
        sums[f"{part}_minutes"] = F.sum(minutes)
        sums[f"{part}_flights"] = F.count_if(minutes != 0)
    by_carrier = months.groupBy(*keys, "carrier_name").agg(
        *[column.alias(name) for name, column in sums.items()]
    )
    by_route = months.groupBy(*keys, "route").agg(row_count().alias("route_flights"))
    total = F.sum("flights")
    facts = (
        by_carrier.unionByName(by_route, allowMissingColumns=True)
        .groupBy(*keys)
        .agg(
            total.alias("flight_count"),
            exact.mean(F.sum("arr_minutes"), total).alias("avg_arr_delay_minutes"),
            *[
                exact.mean(F.sum(f"{part}_minutes"), F.sum(f"{part}_flights")).alias(
                    f"avg_{part}_delay"
                )
                for part in _COMPONENTS
            ],
            aggregates.most_frequent("carrier_name", "flights").alias("worst_carrier"),
            aggregates.most_frequent("route", "route_flights").alias("worst_route"),
        )
    )
    labels = _unpacked(F.col("_labels"))
    own = [labels[k].alias(k) if k in labels else F.col(k) for k in DELAY_KEYS]
    return facts.select(*own, *facts.columns[len(keys) :])


def mart_delay_analysis(flights: DataFrame) -> DataFrame:
    facts = delay_facts(flights)
    return aggregates.share_of_total(facts, "flight_count", flights, "pct_of_total", 4)


def route_facts(flights: DataFrame) -> DataFrame:
    """Rates, means and most frequent cause and period per route and carrier.

    Cause and period have a handful of fixed labels, so their modes are plain counters in
    the same hash aggregate. Small groups are dropped after the aggregate.
    """
    causes = [label for label, _ in schema.DELAY_CAUSES] + [schema.NO_CAUSE]
    periods = [name for name, _, _ in schema.TIME_PERIODS] + [schema.OTHER_PERIOD]

    def mode(column: str, labels: list[str]) -> Column:
        return aggregates.most_frequent_of(
            {label: F.count_if(F.col(column) == label) for label in labels}
        )

    arrival = F.col("arr_delay_minutes")
    return (
        flights.groupBy(*ROUTE_KEYS)
        .agg(
            row_count().alias("total_flights"),
            exact.percent(F.count_if(on_time("is_delayed_arrival")), row_count()).alias(
                "on_time_rate"
            ),
            exact.percent(F.count_if("is_cancelled"), row_count()).alias("cancellation_rate"),
            exact.mean_where(arrival, arrival > 0).alias("avg_arr_delay_minutes"),
            exact.mean(F.sum("distance"), F.count("distance")).alias("avg_distance"),
            mode("primary_delay_cause", causes).alias("most_common_delay_cause"),
            mode("dep_time_period", periods).alias("most_common_delay_period"),
        )
        .filter(F.col("total_flights") >= MIN_ROUTE_FLIGHTS)
    )


def mart_route_analysis(flights: DataFrame) -> DataFrame:
    return aggregates.global_rank(route_facts(flights), "on_time_rate", "route_reliability_rank")
