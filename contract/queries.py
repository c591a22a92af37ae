"""The registered queries: every one runs on whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from contract import fixture
from skymart import schema
from skymart.functions import exact
from skymart.functions import flights as fn
from skymart.operators import aggregates, checks, lookups
from skymart.plans import enriched, marts, pipeline, reports, staging
from skymart.sources import archives, lookup_files
from skymart.sources import flight_files as readers
from skymart.sources.warehouse import Warehouse


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, which is how results are handed over."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


class Inputs:
    """The tables of one scale folder, each built when a query asks for it."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def raw(self) -> DataFrame:
        return fixture.flight_raw(self.spark, self.sf_dir)

    @cached_property
    def unnumbered(self) -> DataFrame:
        return fixture.stored_flights(self.spark, self.sf_dir)

    @cached_property
    def flights(self) -> DataFrame:
        return staging.stg_flights(self.raw)

    @cached_property
    def airlines(self) -> DataFrame:
        return staging.stg_airlines(fixture.airline_raw(self.spark, self.sf_dir))

    @cached_property
    def airports(self) -> DataFrame:
        return staging.stg_airports(fixture.airport_raw(self.spark, self.sf_dir))

    @cached_property
    def codes(self) -> DataFrame:
        return schema.cancellation_codes(self.spark)

    @cached_property
    def categories(self) -> DataFrame:
        return schema.delay_categories(self.spark)

    @cached_property
    def enriched(self) -> DataFrame:
        return enriched.int_flights_enriched(
            self.flights, self.airlines, self.airports, self.codes, self.categories
        )

    @cached_property
    def carriers(self) -> DataFrame:
        return marts.mart_carrier_performance(self.enriched)

    @cached_property
    def airport_mart(self) -> DataFrame:
        return marts.mart_airport_performance(self.enriched)

    @cached_property
    def delays(self) -> DataFrame:
        return marts.mart_delay_analysis(self.enriched)

    @cached_property
    def routes(self) -> DataFrame:
        return marts.mart_route_analysis(self.enriched)

    def table(self, name: str) -> DataFrame:
        return getattr(self, _ATTRIBUTES[name])


_ATTRIBUTES = {
    "stg_flights": "flights",
    "stg_airlines": "airlines",
    "stg_airports": "airports",
    "int_flights_enriched": "enriched",
    "mart_carrier_performance": "carriers",
    "mart_airport_performance": "airport_mart",
    "mart_delay_analysis": "delays",
    "mart_route_analysis": "routes",
}

_c = F.col


def _per_flight(*columns: str) -> Callable[[Inputs], DataFrame]:
    return lambda t: t.flights.select("flight_id", *columns)


def _per_enriched(*columns: str) -> Callable[[Inputs], DataFrame]:
    return lambda t: t.enriched.select("flight_id", *columns)


def _by(key: str, **figures: Callable[[], Column]) -> Callable[[Inputs], DataFrame]:
    return lambda t: t.enriched.groupBy(key).agg(*[f().alias(n) for n, f in figures.items()])


def _on_time_rates(t: Inputs) -> DataFrame:
    rows = exact.row_count()
    return t.enriched.groupBy("reporting_airline").agg(
        exact.percent(F.count_if(marts.on_time("is_delayed_departure")), rows).alias("departure"),
        exact.percent(F.count_if(marts.on_time("is_delayed_arrival")), rows).alias("arrival"),
        exact.percent(F.count_if("is_cancelled"), rows).alias("cancelled"),
        F.count_if("is_diverted").alias("diverted"),
    )


def _filtered_means(t: Inputs) -> DataFrame:
    arrival = _c("arr_delay_minutes")
    return t.enriched.groupBy("reporting_airline").agg(
        marts.late_mean("dep_delay_minutes").alias("late_departure"),
        marts.late_mean("arr_delay_minutes").alias("late_arrival"),
        exact.mean_where(arrival, arrival > 0).alias("any_arrival"),
        exact.mean(F.sum(arrival), exact.row_count()).alias("all_arrival"),
    )


def _nonzero_means(t: Inputs) -> DataFrame:
    return t.enriched.groupBy("reporting_airline").agg(
        *[marts.nonzero_mean(column).alias(column) for _, column in schema.DELAY_CAUSES]
    )


def _weather_nas_share(t: Inputs) -> DataFrame:
    rows = exact.row_count()
    return t.enriched.groupBy("origin").agg(
        exact.percent(F.count_if(_c("weather_delay") > 0), rows).alias("weather"),
        exact.percent(F.count_if(_c("nas_delay") > 0), rows).alias("nas"),
    )


def _group_modes(t: Inputs) -> DataFrame:
    counts = t.enriched.groupBy("origin", "dest").agg(exact.row_count().alias("n"))
    return counts.groupBy("origin").agg(
        aggregates.most_frequent("dest", "n").alias("top_destination")
    )


def _distinct_counts(t: Inputs) -> DataFrame:
    cells = t.enriched.groupBy("origin", "route", "reporting_airline").agg(exact.row_count())
    return cells.groupBy("origin").agg(
        F.size(F.collect_set("route")).cast("long").alias("routes"),
        F.size(F.collect_set("reporting_airline")).cast("long").alias("carriers"),
    )


def _rank_carriers(t: Inputs) -> DataFrame:
    keys = ("carrier_name", "reporting_airline", "flight_month")
    return t.carriers.select(*keys, "total_flights", "total_flights_rank")


def _rank_airports(t: Inputs) -> DataFrame:
    return t.airport_mart.select("iata_code", "total_departures", "airport_rank")


def _rank_routes(t: Inputs) -> DataFrame:
    return t.routes.select("route", "carrier_name", "on_time_rate", "route_reliability_rank")


def _share_of_total(t: Inputs) -> DataFrame:
    counts = t.enriched.groupBy("route").agg(exact.row_count().alias("flights"))
    return aggregates.share_of_total(counts, "flights", t.enriched, "pct_of_total", 4)


def _departures_arrivals(t: Inputs) -> DataFrame:
    return marts.airport_facts(t.enriched).select(
        "iata_code", "total_departures", "total_arrivals"
    )


def _check(kind: str) -> Callable[[Inputs], DataFrame]:
    rules = [rule for rule in checks.DECLARED if rule.kind == kind]
    names = dict.fromkeys(rule.table for rule in rules)

    def checked(t: Inputs) -> DataFrame:
        t.raw = fixture.flight_raw(t.spark, t.sf_dir, once=True)
        return checks.run_checks({name: t.table(name) for name in names}, rules)

    return checked


def _loaded_flights(t: Inputs) -> DataFrame:
    """The flights after a round trip through CSV files of several layouts."""
    loaded = readers.read_flights(t.spark, fixture.flight_files(t.spark, t.sf_dir))
    return loaded.drop("ingested_at", "source_file")


def _load_metadata(t: Inputs) -> DataFrame:
    loaded = readers.read_flights(t.spark, fixture.flight_files(t.spark, t.sf_dir))
    return loaded.agg(
        exact.row_count().alias("flights"),
        F.count("ingested_at").alias("stamped"),
        F.count_if(_c("source_file").rlike("^part-.*[.]csv$")).alias("named"),
    )


def _loaded_archives(t: Inputs) -> DataFrame:
    folder = fixture.zipped_flight_files(t.spark, t.sf_dir)
    return archives.read_zipped_csv(t.spark, [folder]).drop("ingested_at", "source_file")


def _profiled_flights(t: Inputs) -> DataFrame:
    """What the profile finds in files with planted values, over all files of a column."""
    found = readers.profiled(t.spark, fixture.flight_files(t.spark, t.sf_dir, planted=True))
    figures = [F.sum(c).alias(c) for c in ("rows", "missing", "unparsable", "too_long")]
    lacking = F.coalesce(F.sum(F.when(~_c("present"), _c("rows"))), F.lit(0))
    return found.groupBy("column_name").agg(
        *figures, lacking.alias("lacking_rows"), (F.min("bytes") > 0).alias("sized")
    )


def _three_loads(t: Inputs) -> Warehouse:
    """A warehouse after three loads by month, and a fourth that was staged but never published."""
    warehouse, flights = fixture.warehouse(t.spark), t.unnumbered
    for third in range(3):
        pipeline.store_flights(warehouse, flights.filter(F.month("fl_date") % 3 == third))
    pipeline.stage_flights(warehouse, flights.filter(F.month("fl_date") == 1))
    return warehouse


def _surrogate_keys(t: Inputs) -> DataFrame:
    key = _c("flight_id")
    return _three_loads(t).read("staging", "flight_raw").agg(
        exact.row_count().alias("flights"),
        F.min(key).alias("first_id"),
        F.max(key).alias("last_id"),
        F.count_distinct(key).alias("ids"),
    )


def _load_manifest(t: Inputs) -> DataFrame:
    return _three_loads(t).loads("staging", "flight_raw").drop("load", "path", "bytes")


def _reloaded_flights(t: Inputs) -> DataFrame:
    """flight_raw after its first files were loaded twice, and a mart refreshed on it."""
    warehouse = _three_loads(t)
    again = t.unnumbered.filter(F.month("fl_date") % 3 == 0)
    pipeline.store_flights(warehouse, again)
    january = pipeline.flights_between(warehouse, date(1995, 1, 1), date(1995, 1, 31))
    flights = warehouse.read("staging", "flight_raw").groupBy("source_file")
    counts = flights.agg(exact.row_count().alias("flights"))
    found = january.groupBy("source_file").agg(exact.row_count().alias("found_by_date"))
    return counts.join(found, "source_file", "left")


def _many_ranges(t: Inputs) -> DataFrame:
    """Customers in overlapping ranges with gaps, fractions and open ends, one for each supplier."""
    read = lambda name: t.spark.read.parquet(f"{t.sf_dir}/{name}.parquet")
    values = read("customer").select("c_custkey", _c("c_acctbal").cast("double").alias("balance"))
    low, key = _c("s_acctbal").cast("double"), _c("s_suppkey")
    ranges = read("supplier").select(
        key.alias("s_suppkey"),
        F.when(key % 17 != 0, low).alias("low"),
        F.when(key % 19 != 0, low + (key % 13) * 7.25).alias("high"),
    )
    return lookups.range_lookup(values, ranges, "balance", "low", "high")


def _open_routes(t: Inputs) -> DataFrame:
    """Routes of flights of which some lack an end."""
    key = _c("flight_id")
    ends = t.raw.select(
        key,
        F.when(key % 50 != 0, _c("origin")).alias("origin"),
        F.when(key % 70 != 0, _c("dest")).alias("dest"),
    )
    return ends.withColumn("route", fn.route(_c("origin"), _c("dest")))


def _loaded_airports(t: Inputs) -> DataFrame:
    raw = fixture.airport_raw(t.spark, t.sf_dir)
    folder = fixture.lookup_file(t.spark, raw, schema.AIRPORT_FILE_COLUMNS)
    return lookup_files.read_airports(t.spark, [folder]).drop("ingested_at")


def _loaded_airlines(t: Inputs) -> DataFrame:
    raw = fixture.airline_raw(t.spark, t.sf_dir)
    folder = fixture.lookup_file(t.spark, raw, schema.AIRLINE_FILE_COLUMNS)
    return lookup_files.read_airlines(t.spark, [folder]).drop("ingested_at")


_QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    # files
    "load_flights": _loaded_flights,
    "load_zipped_flights": _loaded_archives,
    "load_metadata": _load_metadata,
    "profile_flights": _profiled_flights,
    "surrogate_keys": _surrogate_keys,
    "load_manifest": _load_manifest,
    "reloaded_flights": _reloaded_flights,
    "load_airports": _loaded_airports,
    "load_airlines": _loaded_airlines,
    # cleaned views and single derived columns
    "stg_flights": lambda t: t.flights,
    "stg_airlines": lambda t: t.airlines.drop("ingested_at"),
    "stg_airports": lambda t: t.airports.drop("ingested_at"),
    "dep_hour_bucket": _per_flight("crs_dep_time", "dep_hour", "arr_hour", "dep_time_period"),
    "weekday_weekend": _per_flight("fl_date", "day_of_week_name", "is_weekend"),
    "primary_delay_cause": _per_flight("total_delay_minutes", "primary_delay_cause"),
    "delay_flags_nullable": _per_flight(
        "arr_delay_minutes", "is_cancelled", "is_diverted", "is_delayed_departure",
        "is_delayed_arrival",
    ),
    "route_concat": _per_flight("origin", "dest", "route"),
    "route_missing_end": _open_routes,
    "us_state_from_city": lambda t: t.airports.select("iata_code", "city", "country", "us_state"),
    "rounded_coordinates": lambda t: t.airports.select("iata_code", "latitude", "longitude"),
    "distance_bucket": _per_enriched("distance", "distance_bucket"),
    "same_state_flag": _per_enriched(
        "origin_state_name", "dest_state_name", "is_same_state_flight"
    ),
    "month_truncation": lambda t: t.flights.select(
        "flight_id", fn.month_start(_c("fl_date")).alias("flight_month")
    ),
    # joins
    "join_airline": lambda t: enriched.with_carrier(t.flights, t.airlines).select(
        "flight_id", "reporting_airline", "carrier_name"
    ),
    "join_airports_two_roles": lambda t: enriched.with_airports(t.flights, t.airports).select(
        "flight_id", "origin", "origin_airport_name", "origin_city", "origin_state_name",
        "dest", "dest_airport_name", "dest_city", "dest_state_name",
    ),
    "join_cancellation": lambda t: enriched.with_cancellation_reason(t.flights, t.codes).select(
        "flight_id", "cancellation_code", "cancellation_reason"
    ),
    "join_delay_range": lambda t: enriched.with_delay_label(t.flights, t.categories).select(
        "flight_id", "arr_delay_minutes", "delay_label"
    ),
    "join_many_ranges": _many_ranges,
    "int_flights_enriched": lambda t: t.enriched,
    "departures_arrivals": _departures_arrivals,
    # marts
    "mart_carrier_performance": lambda t: t.carriers,
    "mart_airport_performance": lambda t: t.airport_mart,
    "mart_delay_analysis": lambda t: t.delays,
    "mart_route_analysis": lambda t: t.routes,
    # aggregates and windows
    "on_time_rates": _on_time_rates,
    "filtered_means": _filtered_means,
    "nonzero_component_means": _nonzero_means,
    "carrier_delay_share": _by(
        "reporting_airline",
        pct_carrier_caused=lambda: exact.percent_of_sum(
            F.sum("carrier_delay"), F.sum("total_delay_minutes")
        ),
    ),
    "weather_nas_share": _weather_nas_share,
    "group_modes": _group_modes,
    "distinct_counts": _distinct_counts,
    "rank_carrier_months": _rank_carriers,
    "rank_airports": _rank_airports,
    "rank_routes": _rank_routes,
    "share_of_total": _share_of_total,
    # reports
    "load_report": lambda t: reports.load_report(t.raw),
    "date_span": lambda t: reports.date_span(t.raw),
    "headline_metrics": lambda t: reports.headline_metrics(t.raw),
    "carrier_leaderboard": lambda t: reports.carrier_leaderboard(t.carriers),
    "carriers_ascending": lambda t: reports.carriers_ascending(t.carriers),
    "delay_causes": lambda t: reports.delay_causes(t.delays),
    "delay_cause_share": lambda t: reports.delay_cause_share(t.delays),
    "time_of_day": lambda t: reports.time_of_day(t.delays),
    "worst_routes": lambda t: reports.worst_routes(t.routes),
    "weekend_split": lambda t: reports.weekend_split(t.delays),
    "busiest_airports": lambda t: reports.busiest_airports(t.airport_mart),
    "delayed_airports": lambda t: reports.delayed_airports(t.airport_mart),
    "distance_delay": lambda t: reports.distance_delay(t.delays),
    "top_delayed_carriers": lambda t: reports.top_delayed_carriers(t.carriers),
    "most_cancelled_routes": lambda t: reports.most_cancelled_routes(t.routes),
    "cause_breakdown": lambda t: reports.cause_breakdown(t.delays),
    "busiest_by_rank": lambda t: reports.busiest_by_rank(t.airport_mart),
    # data checks
    "check_unique": _check("unique"),
    "check_not_null": _check("not_null"),
    "check_accepted_values": _check("accepted_values"),
    "check_accepted_range": _check("accepted_range"),
    "check_range_exclusive": _check("range_exclusive"),
    "check_valid_delays": _check("valid_delays"),
    "check_positive_distance": _check("positive_distance"),
}


#: Reports whose order is the point: each comes back with its rows' places.
ORDERED = (
    "carrier_leaderboard", "carriers_ascending", "delay_causes", "time_of_day", "worst_routes",
    "busiest_airports", "delayed_airports", "distance_delay", "top_delayed_carriers",
    "most_cancelled_routes", "cause_breakdown", "busiest_by_rank",
)


def _placed(report: DataFrame) -> DataFrame:
    """The rows of an ordered report, a few hundred at most, with their places from 1."""
    marked = report.withColumn("_at", F.monotonically_increasing_id())
    return marked.select(*report.columns, F.row_number().over(Window.orderBy("_at")).alias("place"))


def _in_order(name: str) -> Callable[[Inputs], DataFrame]:
    return lambda t: _placed(_QUERIES[name](t))


def _mart_in_order(name: str) -> Callable[[Inputs], DataFrame]:
    """The places of a mart's rows in its own order, by what identifies them."""
    return lambda t: _placed(reports.in_order(t.table(name), name))


_QUERIES |= {f"order_{name}": _in_order(name) for name in ORDERED}
_QUERIES |= {
    f"order_{name}": _mart_in_order(name)
    for name in ("mart_carrier_performance", "mart_airport_performance", "mart_route_analysis")
}


def _registered(build: Callable[[Inputs], DataFrame]):
    return lambda spark, sf_dir: plain(build(Inputs(spark, sf_dir)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _registered(build) for name, build in _QUERIES.items()}
