"""From raw files to stored tables: load, build all models, check."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skymart import schema
from skymart.operators import checks
from skymart.plans import enriched, marts, reports, staging
from skymart.sources import archives, flight_files, lookup_files
from skymart.sources.warehouse import FILE_KEY, LOAD, MONTH, Warehouse, month_of

MARTS = {
    "mart_carrier_performance": marts.mart_carrier_performance,
    "mart_airport_performance": marts.mart_airport_performance,
    "mart_delay_analysis": marts.mart_delay_analysis,
    "mart_route_analysis": marts.mart_route_analysis,
}
SEEDS = {
    "cancellation_codes": schema.cancellation_codes,
    "delay_categories": schema.delay_categories,
}


def stage_flights(warehouse: Warehouse, flights: DataFrame, files: list[dict] | None = None):
    """Write typed flights aside for flight_raw, with dense numbers; publish() makes them show.

    Loads may be staged and published side by side; one that ends before it is published leaves
    nothing but files that ``clean`` deletes. Flights without a file_key are told apart by their source_file.
    """
    if FILE_KEY not in flights.columns:
        flights = flights.withColumn(FILE_KEY, flight_files.file_key(F.col("source_file")))
    flights = flights.withColumn(MONTH, month_of(F.col("fl_date")))
    by = (FILE_KEY, "source_file", MONTH)
    return warehouse.stage(flights, "staging", "flight_raw", *by, number="flight_id", files=files or [])


def store_flights(
    warehouse: Warehouse, flights: DataFrame, files: list[dict] | None = None
) -> DataFrame:
    """Add typed flights to flight_raw; returns the rows stored per source file.

    A file that was loaded before, from the same path, is replaced, so that a repeated load changes
    nothing but ids; files of one name in different folders are kept apart by their file_key.
    flight_id goes on without a gap from the last load published before.
    """
    load = stage_flights(warehouse, flights, files)
    load.publish()
    new = warehouse.read("staging", "flight_raw", F.col(LOAD) == load.folder_name)
    return new.groupBy("source_file").agg(F.count(F.lit(1)).alias("total_rows"))


def load_flights(warehouse: Warehouse, paths: list[str]) -> DataFrame:
    files = flight_files.listed(warehouse.spark, paths)
    text = flight_files.read_text_columns(warehouse.spark, paths)
    return store_flights(warehouse, flight_files.keyed(text), files)


def load_zipped_flights(warehouse: Warehouse, paths: list[str]) -> DataFrame:
    files = flight_files.listed(warehouse.spark, paths)
    text = archives.read_zipped_text_columns(warehouse.spark, paths)
    return store_flights(warehouse, flight_files.keyed(text), files)


def flights_between(warehouse: Warehouse, first: date, last: date) -> DataFrame:
    """Stored flights from ``first`` to ``last``: only the files of those months are listed and read."""
    months = F.col(MONTH).between(first.year * 100 + first.month, last.year * 100 + last.month)
    days = F.col("fl_date").between(F.lit(first), F.lit(last))
    return warehouse.read("staging", "flight_raw", months & days)


def _store_lookup(warehouse: Warehouse, rows: DataFrame, name: str, key: str) -> DataFrame:
    rows = warehouse.numbered(rows, "staging", name, key)
    table = warehouse.replace(rows, "staging", name)
    return table.agg(F.count(F.lit(1)).alias("rows_loaded"))


def load_airports(warehouse: Warehouse, paths: list[str]) -> DataFrame:
    rows = lookup_files.read_airports(warehouse.spark, paths)
    return _store_lookup(warehouse, rows, "airport_raw", "airport_id")


def load_airlines(warehouse: Warehouse, paths: list[str]) -> DataFrame:
    rows = lookup_files.read_airlines(warehouse.spark, paths)
    return _store_lookup(warehouse, rows, "airline_raw", "airline_id")


def load_seeds(warehouse: Warehouse, **tables: DataFrame) -> None:
    """Store the seeds, the default ones unless given by name."""
    for name, default in SEEDS.items():
        warehouse.replace(tables.get(name, default(warehouse.spark)), "seeds", name)


def staging_views(
    warehouse: Warehouse, source_files: list[str] | None = None
) -> dict[str, DataFrame]:
    """The cleaned tables, also registered as temporary views of their names.

    With ``source_files`` the flights are those of these files alone.
    """
    own = None if source_files is None else F.col("source_file").isin(source_files)
    views = {
        "stg_flights": staging.stg_flights(warehouse.read("staging", "flight_raw", own)),
        "stg_airlines": staging.stg_airlines(warehouse.read("staging", "airline_raw")),
        "stg_airports": staging.stg_airports(warehouse.read("staging", "airport_raw")),
    }
    if source_files is None:
        for name, view in views.items():
            view.createOrReplaceTempView(name)
    return views


def enriched_flights(
    warehouse: Warehouse, source_files: list[str] | None = None
) -> DataFrame:
    """The stored flights, or those of the given files, enriched."""
    views = staging_views(warehouse, source_files)
    return enriched.int_flights_enriched(
        views["stg_flights"],
        views["stg_airlines"],
        views["stg_airports"],
        warehouse.read("seeds", "cancellation_codes"),
        warehouse.read("seeds", "delay_categories"),
    )


def build_enriched(warehouse: Warehouse, source_files: list[str] | None = None) -> DataFrame:
    """Enrich all stored flights, or only those of the given files.

    Raw and enriched flights are both partitioned by source file and month, so a new month is read
    and enriched by itself and the rows never move between tasks.
    """
    flights = enriched_flights(warehouse, source_files)
    flights = flights.withColumn(MONTH, month_of(F.col("fl_date")))
    write = warehouse.replace if source_files is None else warehouse.replace_partitions
    by = ("source_file", MONTH)
    return write(flights, "intermediate", "int_flights_enriched", *by, hide=(MONTH,))


def build_mart(warehouse: Warehouse, name: str) -> DataFrame:
    flights = warehouse.read("intermediate", "int_flights_enriched")
    return warehouse.replace(MARTS[name](flights), "marts", name)


def build_all(warehouse: Warehouse) -> dict[str, DataFrame]:
    """Seeds if missing, the enriched flights, then every mart from the stored flights."""
    if not all(warehouse.exists("seeds", name) for name in SEEDS):
        load_seeds(warehouse)
    tables = {"int_flights_enriched": build_enriched(warehouse)}
    for name in MARTS:
        tables[name] = build_mart(warehouse, name)
    return {**staging_views(warehouse), **tables}


def check_all(warehouse: Warehouse) -> DataFrame:
    """Violations of every declared check on the stored tables."""
    tables = staging_views(warehouse)
    tables["int_flights_enriched"] = warehouse.read("intermediate", "int_flights_enriched")
    for name in MARTS:
        tables[name] = warehouse.read("marts", name)
    return checks.run_checks(tables)


def validate_and_report(warehouse: Warehouse) -> DataFrame:
    """The load report of flight_raw; an error if nothing was loaded."""
    return reports.require_loaded(warehouse.read("staging", "flight_raw"))
