"""Time the model builds and reports on flight-shaped test data; prints one JSON line.

The raw tables are written once before the clock starts. Every timed step reads stored
tables and either stores its result or runs the report to the end. The steps run in
rounds and the best time of each counts: the first round is mostly the JVM compiling.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from contract import fixture
from skymart.operators import checks
from skymart.plans import pipeline, reports
from skymart.sources.warehouse import Warehouse

ROUNDS = 3
SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

REPORTS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "carrier_leaderboard": ("mart_carrier_performance", reports.carrier_leaderboard),
    "delay_causes": ("mart_delay_analysis", reports.delay_causes),
    "time_of_day": ("mart_delay_analysis", reports.time_of_day),
    "worst_routes": ("mart_route_analysis", reports.worst_routes),
    "weekend_split": ("mart_delay_analysis", reports.weekend_split),
    "busiest_airports": ("mart_airport_performance", reports.busiest_airports),
    "delayed_airports": ("mart_airport_performance", reports.delayed_airports),
    "distance_delay": ("mart_delay_analysis", reports.distance_delay),
}


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("skymart-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Raw tables as a load leaves them: one partition per source file."""
    warehouse = Warehouse(spark, tempfile.mkdtemp(prefix="skymart-bench-"))
    flights = fixture.flight_raw(spark, sf_dir).repartition(int(CPUS), "source_file")
    warehouse.replace(flights, "staging", "flight_raw", "source_file")
    warehouse.replace(fixture.airport_raw(spark, sf_dir), "staging", "airport_raw")
    warehouse.replace(fixture.airline_raw(spark, sf_dir), "staging", "airline_raw")
    pipeline.load_seeds(warehouse)
    return warehouse


def run(warehouse: Warehouse) -> dict[str, float]:
    times: dict[str, float] = {}

    def timed(name: str, step: Callable[[], object]) -> None:
        start = time.perf_counter()
        step()
        times[name] = round(time.perf_counter() - start, 3)

    timed("int_flights_enriched", lambda: pipeline.build_enriched(warehouse))
    for name in pipeline.MARTS:
        timed(name, lambda name=name: pipeline.build_mart(warehouse, name))
    raw = warehouse.read("staging", "flight_raw")
    timed("load_report", lambda: reports.load_report(raw).collect())
    timed("headline_metrics", lambda: reports.headline_metrics(raw).collect())
    for name, (mart, report) in REPORTS.items():
        timed(name, lambda m=mart, r=report: r(warehouse.read("marts", m)).collect())
    enriched = {"int_flights_enriched": warehouse.read("intermediate", "int_flights_enriched")}
    timed("checks_enriched", lambda: checks.run_checks(enriched).collect())
    return times


def main() -> None:
    spark = session()
    warehouse = prepare(spark, SF_DIR)
    rounds = [run(warehouse) for _ in range(ROUNDS)]
    times = {name: min(r[name] for r in rounds) for name in rounds[0]}
    print("first round:", round(sum(rounds[0].values()), 3), "s", file=sys.stderr)
    for name, seconds in times.items():
        print(f"{name}: {seconds} s", file=sys.stderr)
    result = {
        "metric": "enriched table, four marts and reports",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "first_round": rounds[0],
        "sf": SF_DIR.rsplit("/sf", 1)[-1],
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
