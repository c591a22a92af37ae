"""Every registered query against DuckDB, and the shape of the plans."""

from __future__ import annotations

import re
from datetime import datetime

import compare
import pytest

import __spark_entry__ as contract
from contract import fixture, oracle, queries
from contract.queries import Inputs
from skymart.plans import marts, reports

SF_DIR = "/root/testdata/sf0.001"
QUERIES = queries.queries()
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert ORACLE.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_equal_to_duckdb(spark, duck, name):
    assert compare.compare(spark, duck, QUERIES[name], ORACLE[name], SF_DIR) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_enriched_plan_is_map_only(spark):
    plan = _plan(Inputs(spark, SF_DIR).enriched)
    assert plan.count("BroadcastHashJoin") >= 4
    assert "BroadcastNestedLoopJoin BuildRight, LeftOuter" in plan
    assert "Exchange hashpartitioning" not in plan and "Python" not in plan


@pytest.mark.parametrize("facts", ["carrier_month_facts", "delay_facts", "route_facts"])
def test_marts_aggregate_before_the_shuffle(spark, facts):
    plan = _plan(getattr(marts, facts)(Inputs(spark, SF_DIR).enriched))
    assert "partial_count" in plan
    assert "SinglePartition" not in plan and "Python" not in plan
    assert "Window" not in plan and "CartesianProduct" not in plan


def test_generated_code_can_be_compiled(spark, tmp_path, capsys):
    """The JVM leaves methods of more than 8,000 bytes uncompiled."""
    Inputs(spark, SF_DIR).raw.write.parquet(str(tmp_path / "raw"))
    inputs = Inputs(spark, SF_DIR)
    inputs.raw = spark.read.parquet(str(tmp_path / "raw"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (
            inputs.enriched,
            marts.carrier_month_facts(inputs.enriched),
            marts.delay_facts(inputs.enriched),
            marts.route_facts(inputs.enriched),
        ):
            df.explain("codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_mart_scan_is_pruned(spark, tmp_path):
    Inputs(spark, SF_DIR).enriched.write.parquet(str(tmp_path / "enriched"))
    plan = _plan(marts.route_facts(spark.read.parquet(str(tmp_path / "enriched"))))
    scanned = plan.split("ReadSchema: struct<")[1]
    assert "tail_number" not in scanned and "taxi_out" not in scanned


@pytest.mark.parametrize("name", ["load_report", "headline_metrics", "distinct_counts"])
def test_distinct_counts_copy_no_rows(spark, name):
    assert "Expand" not in _plan(QUERIES[name](spark, SF_DIR))


def test_marts_are_read_in_order(spark):
    marts_by_name = {
        "mart_carrier_performance": Inputs(spark, SF_DIR).carriers,
        "mart_route_analysis": Inputs(spark, SF_DIR).routes,
    }
    for name, mart in marts_by_name.items():
        values = [r[reports.MART_ORDER[name]] for r in reports.in_order(mart, name).collect()]
        known = [v for v in values if v is not None]
        assert known and values == sorted(known, reverse=True) + [None] * (len(values) - len(known))


def _of_small_tables(spark, folder):
    """Tables of one flight a part, with a customer and a supplier that none has."""
    def write(name, rows, columns):
        spark.createDataFrame(rows, columns).coalesce(1).write.parquet(f"{folder}/{name}.parquet")

    lines = [(k % 40, k, k % 5, k % 3, datetime(1995, 1 + k % 12, 3)) for k in range(200)]
    write("lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_shipdate timestamp_ntz")
    write("orders", [(k, k % 7) for k in range(40)], "o_orderkey long, o_custkey long")
    write("customer", [(k, k % 4) for k in range(6)], "c_custkey long, c_nationkey int")
    write("supplier", [(k, k % 4) for k in range(4)], "s_suppkey long, s_nationkey int")
    return str(folder)


def test_flights_are_derived_in_methods_that_the_jvm_compiles(spark, tmp_path, capsys):
    sf_dir = _of_small_tables(spark, tmp_path)
    plain = fixture._query(spark, sf_dir, "flight_raw", "lines", "delayed")
    for once in (False, True):
        flights = fixture.flight_raw(spark, sf_dir, once)
        assert flights.schema == plain.schema
        assert sorted(map(str, flights.collect())) == sorted(map(str, plain.collect()))
        flights.explain("codegen")
        sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
        assert sizes and max(sizes) < 8000


def test_flights_read_several_times_are_joined_once(spark, tmp_path):
    flights = fixture.flight_raw(spark, _of_small_tables(spark, tmp_path), once=True)
    assert "Join" not in flights._jdf.queryExecution().optimizedPlan().toString()
