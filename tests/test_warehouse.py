"""Loads, versions and layout of stored tables."""

from __future__ import annotations

import re
import zipfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from skymart import schema
from skymart.operators import lookups, numbering
from skymart.plans import pipeline
from skymart.sources import archives, commits, flight_files
from skymart.sources.warehouse import Warehouse


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


def flights(spark, file, rows, month=1, airline="AA"):
    """Typed flights of one file."""
    text = spark.range(rows).select(
        *[F.lit(None).cast("string").alias(name) for name in flight_files.NAMES],
        F.lit(file).alias("source_file"),
        F.col("id"),
    )
    dated = text.withColumns(
        {
            "fl_date": F.format_string(f"2024-{month:02d}-%02d", (27 - F.col("id") % 27).cast("int")),
            "reporting_airline": F.lit(airline),
            "origin": F.concat(F.lit("O"), F.col("id").cast("string")),
        }
    )
    return flight_files.typed(dated.drop("id").repartition(3))


def ids(table):
    return sorted(r.flight_id for r in table.select("flight_id").collect())


def stored(warehouse):
    return warehouse.read("staging", "flight_raw")


def test_ids_are_dense_over_loads(spark, warehouse):
    for file, rows in (("a.csv", 40), ("b.csv", 1), ("c.csv", 29)):
        counts = pipeline.store_flights(warehouse, flights(spark, file, rows)).collect()
        assert [tuple(r) for r in counts] == [(file, rows)]
    assert ids(stored(warehouse)) == list(range(1, 71))
    # An empty load changes nothing, and a repeated one only the ids of its own rows.
    assert pipeline.store_flights(warehouse, flights(spark, "d.csv", 0)).count() == 0
    pipeline.store_flights(warehouse, flights(spark, "b.csv", 1))
    assert ids(stored(warehouse)) == [i for i in range(1, 72) if i != 41]


def test_dense_numbers_have_no_gap(spark, tmp_path):
    rows = spark.range(1000).repartition(7).filter("id % 3 > 0")
    numbering.placed(rows, "place").write.parquet(str(tmp_path / "rows"))
    found = numbering.dense(spark.read.parquet(str(tmp_path / "rows")), "place", "n", 5)
    assert sorted(r.n for r in found.collect()) == list(range(5, 5 + rows.count()))


def test_a_load_that_ends_early_leaves_nothing(spark, warehouse):
    """Killed between its last row and its publication."""
    pipeline.store_flights(warehouse, flights(spark, "a.csv", 10))
    pipeline.stage_flights(warehouse, flights(spark, "b.csv", 10), [{"path": "b.csv", "bytes": 7}])
    assert ids(stored(warehouse)) == list(range(1, 11))
    pipeline.store_flights(warehouse, flights(spark, "b.csv", 5), [{"path": "b.csv", "bytes": 9}])
    assert ids(stored(warehouse)) == list(range(1, 16))
    loads = {(r.path, r.bytes, r.rows, r.first_id, r.last_id, r.committed) for r in warehouse.loads("staging", "flight_raw").collect()}
    assert loads == {(None, None, 10, 1, 10, True), ("b.csv", 7, None, None, None, False), ("b.csv", 9, 5, 11, 15, True)}
    warehouse.clean("staging", "flight_raw", hours=0)
    assert warehouse.log("staging", "flight_raw").folder.names(commits.STAGED) == []
    assert ids(stored(warehouse)) == list(range(1, 16))


def test_interleaved_loads_are_both_kept(spark, warehouse):
    first = pipeline.stage_flights(warehouse, flights(spark, "a.csv", 10))
    second = pipeline.stage_flights(warehouse, flights(spark, "b.csv", 7))
    second.publish()
    first.publish()
    assert ids(stored(warehouse)) == list(range(1, 18))
    by_file = {r.source_file: r["count"] for r in stored(warehouse).groupBy("source_file").count().collect()}
    assert by_file == {"a.csv": 10, "b.csv": 7}


def test_a_writer_that_loses_the_race_goes_on_top(spark, warehouse):
    """Another version appears between reading the latest one and writing its successor."""
    load = pipeline.stage_flights(warehouse, flights(spark, "a.csv", 10))
    put, raced = load.log.folder.put, []

    def slow_put(name, text):
        if not raced:
            raced.append(name)
            pipeline.store_flights(warehouse, flights(spark, "b.csv", 4))
        return put(name, text)

    load.log.folder.put = slow_put
    load.publish()
    assert raced and ids(stored(warehouse)) == list(range(1, 15))
    last = stored(warehouse).filter("source_file = 'a.csv'")
    assert ids(last) == list(range(5, 15))


def test_a_version_is_written_once(spark, tmp_path):
    folder = commits.Folder(spark, str(tmp_path))
    assert folder.put("one.json", "é") and not folder.put("one.json", "b")
    assert folder.text("one.json") == "é" and folder.names("") == ["one.json"]


def test_a_failed_refresh_leaves_the_old_table(spark, warehouse):
    good = spark.createDataFrame([(1, "a")], "n int, t string")
    warehouse.replace(good, "marts", "some")
    bad = good.withColumn("n", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        warehouse.replace(bad, "marts", "some")
    assert [tuple(r) for r in warehouse.read("marts", "some").collect()] == [(1, "a")]


def test_readers_of_the_old_version_go_on(spark, warehouse):
    warehouse.replace(spark.createDataFrame([(1,)], "n int"), "marts", "some")
    old = warehouse.read("marts", "some")
    new = warehouse.replace(spark.createDataFrame([(2,), (3,)], "n int"), "marts", "some")
    assert [r.n for r in old.collect()] == [1] and sorted(r.n for r in new.collect()) == [2, 3]
    assert [r.n for r in warehouse.read("marts", "some", version=1).collect()] == [1]
    warehouse.clean("marts", "some", hours=0)
    assert len(warehouse.log("marts", "some").folder.names(commits.DATA)) == 1
    assert sorted(r.n for r in new.collect()) == [2, 3]
    # A refresh may read the table that it replaces.
    again = warehouse.replace(new.select((F.col("n") + 1).alias("n")), "marts", "some")
    assert sorted(r.n for r in again.collect()) == [3, 4]


@pytest.mark.parametrize("root", [True, False])
def test_views_follow_the_versions(spark, tmp_path, root):
    warehouse = Warehouse(spark, str(tmp_path / "wh") if root else None)
    warehouse.create()
    for rows in (3, 5):
        pipeline.store_flights(warehouse, flights(spark, "007", rows))
        found = stored(warehouse).filter("source_file = '007'")
        assert found.count() == rows
        if not root:
            view = spark.table("staging.flight_raw").filter("source_file = '007'")
            assert view.columns == schema.FLIGHT_RAW.fieldNames()
            assert view.exceptAll(found).isEmpty() and view.count() == rows
    if not root:  # other tests begin with an empty table
        warehouse.log("staging", "flight_raw").folder.delete("")
        spark.sql("drop view staging.flight_raw")


def scan(df, metric=None):
    """The plan of a frame, or a figure of its scan after it ran."""
    plan = df._jdf.queryExecution().executedPlan()
    if metric is None:
        return plan.toString()
    return plan.collectLeaves().apply(0).metrics().apply(metric).value()


def test_a_month_is_pruned_and_rows_are_skipped(spark, warehouse):
    for month in (1, 2, 3):
        name = f"m{month}.csv"
        pipeline.store_flights(warehouse, flights(spark, name, 2000, month, f"A{month}"))
    found = pipeline.flights_between(warehouse, date(2024, 2, 1), date(2024, 2, 29))
    assert found.count() == 2000
    assert "PartitionFilters: [isnotnull(fl_month" in scan(found)
    listed = found.inputFiles()
    one = [f for f in listed if "fl_month=202402" in f]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = pipeline.flights_between(warehouse, date(2024, 2, 1), date(2024, 2, 29))
        found.write.format("noop").mode("overwrite").save()
        found.collect()
        assert scan(found, "numFiles") == len(one) < len(listed)
        # No file of February holds that airline: its bloom filters or bounds skip every row group.
        none = found.filter("reporting_airline = 'A1'")
        none.collect()
        assert scan(none, "numOutputRows") == 0
        # Rows are sorted by date within a file: a file's first row is its first day.
        folder = one[0].rsplit("/", 1)[0]
        days = spark.read.parquet(*one).select("fl_date", F.input_file_name().alias("f")).collect()
        for file in {r.f for r in days}:
            own = [r.fl_date for r in days if r.f == file]
            assert own == sorted(own), folder
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_bloom_filters_skip_row_groups(spark, warehouse):
    """O1 lies within the bounds of every file, but only in one of them."""
    for file in range(3):
        rows = flights(spark, f"{file}.csv", 300).withColumn("origin", F.concat("origin", F.lit(f"_{file}")))
        pipeline.store_flights(warehouse, rows.coalesce(1))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = stored(warehouse).filter("origin = 'O1_1'")
        assert len(found.collect()) == 1
        assert scan(found, "numOutputRows") == 300
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_one_file_is_enriched_by_itself(spark, warehouse):
    warehouse.create()
    pipeline.load_seeds(warehouse)
    for month, rows in ((1, 50), (2, 20), (3, 30)):
        pipeline.store_flights(warehouse, flights(spark, f"m{month}.csv", rows, month))
    before = pipeline.build_enriched(warehouse)
    assert before.count() == 100
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        own = pipeline.enriched_flights(warehouse, ["m2.csv"])
        assert re.search(r"PartitionFilters: \[[^\]]*source_file", scan(own))
        own.collect()
        leaves = own._jdf.queryExecution().executedPlan().collectLeaves()
        read = [leaves.apply(i) for i in range(leaves.size())]
        assert read[0].metrics().apply("numOutputRows").value() == 20
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    pipeline.store_flights(warehouse, flights(spark, "m2.csv", 25, 2))
    after = pipeline.build_enriched(warehouse, ["m2.csv"])
    counts = {r.source_file: r["count"] for r in after.groupBy("source_file").count().collect()}
    assert counts == {"m1.csv": 50, "m2.csv": 25, "m3.csv": 30}
    assert "fl_month" not in after.columns
    kept = after.filter("source_file <> 'm2.csv'")
    assert kept.exceptAll(before.filter("source_file <> 'm2.csv'")).isEmpty()


def test_zipped_member_beyond_a_buffer(spark, tmp_path):
    """Archive and member are both longer than what is fetched or parsed at once."""
    count = 2 * archives.BATCH_ROWS + 17
    lines = (f"2024-01-01,A{i:09d},{(i * 2654435761) % 2**32:032b}\n" for i in range(count))
    path = tmp_path / "long.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as archive:
        archive.writestr("notes.txt", "no data")
        archive.writestr("long.csv", "FlightDate_m1,Origin,OriginCityName\n" + "".join(lines))
    assert path.stat().st_size > 3 * archives.BUFFER_BYTES
    found = archives.read_zipped_csv(spark, [str(tmp_path)])
    assert found.rdd.getNumPartitions() == 1
    figures = found.agg(F.count("*"), F.count_distinct("origin"), F.min("fl_date"), F.max("source_file")).first()
    assert tuple(figures) == (count, count, date(2024, 1, 1), "long.csv")


def test_headers_are_read_in_executors(spark, tmp_path, monkeypatch):
    (tmp_path / "long.csv").write_text("\n \nOrigin_m1,Dest\n" + "AAA,BBB\n" * 300_000)
    (tmp_path / "other.csv").write_text("﻿Dest,Origin\nCCC,DDD\n")
    (tmp_path / "blank.csv").write_text("\n\n")
    (tmp_path / "empty.csv").write_text("")
    found = {r.path.rsplit("/", 1)[1]: r for r in flight_files.headers(spark, [str(tmp_path)])}
    assert found["long.csv"].titles == ["Origin_m1", "Dest"]
    assert found["other.csv"].titles == ["Dest", "Origin"]
    assert found["blank.csv"].titles is None and "empty.csv" not in found
    assert found["long.csv"].bytes == (tmp_path / "long.csv").stat().st_size
    flights = flight_files.read_flights(spark, [str(tmp_path)])
    counts = {(r.origin, r.dest): r["count"] for r in flights.groupBy("origin", "dest").count().collect()}
    assert counts == {("AAA", "BBB"): 300_000, ("DDD", "CCC"): 1}


def test_profiled_files_with_sizes_and_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("FlightDate,Origin\n2024-01-01,AAA\nx,BBBBBBBBBBBB\n")
    (tmp_path / "b.csv").write_text("Origin_m2\nAAA\n")
    rows = flight_files.profiled(spark, [str(tmp_path)]).collect()
    found = {(r.source_file, r.column_name): r for r in rows}
    assert len(rows) == 2 * len(schema.FLIGHT_FIELDS)
    first, lacking = found["a.csv", "fl_date"], found["b.csv", "fl_date"]
    assert (first.rows, first.missing, first.unparsable, first.present) == (2, 0, 1, True)
    assert (lacking.rows, lacking.missing, lacking.present) == (1, 1, False)
    assert found["a.csv", "origin"].too_long == 1
    assert first.bytes == (tmp_path / "a.csv").stat().st_size


def test_ranges_of_any_number_meet_uncast_bounds(spark):
    ends = [(f"r{i}", i + 0.5, i + 1.5) for i in range(80)]
    ends += [("low", None, 3.25), ("high", 77.75, None), ("all", None, None), ("wide", -1e9, 40.5), ("none", 5.0, 4.0)]
    ends += [("endless", 70.0, float("inf")), ("point", 7.7, 7.7)]
    values = [0.2, 1.4, 0.5, 1.5, 7.7, 40.5, 40.51, 79.0, 1e12, -5.0, None, float("nan"), float("inf"), 0.2]
    facts = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    ranges = spark.createDataFrame(ends, "label string, low double, high double")
    expected = set()
    for i, v in enumerate(values):
        met = [
            label for label, low, high in ends
            if v is not None and v == v and (low is None or v >= low) and (high is None or v <= high)
        ]
        expected |= {(i, label) for label in met or [None]}
    for broadcast in (lookups.BROADCAST_RANGES, 1000):
        found = lookups.range_lookup(facts, ranges, "v", "low", "high", broadcast)
        assert {(r.i, r.label) for r in found.collect()} == expected
        assert found.count() == len(expected)
