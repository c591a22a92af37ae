"""Files with the quirks of the real ones, written small, read whole."""

from __future__ import annotations

import zipfile

import pytest
from pyspark.sql import functions as F

from skymart import schema
from skymart.plans import pipeline, reports
from skymart.sources import archives, flight_files, lookup_files
from skymart.sources.warehouse import Warehouse

JANUARY = (
    "FlightDate_m12,Reporting_Airline,Tail_Number,OriginCityName,Origin,Dest,CRSDepTime,"
    "DepDelayMinutes,ArrDelayMinutes,Cancelled,Origin,Distance,Extra,\n"
    '2024-01-05,AA,N1,"Chicago, IL",ORD,LAX,0905,0.00,20.00,0.00,XXX,1744.00,x,\n'
    '2024-01-06,NA,"",,JFK,LAX,5,,,1.00,XXX,2475.0,x,\n'
    "bad date,UA,N2,,SFO,LAX,2400,7.5,abc,0.00,XXX,,x,\n"
)
FEBRUARY = "Origin,Dest,FlightDate,Reporting_Airline\nBOS,JFK,2024-02-01,B6\n"


@pytest.fixture
def files(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "jan.csv").write_text(JANUARY)
    (tmp_path / "in" / "feb.csv").write_text(FEBRUARY)
    return tmp_path / "in"


def test_header_rules():
    header = ["FlightDate_m9", "Origin", "Origin_m3", "Unnamed: 4", "", "Other", "Dest"]
    assert flight_files.known_positions(header) == {"fl_date": 0, "origin": 1, "dest": 6}


def test_flight_files_with_different_headers(spark, files):
    rows = {
        (r.source_file, r.reporting_airline): r
        for r in flight_files.read_flights(spark, [str(files)]).collect()
    }
    assert len(rows) == 4
    first = rows["jan.csv", "AA"]
    assert str(first.fl_date) == "2024-01-05"
    assert first.origin_city_name == "Chicago, IL"
    assert (first.origin, first.crs_dep_time, first.arr_delay_minutes) == ("ORD", 905, 20.0)
    empty = rows["jan.csv", "NA"]
    assert empty.tail_number is None and empty.dep_delay_minutes is None
    bad = rows["jan.csv", "UA"]
    assert bad.fl_date is None and bad.arr_delay_minutes is None and bad.dep_delay_minutes == 7.5
    other = rows["feb.csv", "B6"]
    assert (other.origin, other.dest, other.distance) == ("BOS", "JFK", None)
    assert other.ingested_at is not None


def test_flight_columns_match_the_contract(spark, files):
    df = flight_files.read_flights(spark, [str(files)])
    expected = [(f.name, f.dataType) for f in schema.FLIGHT_RAW.fields[1:]]
    assert [(f.name, f.dataType) for f in df.schema.fields] == expected


def test_no_files_is_an_error(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError):
        flight_files.read_flights(spark, [str(tmp_path / "empty.csv")])


def test_scan_reads_only_asked_columns(spark, files):
    plan = flight_files.read_flights(spark, [str(files / "jan.csv")]).select("origin")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<p4:string>" in text


def test_profile(spark, files):
    got = {
        (r.source_file, r.column_name): (r.rows, r.missing, r.unparsable, r.too_long)
        for r in flight_files.profile(
            flight_files.read_text_columns(spark, [str(files)])
        ).collect()
    }
    assert len(got) == 2 * len(schema.FLIGHT_FIELDS)
    assert got["jan.csv", "fl_date"] == (3, 0, 1, 0)
    assert got["jan.csv", "arr_delay_minutes"] == (3, 1, 1, 0)
    assert got["feb.csv", "distance"] == (1, 1, 0, 0)


def test_zipped_files_equal_plain_files(spark, files, tmp_path):
    for name in ("jan", "feb"):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w") as archive:
            archive.writestr("readme.html", "no data")
            archive.write(files / f"{name}.csv", f"{name}.csv")
    zipped = archives.read_zipped_csv(spark, [str(tmp_path / "jan.zip"), str(tmp_path / "feb.zip")])
    plain = flight_files.read_flights(spark, [str(files)])
    a, b = zipped.drop("ingested_at"), plain.drop("ingested_at")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert zipped.dtypes == plain.dtypes


def test_archive_with_a_header_only(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "empty.zip", "w") as archive:
        archive.writestr("empty.csv", JANUARY.splitlines()[0] + "\n")
    assert archives.read_zipped_csv(spark, [str(tmp_path / "empty.zip")]).count() == 0


def test_archive_without_csv_is_an_error(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "none.zip", "w") as archive:
        archive.writestr("readme.html", "no data")
    with pytest.raises(Exception, match="no CSV file"):
        archives.read_zipped_csv(spark, [str(tmp_path / "none.zip")]).collect()


AIRPORTS = (
    '1,"O\'Hare","Chicago, IL","United States"," ORD ","KORD",41.9786,-87.9048,672,-6,"A",'
    '"America/Chicago","airport","x"\n'
    '2,"No code","Town","Canada",\\N,"CYZZ",1,2,3,-5,"A","America/Toronto","airport","x"\n'
    '3,"Long code","Town","Canada","ABCD","CYZZ",1,2,3,-5,"A","America/Toronto","airport","x"\n'
    '4,"Short line","Town","Canada","YYZ","CYYZ",43.6\n'
    '5,"Long line","Town","Canada","YVR","CYVR",1,2,3,-5,"A","America/Toronto","airport","x",\n'
    '6,"Too long","Town","Canada","YUL","CYUL",1,2,3,-5,"A","Z","airport","x","y",2\n'
    '7,"A \\"quoted\\" name","Town","Canada","YOW",\\N,\\N,2,3,-5,"A","Z","airport","x"\n'
)
AIRLINES = (
    '1,"American","","AA","AAL","AMERICAN","United States","Y"\n'
    '2,"Closed",\\N,"CC","CCC","","Nowhere","N"\n'
    '3,"No code",\\N,\\N,"DDD","","Nowhere","Y"\n'
    '4,"Blank",\\N,"","EEE","","Nowhere","Y"\n'
    '5,"North",\\N,"NA","FFF","","Nowhere","Y"\n'
    '6,"Twice",\\N,"AA","GGG","","Nowhere","Y"\n'
    '7,"Spaced flag",\\N,"SF","HHH","","Nowhere"," Y"\n'
)


def test_airports_file(spark, tmp_path):
    (tmp_path / "airports.dat").write_text(AIRPORTS)
    rows = {
        r.iata_code: r
        for r in lookup_files.read_airports(spark, [str(tmp_path / "airports.dat")]).collect()
    }
    assert set(rows) == {"ORD", "YYZ", "YOW"}
    assert rows["ORD"].city == "Chicago, IL" and rows["ORD"].latitude == 41.9786
    assert rows["YYZ"].latitude == 43.6 and rows["YYZ"].timezone is None
    assert rows["YOW"].airport_name == 'A "quoted" name'
    assert rows["YOW"].icao_code == "\\N" and rows["YOW"].latitude is None


def test_airlines_file(spark, tmp_path):
    (tmp_path / "airlines.dat").write_text(AIRLINES)
    rows = lookup_files.read_airlines(spark, [str(tmp_path / "airlines.dat")]).collect()
    assert sorted(r.airline_name for r in rows) == ["American", "North", "Twice"]


@pytest.mark.parametrize("catalog", [False, True])
def test_pipeline_from_files_to_checks(spark, files, tmp_path, catalog):
    (tmp_path / "airports.dat").write_text(AIRPORTS)
    (tmp_path / "airlines.dat").write_text(AIRLINES)
    warehouse = Warehouse(spark, None if catalog else str(tmp_path / "wh"))
    warehouse.create()
    warehouse.create()
    with pytest.raises(ValueError):
        pipeline.validate_and_report(warehouse)
    assert pipeline.load_airports(warehouse, [str(tmp_path / "airports.dat")]).first()[0] == 3
    assert pipeline.load_airlines(warehouse, [str(tmp_path / "airlines.dat")]).first()[0] == 3

    loaded = pipeline.load_flights(warehouse, [str(files / "jan.csv")])
    assert [tuple(r) for r in loaded.collect()] == [("jan.csv", 3)]
    pipeline.load_flights(warehouse, [str(files / "feb.csv")])
    again = pipeline.load_flights(warehouse, [str(files / "jan.csv")])
    assert [tuple(r) for r in again.collect()] == [("jan.csv", 3)]

    flights = warehouse.read("staging", "flight_raw")
    assert flights.count() == 4
    assert flights.select("flight_id").distinct().count() == 4
    assert set(flights.columns) == set(schema.FLIGHT_RAW.fieldNames())

    tables = pipeline.build_all(warehouse)
    # the duplicate airline code repeats its one flight
    assert tables["int_flights_enriched"].count() == 5
    assert tables["mart_carrier_performance"].agg(F.sum("total_flights")).first()[0] == 5
    assert tables["mart_route_analysis"].count() == 0
    found = {
        (r["check"], r.table_name, r.column_name): r.violations
        for r in pipeline.check_all(warehouse).collect()
    }
    assert len(found) == 60
    assert found["unique", "stg_airlines", "iata_code"] == 1
    assert found["unique", "int_flights_enriched", "flight_id"] == 1
    assert found["unique", "stg_flights", "flight_id"] == 0
    assert found["not_null", "stg_flights", "fl_date"] == 1
    assert found["accepted_range", "stg_flights", "dep_hour"] == 1
    # enriching one file again changes nothing else
    before = warehouse.read("intermediate", "int_flights_enriched")
    rows = sorted(before.collect(), key=str)
    pipeline.build_enriched(warehouse, ["jan.csv"])
    after = warehouse.read("intermediate", "int_flights_enriched")
    again = sorted(after.select(before.columns).collect(), key=str)
    assert again == rows
    one = after.filter("source_file = 'feb.csv'")._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(source_file" in one.toString()
    report = pipeline.validate_and_report(warehouse).first()
    assert (report.total_rows, report.total_cancelled) == (4, 1)
    assert reports.sample_rows(flights).count() == 4


def _load(spark, tmp_path, catalog, *files):
    warehouse = Warehouse(spark, None if catalog else str(tmp_path / "wh"))
    warehouse.create()
    for file in files:
        pipeline.load_flights(warehouse, [str(file)])
    return warehouse.read("staging", "flight_raw")


@pytest.mark.parametrize("catalog", [False, True])
def test_files_of_one_name_are_both_kept(spark, tmp_path, catalog):
    for year in ("2023", "2024"):
        (tmp_path / year).mkdir()
        text = f"FlightDate,Origin\n{year}-01-01,AAA\n"
        (tmp_path / year / "twice.csv").write_text(text)
    names = [tmp_path / "2023" / "twice.csv", tmp_path / "2024" / "twice.csv"]
    flights = _load(spark, tmp_path, catalog, *names, names[0]).filter("source_file = 'twice.csv'")
    assert sorted(str(r.fl_date) for r in flights.collect()) == ["2023-01-01", "2024-01-01"]


def test_zipped_and_plain_files_agree_on_quotes(spark, tmp_path):
    text = (
        "\n\nFlightDate,Origin,OriginCityName,Distance,CRSDepTime\n"
        '2024-01-01,AAA,"A ""b"" c",NaN,905.7\n2024-01-02,BBB,"x, ""y""",Infinity,905.0\n'
    )
    (tmp_path / "q.csv").write_text(text)
    with zipfile.ZipFile(tmp_path / "q.zip", "w") as archive:
        archive.write(tmp_path / "q.csv", "q.csv")
    columns = ("origin", "origin_city_name", "distance", "crs_dep_time")
    expected = [("AAA", 'A "b" c', None, None), ("BBB", 'x, "y"', None, 905)]
    for df in (
        flight_files.read_flights(spark, [str(tmp_path / "q.csv")]),
        archives.read_zipped_csv(spark, [str(tmp_path / "q.zip")]),
    ):
        assert sorted(tuple(r) for r in df.select(*columns).collect()) == expected
    found = flight_files.profile(flight_files.read_text_columns(spark, [str(tmp_path / "q.csv")]))
    unparsable = {r.column_name: r.unparsable for r in found.collect()}
    assert (unparsable["distance"], unparsable["crs_dep_time"]) == (2, 1)


def test_a_file_without_known_columns_is_an_error(spark, files):
    (files / "foreign.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="no known column"):
        flight_files.read_flights(spark, [str(files)])


def test_headers_take_one_job_and_equal_places_one_scan(spark, tmp_path):
    for k in range(6):
        (tmp_path / f"{k}.csv").write_text(f"Origin_m{k},Dest\nA,B\n")

    def jobs(paths):
        group = f"headers-{len(paths)}"
        spark.sparkContext.setJobGroup(group, group)
        df = flight_files.read_text_columns(spark, paths)
        count = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        spark.sparkContext._jsc.clearJobGroup()
        return df, count

    names = [str(tmp_path / f"{k}.csv") for k in range(6)]
    (_, one), (df, six) = jobs(names[:1]), jobs(names)
    assert one == six
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and df.count() == 6


def test_columns_of_files(spark, files):
    rows = flight_files.columns_of_files(spark, [str(files / "jan.csv")]).collect()
    found = {r.column_name: (r.expected, r.present) for r in rows}
    assert found["fl_date"] == (True, True) and found["air_time"] == (True, False)
    assert found["Extra"] == (False, True)


def test_partition_names_stay_texts(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    rows = spark.createDataFrame([("007", 1), ("20240101", 2)], "source_file string, n int")
    stored = warehouse.replace(rows, "marts", "some", "source_file")
    assert {r.source_file for r in stored.collect()} == {"007", "20240101"}


def test_doubled_quotes_in_lookup_files(spark, tmp_path):
    line = '1,"The ""Old"" One","Town","Canada","YOW","CYOW",1,2,3,-5,"A","Z","airport",""\n'
    (tmp_path / "airports.dat").write_text(line + AIRPORTS)
    rows = lookup_files.read_airports(spark, [str(tmp_path / "airports.dat")]).collect()
    assert {r.airport_name for r in rows if r.iata_code == "YOW"} == {
        'The "Old" One',
        'A "quoted" name',
    }


def test_raw_tables_exist_in_a_folder(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    warehouse.create()
    assert warehouse.exists("staging", "flight_raw")
    assert warehouse.read("staging", "flight_raw").count() == 0
