"""Derived columns, lookups, marts and checks on small hand-made rows."""

from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from skymart import schema
from skymart.functions import exact
from skymart.functions import flights as fn
from skymart.operators import aggregates, checks, lookups
from skymart.plans import enriched, marts, reports, staging

_DEFAULT = {
    "fl_date": datetime.date(2024, 1, 6),
    "reporting_airline": "AA",
    "origin": "ORD",
    "dest": "LAX",
    "crs_dep_time": 905,
    "crs_arr_time": 1230,
    "dep_delay_minutes": 0.0,
    "arr_delay_minutes": 0.0,
    "cancelled": 0.0,
    "diverted": 0.0,
    "distance": 1744.0,
}


@pytest.fixture
def raw(spark):
    def build(*changes: dict):
        names = schema.FLIGHT_RAW.fieldNames()
        rows = []
        for i, change in enumerate(changes):
            values = {"flight_id": i + 1, **_DEFAULT, **change}
            rows.append(tuple(values.get(name) for name in names))
        return spark.createDataFrame(rows, schema.FLIGHT_RAW)

    return build


@pytest.fixture
def dims(spark):
    airports = spark.createDataFrame(
        [
            Row(iata_code="ORD", airport_name="O'Hare", city="Chicago", us_state="IL"),
            Row(iata_code="LAX", airport_name="Los Angeles", city="Los Angeles", us_state=None),
            Row(iata_code="SFO", airport_name="San Francisco", city="SF", us_state="CA"),
            Row(iata_code="SJC", airport_name="San Jose", city="San Jose", us_state="CA"),
        ],
        "iata_code string, airport_name string, city string, us_state string",
    ).withColumns({"latitude": F.lit(Decimal("1.5")), "longitude": F.lit(Decimal("2.5"))})
    airlines = spark.createDataFrame([("AA", "American")], "iata_code string, carrier_name string")
    return airlines, airports


@pytest.fixture
def enrich(spark, dims):
    def build(raw_flights, airlines=None, categories=None):
        return enriched.int_flights_enriched(
            staging.stg_flights(raw_flights),
            dims[0] if airlines is None else airlines,
            dims[1],
            schema.cancellation_codes(spark),
            categories or schema.delay_categories(spark),
        )

    return build


def _column(df, name, order="flight_id"):
    return [r[name] for r in df.orderBy(order).select(order, name).collect()]


def _one(spark, column, **values):
    types = {int: "int", float: "double", str: "string", datetime.date: "date"}
    df = spark.range(1)
    for name, (value, type_) in values.items():
        df = df.withColumn(name, F.lit(value).cast(types[type_]))
    return df.select(column.alias("x")).first().x


# scalar functions


@pytest.mark.parametrize(
    ("hhmm", "hour"),
    [(5, 0), (59, 0), (100, 1), (905, 9), (1200, 12), (2359, 23), (2400, 24), (12345, 12), (None, None)],
)
def test_hour(spark, hhmm, hour):
    assert _one(spark, fn.hhmm_hour(F.col("t")), t=(hhmm, int)) == hour


@pytest.mark.parametrize(
    ("hour", "period"),
    [(4, "Night"), (5, "Morning"), (11, "Morning"), (12, "Afternoon"), (16, "Afternoon"),
     (17, "Evening"), (20, "Evening"), (21, "Night"), (24, "Night"), (None, "Night")],
)
def test_time_period(spark, hour, period):
    assert _one(spark, fn.time_period(F.col("h")), h=(hour, int)) == period


@pytest.mark.parametrize("offset", range(7))
def test_weekdays(spark, offset):
    day = datetime.date(2024, 1, 7) + datetime.timedelta(offset)
    assert _one(spark, fn.weekday_name(F.col("d")), d=(day, datetime.date)) == day.strftime("%A")
    weekend = _one(spark, fn.is_weekend(F.col("d")), d=(day, datetime.date))
    assert weekend == (day.weekday() >= 5)


def test_missing_date(spark):
    assert _one(spark, fn.weekday_name(F.col("d")), d=(None, datetime.date)) is None
    assert _one(spark, fn.is_weekend(F.col("d")), d=(None, datetime.date)) is None
    assert _one(spark, fn.month_start(F.col("d")), d=(None, datetime.date)) is None


@pytest.mark.parametrize(
    ("miles", "bucket"),
    [(499.9, "Short Haul"), (500.0, "Medium Haul"), (1499.0, "Medium Haul"), (1500.0, "Long Haul"),
     (None, "Long Haul")],
)
def test_distance_bucket(spark, miles, bucket):
    assert _one(spark, fn.distance_bucket(F.col("m")), m=(miles, float)) == bucket


@pytest.mark.parametrize(
    ("origin", "dest", "expected"),
    [("CA", "CA", True), ("CA", "IL", False), (None, "CA", False), (None, None, False),
     ("CA", None, None)],
)
def test_same_state(spark, origin, dest, expected):
    same = fn.same_state(F.col("o"), F.col("d"))
    assert _one(spark, same, o=(origin, str), d=(dest, str)) is expected


@pytest.mark.parametrize(
    ("city", "country", "state"),
    [("Chicago, IL", " United States ", "IL"), ("Chicago", "United States", None),
     ("Chicago,IL", "United States", None), ("Toronto, ON", "Canada", None),
     ("Chicago,  ", "United States", None), (None, "United States", None)],
)
def test_us_state(spark, city, country, state):
    got = _one(spark, fn.us_state(F.col("city"), F.col("country")), city=(city, str), country=(country, str))
    assert got == state


@pytest.mark.parametrize(
    ("parts", "cause"),
    [((0, 0, 0, 0, 0), "None"), ((5, 5, 5, 5, 5), "Carrier"), ((1, 5, 5, 0, 0), "Weather"),
     ((0, 0, 3, 3, 3), "NAS"), ((0, 0, 0, 4, 4), "Security"), ((1, 2, 3, 4, 5), "Late Aircraft"),
     ((-1, -2, -3, -4, -5), "None")],
)
def test_primary_cause(spark, parts, cause):
    columns = {label: F.lit(float(v)) for (label, _), v in zip(schema.DELAY_CAUSES, parts)}
    assert _one(spark, fn.primary_cause(columns)) == cause


def test_rounding_is_half_away_from_zero(spark):
    half = exact.mean(F.lit(1.0), F.lit(8))  # 0.125
    assert _one(spark, half) == Decimal("0.13")
    assert _one(spark, exact.mean(F.lit(-1.0), F.lit(8))) == Decimal("-0.13")
    assert _one(spark, exact.percent(F.lit(1), F.lit(0))) is None
    assert _one(spark, exact.percent(F.lit(1), F.lit(3), 4)) == Decimal("33.3333")
    assert _one(spark, exact.mean(F.lit(25815.0), F.lit(200))) == Decimal("129.08")
    assert _one(spark, exact.percent_of_sum(F.lit(1.0), F.lit(0.0))) is None


# staging


def test_flags_use_raw_minutes_and_measures_do_not(raw):
    flights = staging.stg_flights(raw({"arr_delay_minutes": None}, {"arr_delay_minutes": 16.0}))
    assert _column(flights, "arr_delay_minutes") == [0.0, 16.0]
    assert _column(flights, "is_delayed_arrival") == [None, True]
    assert _column(flights, "is_delayed_departure") == [False, False]


def test_derived_columns_of_missing_values(raw):
    """From stored rows, where nothing is folded to a constant."""
    gone = dict.fromkeys(
        ["fl_date", "crs_dep_time", "crs_arr_time", "origin", "cancelled", "diverted",
         "dep_delay_minutes", "arr_delay_minutes", "distance"]
    )
    rows = staging.stg_flights(raw({}, gone)).orderBy("flight_id").collect()
    assert (rows[0].day_of_week_name, rows[0].is_weekend, rows[0].dep_hour) == ("Saturday", True, 9)
    row = rows[1]
    nulls = ["day_of_week_name", "is_weekend", "dep_hour", "arr_hour", "is_cancelled",
             "is_diverted", "is_delayed_departure", "is_delayed_arrival", "route"]
    assert [row[name] for name in nulls] == [None] * len(nulls)
    assert (row.dep_time_period, row.primary_delay_cause) == ("Night", "None")
    assert (row.total_delay_minutes, row.arr_delay_minutes) == (0.0, 0.0)


def test_staging_adds_twelve_columns(raw):
    assert len(staging.stg_flights(raw({})).columns) == 39 + 12


def test_route_needs_both_ends(raw):
    assert _column(staging.stg_flights(raw({}, {"dest": None})), "route") == ["ORD-LAX", None]


def test_airport_view_drops_unusable_codes(spark):
    rows = [(" ORD ",), ("\\N",), ("",), ("ABCD",), (None,)]
    airports = spark.createDataFrame(rows, "iata_code string")
    for field in schema.AIRPORT_RAW.fields:
        if field.name != "iata_code":
            airports = airports.withColumn(field.name, F.lit(None).cast(field.dataType))
    assert [r.iata_code for r in staging.stg_airports(airports).collect()] == ["ORD"]


# lookups


def test_missing_lookups_keep_the_flight(raw, enrich):
    row = enrich(raw({"reporting_airline": "ZZ", "origin": "XXX", "cancellation_code": "Q"})).first()
    assert row.carrier_name is None and row.origin_airport_name is None
    assert row.cancellation_reason is None and row.dest_airport_name == "Los Angeles"
    assert row.is_same_state_flight is False


def test_cancelled_flight_is_labelled_on_time(raw, enrich):
    row = enrich(raw({"cancelled": 1.0, "cancellation_code": "B", "arr_delay_minutes": None})).first()
    assert (row.delay_label, row.cancellation_reason) == ("On Time", "Weather")


def test_duplicate_airline_repeats_flights(spark, raw, enrich):
    twice = spark.createDataFrame([("AA", "One"), ("AA", "Two")], "iata_code string, carrier_name string")
    assert enrich(raw({}, {}), airlines=twice).count() == 4


def test_enriched_has_its_columns(raw, enrich):
    assert len(enrich(raw({})).columns) == 56


RANGES = [("low", 0, 15), ("high", 16, 500), ("wide", -1000, 20), ("empty", 9, 3)]
VALUES = [-2000.0, -5.0, 0.0, 15.0, 15.5, 16.0, 20.0, 59.9, 60.0, 500.0, 501.0, None]


@pytest.mark.parametrize("bound", [1000, 0])
def test_range_lookup_small_and_binned_agree(spark, bound):
    facts = spark.createDataFrame([(i, v) for i, v in enumerate(VALUES)], "id int, v double")
    ranges = spark.createDataFrame(RANGES, "label string, lo int, hi int")
    found = lookups.range_lookup(facts, ranges, "v", "lo", "hi", max_broadcast=bound, bin_width=60)
    expected = []
    for i, v in enumerate(VALUES):
        hits = [n for n, lo, hi in RANGES if v is not None and lo <= v <= hi]
        expected += [(i, v, hit) for hit in hits or [None]]
    key = lambda r: (r[0], r[2] or "")
    assert sorted((tuple(r) for r in found.collect()), key=key) == sorted(expected, key=key)
    assert found.columns == ["id", "v", "label"]


def test_large_dimension_is_not_hinted(spark, monkeypatch, raw, dims):
    flights = staging.stg_flights(raw({}, {"reporting_airline": "ZZ"}))
    hinted = enriched.with_carrier(flights, dims[0])
    monkeypatch.setattr(lookups, "BROADCAST_ROWS", 0)
    plain = enriched.with_carrier(flights, dims[0])
    assert "broadcast" in hinted._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in plain._jdf.queryExecution().logical().toString().lower()
    assert _column(hinted, "carrier_name") == _column(plain, "carrier_name") == ["American", None]


# aggregates


def test_most_frequent_takes_lowest_on_ties_and_ignores_null(spark):
    rows = [("a", "x", 2), ("a", "b", 2), ("a", None, 9), ("c", None, 1)]
    df = spark.createDataFrame(rows, "k string, v string, n long")
    got = dict(df.groupBy("k").agg(aggregates.most_frequent("v", "n")).collect())
    assert got == {"a": "b", "c": None}


def test_most_frequent_of_closed_labels(spark):
    winner = aggregates.most_frequent_of({"z": F.lit(2), "b": F.lit(2), "a": F.lit(1)})
    assert _one(spark, winner) == "b"
    assert _one(spark, aggregates.most_frequent_of({"a": F.lit(0), "b": F.lit(0)})) is None


def test_global_rank_equals_window(spark):
    df = spark.range(200).select("id", (F.col("id") * 7 % 23).alias("v"))
    df = df.withColumn("v", F.when(F.col("v") != 3, F.col("v")))
    df.createOrReplaceTempView("ranked_input")
    expected = spark.sql("select id, rank() over (order by v desc nulls first) as r from ranked_input")
    got = aggregates.global_rank(df, "v", "r")
    assert dict(got.select("id", "r").collect()) == dict(expected.collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rank(" not in plan


def test_rates_count_unknown_arrival_as_late(raw, enrich):
    flights = enrich(raw({}, {"arr_delay_minutes": None, "diverted": 1.0}, {"cancelled": 1.0}, {"arr_delay_minutes": 40.0}))
    row = marts.mart_carrier_performance(flights).first()
    assert (row.total_flights, row.total_cancelled, row.total_diverted) == (4, 1, 1)
    assert row.on_time_arrival_rate == Decimal("25.00")
    assert row.on_time_departure_rate == Decimal("75.00")
    assert row.cancellation_rate == Decimal("25.00")
    assert row.reliability_score == Decimal("0.00")
    assert row.avg_arr_delay_minutes == Decimal("40.00") and row.avg_dep_delay_minutes is None
    assert row.pct_carrier_caused is None and row.total_flights_rank == 1


def test_reliability_subtracts_the_unrounded_rate(raw, enrich):
    # 3 of 7 on time: 42.857 -> 42.86; 1 of 7 cancelled: 14.2857; 42.86 - 14.2857 = 28.5743
    late = {"arr_delay_minutes": 20.0}
    flights = enrich(raw({}, {}, {}, late, late, late, {"cancelled": 1.0}))
    assert marts.mart_carrier_performance(flights).first().reliability_score == Decimal("28.57")


def test_airport_mart(raw, enrich):
    flights = enrich(
        raw(
            {"dest": "LAX", "crs_dep_time": 905},
            {"dest": "SFO", "crs_dep_time": 1005, "weather_delay": 5.0},
            {"dest": "SFO", "crs_dep_time": None, "cancelled": 1.0},
            {"dest": "LAX", "crs_dep_time": 1030, "reporting_airline": "UA"},
            {"origin": "SFO", "dest": "ORD"},
            {"origin": None, "dest": "ORD"},
        )
    )
    rows = {r.iata_code: r for r in marts.mart_airport_performance(flights).collect()}
    ord_ = rows["ORD"]
    assert (ord_.total_departures, ord_.total_arrivals, ord_.airport_rank) == (4, 2, 1)
    assert (ord_.busiest_hour, ord_.top_destination, ord_.unique_routes) == (10, "LAX", 2)
    assert (ord_.unique_carriers, ord_.pct_weather_delayed) == (2, Decimal("25.00"))
    assert ord_.departure_cancellation_rate == Decimal("25.00")
    assert ord_.busiest_day_of_week == "Saturday"
    assert (rows["SFO"].total_arrivals, rows["SFO"].airport_rank) == (2, 2)
    assert (rows[None].unique_routes, rows[None].total_arrivals) == (0, 0)
    assert "LAX" not in rows  # arrivals only


def test_delay_mart(raw, enrich):
    flights = enrich(
        raw(
            {"arr_delay_minutes": 20.0, "nas_delay": 20.0},
            {"arr_delay_minutes": 25.0, "nas_delay": 20.0, "security_delay": 5.0, "dest": "SFO"},
            {"arr_delay_minutes": 20.0, "nas_delay": 20.0, "dest": "SFO", "distance": 1600.0},
            {"fl_date": None},
        )
    )
    rows = marts.mart_delay_analysis(flights).orderBy(F.desc("flight_count")).collect()
    assert len(rows) == 2
    top = rows[0]
    assert (top.delay_label, top.primary_delay_cause, top.flight_count) == ("Minor Delay", "NAS", 3)
    assert (top.avg_arr_delay_minutes, top.avg_security_delay) == (Decimal("21.67"), Decimal("5.00"))
    assert (top.worst_route, top.worst_carrier) == ("ORD-SFO", "American")
    assert top.avg_carrier_delay is None and top.pct_of_total == Decimal("75.0000")
    assert rows[1].flight_month is None and rows[1].delay_label == "On Time"
    assert rows[1].day_of_week_name is None


def test_route_mart_keeps_ten_flights_and_more(raw, enrich):
    changes = [{} for _ in range(10)] + [{"dest": "SFO"} for _ in range(9)]
    changes[0] = {"arr_delay_minutes": 10.0, "carrier_delay": 10.0}
    rows = marts.mart_route_analysis(enrich(raw(*changes))).collect()
    assert [r.route for r in rows] == ["ORD-LAX"]
    assert rows[0].avg_arr_delay_minutes == Decimal("10.00")
    assert (rows[0].most_common_delay_cause, rows[0].most_common_delay_period) == ("None", "Morning")


def test_hot_airport_results_are_whole(spark, raw, enrich):
    """One origin holding most rows: counts still add up and nothing is dropped."""
    flights = raw({})
    many = flights.crossJoin(spark.range(5000)).withColumn("flight_id", F.col("id")).drop("id")
    mart = marts.mart_airport_performance(enrich(many.unionByName(raw({"origin": "SFO"}))))
    assert {r.iata_code: r.total_departures for r in mart.collect()} == {"ORD": 5000, "SFO": 1}


def test_minutes_may_have_fractions(raw, enrich):
    row = enrich(raw({"arr_delay_minutes": 15.5})).first()
    assert row.delay_label is None and row.is_delayed_arrival is True


# reports


def test_empty_flights(spark):
    empty = spark.createDataFrame([], schema.FLIGHT_RAW)
    report = reports.load_report(empty).first()
    assert (report.total_rows, report.cancellation_rate) == (0, Decimal("0.00"))
    with pytest.raises(ValueError):
        reports.require_loaded(empty)


def test_null_order_of_reports(spark):
    carriers = spark.createDataFrame(
        [("a", Decimal("1.00"), 1, None), ("b", None, 1, None), ("c", Decimal("2.00"), 1, None)],
        "carrier_name string, reliability_score decimal(18,2), total_flights long, "
        "cancellation_rate decimal(18,2)",
    )
    names = lambda df: [r.carrier_name for r in df.collect()]
    assert names(reports.carrier_leaderboard(carriers)) == ["b", "c", "a"]
    assert names(reports.carriers_ascending(carriers)) == ["a", "c", "b"]


def test_reports_average_means_unweighted(spark):
    delays = spark.createDataFrame(
        [("Night", True, Decimal("10.00"), 1), ("Night", True, Decimal("20.00"), 99), ("Night", True, None, 5)],
        "dep_time_period string, is_weekend boolean, avg_arr_delay_minutes decimal(18,2), flight_count long",
    )
    assert reports.time_of_day(delays).first().avg_delay == Decimal("15.0")
    assert reports.weekend_split(delays).first().total_flights == 105


# checks


def test_declared_checks():
    kinds = [c.kind for c in checks.DECLARED]
    counted = {k: kinds.count(k) for k in set(kinds)}
    assert counted == {
        "not_null": 31, "unique": 5, "accepted_values": 5, "accepted_range": 14,
        "range_exclusive": 3, "valid_delays": 1, "positive_distance": 1,
    }


def test_checks_find_planted_violations(spark):
    rows = [(1, "a", 0.0, False), (1, "b", 1500.0, False), (2, None, None, None), (None, "z", 7.0, True)]
    df = spark.createDataFrame(rows, "id int, label string, v double, is_cancelled boolean")
    rules = [
        checks.Check("unique", "t", "id"),
        checks.Check("not_null", "t", "label"),
        checks.Check("accepted_values", "t", "label", ("a", "b")),
        checks.Check("accepted_range", "t", "v", (0, 1500)),
        checks.Check("range_exclusive", "t", "v", (0, 1500)),
        checks.Check("positive_distance", "t", "v", (0, None)),
    ]
    got = {r["check"]: r.violations for r in checks.run_checks({"t": df}, rules).collect()}
    assert got == {
        "unique": 1, "not_null": 1, "accepted_values": 1, "accepted_range": 0,
        "range_exclusive": 2, "positive_distance": 1,
    }
    assert checks.violating(df, rules[0]).first().n == 2
    assert [r.v for r in checks.violating(df, rules[4]).orderBy("v").collect()] == [0.0, 1500.0]


def test_delay_limit_check(raw):
    flights = staging.stg_flights(raw({}, {"arr_delay_minutes": 1501.0}, {"dep_delay_minutes": 1600.0}))
    rule = next(c for c in checks.DECLARED if c.kind == "valid_delays")
    assert checks.violating(flights, rule).count() == 2


def test_many_ranges_of_any_width(spark):
    """Thousands of ranges, one of them over all numbers, give what the nested loop gives."""
    ranges = [(f"r{k}", 7 * k - 5000, 7 * k - 5000 + k % 300) for k in range(5000)]
    ranges += [("all", -(2**31), 2**31 - 1), ("none", 5, 4)]
    ranges = spark.createDataFrame(ranges, "label string, low int, high int")
    facts = [(k, None if k % 50 == 0 else k * 13 - 6000) for k in range(1500)]
    facts = spark.createDataFrame(facts, "id int, minutes int")
    looked_up = [
        lookups.range_lookup(facts, ranges, "minutes", "low", "high", max_broadcast=n)
        for n in (10_000, 0)
    ]
    few, many = (sorted(map(tuple, df.select("id", "minutes", "label").collect()), key=str) for df in looked_up)
    assert few == many


def test_range_lookup_in_cells(spark, monkeypatch):
    """Many pairs are not written: crowded bins are cut into cells, with the rows of a plain join."""
    monkeypatch.setattr(lookups, "CELL_FACTS", 7)
    monkeypatch.setattr(lookups, "CELL_RANGES", 3)
    written = []
    monkeypatch.setattr(lookups, "settle", lambda df: written.append(df.columns) or df)
    values = [float(n % 90) - 10 for n in range(200)] + [5.0] * 50 + [None, float("nan"), float("inf")]
    facts = spark.createDataFrame(list(enumerate(values)), "id int, v double").cache()
    bounds = [(n, n * 3.0 - 40, n * 3.0 - 39.5 + n % 5) for n in range(30)]
    bounds += [(30, None, 12.0), (31, 60.0, None), (31, 60.0, None), (32, None, None), (33, 9.0, 8.0)]
    bounds = [b for b in bounds if b[0] != 32]
    ranges = spark.createDataFrame(bounds, "label int, low double, high double").cache()
    found = lookups.range_lookup(facts, ranges, "v", "low", "high", max_broadcast=1, max_pairs=0)
    plain = lookups.range_lookup(facts, ranges, "v", "low", "high", max_broadcast=100)
    assert found.columns == plain.columns == ["id", "v", "label"]
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(found) == rows(plain)
    assert found.filter("label is null").count() >= 2
    assert not any({"_value", "label"} <= set(columns) for columns in written)


def _dealt(plan):
    """Rows that every exchange of an executed plan wrote."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return _dealt(plan.executedPlan())
    if plan.nodeName().endswith("QueryStage"):
        return _dealt(plan.plan())
    own = [plan.metrics().apply("shuffleRecordsWritten").value()] if plan.nodeName() == "Exchange" else []
    return sum((_dealt(plan.children().apply(n)) for n in range(plan.children().size())), own)


def test_range_lookup_deals_facts_once(spark):
    """Where rows are too many to be written, facts are not copied for every part of their ranges."""
    facts = spark.range(3000).selectExpr("id", "cast(id as double) as v")
    ranges = spark.range(3000).selectExpr("id as label", "-1.0 - id as low", "3000.5D + id as high")
    found = lookups.range_lookup(facts, ranges, "v", "low", "high", max_pairs=0)
    executed = found._jdf.queryExecution()
    assert executed.toRdd().count() == 3000 * 3000
    assert max(_dealt(executed.executedPlan())) <= 6000


def test_range_lookup_in_slices(spark, monkeypatch):
    """Values over several slices, repeated rows, open, endless and NaN bounds, and facts in no range."""
    for name, n in {"CELL_FACTS": 8, "CELL_RANGES": 6, "PACKET": 3, "BLOCK": 2}.items():
        monkeypatch.setattr(lookups, name, n)
    values = [n % 40 * 3 for n in range(120)] + [30] * 60 + [-500, 7000, None]
    facts = [(n // 2, v, {"k": n // 2}) for n, v in enumerate(v for v in values for _ in range(2))]
    facts = spark.createDataFrame(facts, "id int, v int, more map<string,int>")
    endless, nan = float("inf"), float("nan")
    bounds = [(n, n * 5.0 + 0.5, n * 5.0 + n % 4 * 2.25) for n in range(22)]
    bounds += [(50, None, 29.5), (51, 29.5, 30.5), (51, 29.5, 30.5), (52, 117.0, endless), (53, 90.0, nan), (54, nan, 1.0)]
    bounds += [(55, 30.0, 30.0), (56, 9.0, 8.0), (None, 60.0, 61.5)]
    for some in (bounds, [b for b in bounds if b[0] not in (50, 52, 53)]):
        ranges = spark.createDataFrame(some, "label int, low double, high double")
        found = lookups.range_lookup(facts, ranges, "v", "low", "high", max_broadcast=1, max_pairs=0)
        plain = lookups.range_lookup(facts, ranges, "v", "low", "high", max_broadcast=100)
        assert found.dtypes == plain.dtypes
        rows = lambda df: sorted(map(str, df.collect()))
        assert rows(found) == rows(plain)
        assert plain.filter("v is not null and label is null").count() >= 4
