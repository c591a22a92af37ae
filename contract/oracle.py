"""The registered queries as DuckDB SQL over the same test tables.

Rounding is done on whole numbers: sums of minutes and counts are integers, so
``round(num / den)`` half away from zero is an integer division.
"""

from __future__ import annotations

import re

from contract import fixture
from skymart import schema


def _values(rows: tuple) -> str:
    return ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)


def _round(num: str, den: str, scale: int = 2) -> str:
    """num / den for non-negative integers; NULL when den is 0 or NULL."""
    k = 10**scale
    return (
        f"case when ({den}) > 0 then ((2 * ({num}) * {k} + ({den})) // (2 * ({den}))) / {k}.0 end"
    )


def _percent(part: str, whole: str, scale: int = 2) -> str:
    return _round(f"100 * ({part})", whole, scale)


def _minutes(column: str, where: str = "true") -> str:
    return f"coalesce(sum({column}::bigint) filter ({where}), 0)"


def _mean(column: str, where: str) -> str:
    return _round(_minutes(column, where), f"count({column}) filter ({where})")


def _count(where: str) -> str:
    return f"count(*) filter ({where})"


def _cents(column: str) -> str:
    return f"sum(round({column} * 100)::bigint)"


def _mean_of_means(column: str, scale: int) -> str:
    return _round(_cents(column), f"100 * count({column})", scale)


_ON_TIME_DEP = "not is_cancelled and not is_delayed_departure"
_ON_TIME_ARR = "not is_cancelled and not is_delayed_arrival"
_STATIC = {table: table for table in (*fixture.TABLES,)}

_CTES: dict[str, str] = {
    **{name: sql.format(**_STATIC) for name, sql in fixture.CTES.items()},
    "cancellation_codes": (
        f"select * from (values {_values(schema.CANCELLATION_CODES)}) as t(code, reason)"
    ),
    "delay_categories": f"""
        select * from (values {_values(schema.DELAY_CATEGORIES)}) as t(label, lo, hi)""",
    "stg_flights": """
        select r.* replace (
                 ifnull(dep_delay, 0) as dep_delay, ifnull(arr_delay, 0) as arr_delay,
                 ifnull(dep_delay_minutes, 0) as dep_delay_minutes,
                 ifnull(arr_delay_minutes, 0) as arr_delay_minutes,
                 ifnull(carrier_delay, 0) as carrier_delay,
                 ifnull(weather_delay, 0) as weather_delay, ifnull(nas_delay, 0) as nas_delay,
                 ifnull(security_delay, 0) as security_delay,
                 ifnull(late_aircraft_delay, 0) as late_aircraft_delay),
               crs_dep_time // 100 as dep_hour,
               crs_arr_time // 100 as arr_hour,
               cancelled = 1 as is_cancelled,
               diverted = 1 as is_diverted,
               r.dep_delay_minutes > 15 as is_delayed_departure,
               r.arr_delay_minutes > 15 as is_delayed_arrival,
               p.total as total_delay_minutes,
               case p.top when 0 then 'None'
                 when r.carrier_delay then 'Carrier' when r.weather_delay then 'Weather'
                 when r.nas_delay then 'NAS' when r.security_delay then 'Security'
                 else 'Late Aircraft' end as primary_delay_cause,
               concat_ws('-', origin, dest) as route,
               case when crs_dep_time >= 500 and crs_dep_time < 1200 then 'Morning'
                 when crs_dep_time >= 1200 and crs_dep_time < 1700 then 'Afternoon'
                 when crs_dep_time >= 1700 and crs_dep_time < 2100 then 'Evening'
                 else 'Night' end as dep_time_period,
               dayname(fl_date) as day_of_week_name,
               isodow(fl_date) > 5 as is_weekend
        from flight_raw r,
          lateral (select greatest(ifnull(r.carrier_delay, 0), ifnull(r.weather_delay, 0),
                                   ifnull(r.nas_delay, 0), ifnull(r.security_delay, 0),
                                   ifnull(r.late_aircraft_delay, 0)) as top,
                          ifnull(r.carrier_delay, 0) + ifnull(r.weather_delay, 0)
                            + ifnull(r.nas_delay, 0) + ifnull(r.security_delay, 0)
                            + ifnull(r.late_aircraft_delay, 0) as total) p""",
    "stg_airlines": """
        select trim(iata_code) as iata_code, nullif(trim(icao_code), '') as icao_code,
               trim(airline_name) as carrier_name, trim(country) as country,
               trim(active) as active
        from airline_raw where trim(iata_code) <> ''""",
    "stg_airports": """
        select trim(iata_code) as iata_code, nullif(trim(icao_code), '') as icao_code,
               trim(airport_name) as airport_name, trim(city) as city, trim(country) as country,
               sign(lat) * ((abs(lat) + 50) // 100) / 10000.0 as latitude,
               sign(lon) * ((abs(lon) + 50) // 100) / 10000.0 as longitude,
               altitude, trim(timezone) as timezone, trim(dst) as dst,
               case when country = 'United States'
                 then nullif(regexp_extract(city, ', ([^,]*)', 1), '') end as us_state
        from (select *, round(latitude * 1000000)::bigint as lat,
                     round(longitude * 1000000)::bigint as lon from airport_raw)
        where length(trim(iata_code)) = 3""",
    "int_flights_enriched": """
        select f.flight_id, f.fl_date, f.reporting_airline, f.tail_number, f.flight_number,
               f.route, al.carrier_name,
               f.origin, o.airport_name as origin_airport_name, o.city as origin_city,
               o.us_state as origin_state_name, o.latitude as origin_lat,
               o.longitude as origin_lon,
               f.dest, d.airport_name as dest_airport_name, d.city as dest_city,
               d.us_state as dest_state_name, d.latitude as dest_lat, d.longitude as dest_lon,
               f.crs_dep_time, f.dep_time, f.dep_hour, f.dep_time_period, f.crs_arr_time,
               f.arr_time, f.arr_hour, f.day_of_week_name, f.is_weekend, f.dep_delay,
               f.dep_delay_minutes, f.arr_delay, f.arr_delay_minutes, f.carrier_delay,
               f.weather_delay, f.nas_delay, f.security_delay, f.late_aircraft_delay,
               f.total_delay_minutes, f.primary_delay_cause, dc.label as delay_label,
               f.is_cancelled, f.is_diverted, f.is_delayed_departure, f.is_delayed_arrival,
               f.cancellation_code, cc.reason as cancellation_reason,
               f.distance, f.air_time, f.actual_elapsed_time, f.crs_elapsed_time, f.taxi_out,
               f.taxi_in,
               case when f.distance is null or f.distance >= 1500 then 'Long Haul'
                 when f.distance >= 500 then 'Medium Haul' else 'Short Haul' end
                 as distance_bucket,
               case when o.us_state is null then false
                 else o.us_state = d.us_state end as is_same_state_flight,
               f.ingested_at, f.source_file
        from stg_flights f
        left join stg_airlines al on al.iata_code = f.reporting_airline
        left join stg_airports o on o.iata_code = f.origin
        left join stg_airports d on d.iata_code = f.dest
        left join cancellation_codes cc on cc.code = f.cancellation_code
        left join delay_categories dc
          on f.arr_delay_minutes >= dc.lo and f.arr_delay_minutes <= dc.hi""",
    "carrier_months": f"""
        select carrier_name, reporting_airline,
               make_date(year(fl_date), month(fl_date), 1) as flight_month,
               count(*) as total_flights,
               {_count("is_cancelled")} as total_cancelled,
               {_count("is_diverted")} as total_diverted,
               {_percent(_count(_ON_TIME_DEP), "count(*)")} as on_time_departure_rate,
               {_percent(_count(_ON_TIME_ARR), "count(*)")} as on_time_arrival_rate,
               {_mean("dep_delay_minutes", "dep_delay_minutes > 15")} as avg_dep_delay_minutes,
               {_mean("arr_delay_minutes", "arr_delay_minutes > 15")} as avg_arr_delay_minutes,
               {_mean("carrier_delay", "carrier_delay <> 0")} as avg_carrier_delay,
               {_mean("weather_delay", "weather_delay <> 0")} as avg_weather_delay,
               {_mean("nas_delay", "nas_delay <> 0")} as avg_nas_delay,
               {_mean("late_aircraft_delay", "late_aircraft_delay <> 0")}
                 as avg_late_aircraft_delay,
               {_percent(_minutes("carrier_delay"), _minutes("total_delay_minutes"))}
                 as pct_carrier_caused
        from int_flights_enriched group by all""",
    "mart_carrier_performance": f"""
        select * exclude (gap),
               {_percent("total_cancelled", "total_flights")} as cancellation_rate,
               (rank() over (order by total_flights desc))::integer as total_flights_rank,
               sign(gap) * ((2 * abs(gap) + total_flights) // (2 * total_flights)) / 100.0
                 as reliability_score
        from (select *, round(on_time_arrival_rate * 100)::bigint * total_flights
                          - 10000 * total_cancelled as gap from carrier_months)""",
    "airport_departures": f"""
        select origin as iata_code, origin_airport_name as airport_name, origin_city as city,
               origin_state_name as state,
               count(*) as total_departures,
               {_count("is_cancelled")} as total_cancelled_departures,
               {_mean("dep_delay_minutes", "dep_delay_minutes > 15")} as avg_departure_delay,
               {_mean("arr_delay_minutes", "arr_delay_minutes > 15")} as avg_arrival_delay,
               {_percent(_count("weather_delay > 0"), "count(*)")} as pct_weather_delayed,
               {_percent(_count("nas_delay > 0"), "count(*)")} as pct_nas_delayed,
               mode(dep_hour order by dep_hour) as busiest_hour,
               mode(day_of_week_name order by day_of_week_name) as busiest_day_of_week,
               mode(dest order by dest) as top_destination,
               count(distinct route) as unique_routes,
               count(distinct reporting_airline) as unique_carriers,
               {_percent(_count("is_cancelled"), "count(*)")} as departure_cancellation_rate
        from int_flights_enriched group by all""",
    "mart_airport_performance": """
        select d.*, (select count(*) from int_flights_enriched a where a.dest = d.iata_code)
                      as total_arrivals,
               (rank() over (order by total_departures desc))::integer as airport_rank
        from airport_departures d""",
    "delay_segments": f"""
        select delay_label, primary_delay_cause, dep_time_period, day_of_week_name, is_weekend,
               distance_bucket, make_date(year(fl_date), month(fl_date), 1) as flight_month,
               count(*) as flight_count,
               {_round(_minutes("arr_delay_minutes"), "count(*)")} as avg_arr_delay_minutes,
               {_mean("carrier_delay", "carrier_delay <> 0")} as avg_carrier_delay,
               {_mean("weather_delay", "weather_delay <> 0")} as avg_weather_delay,
               {_mean("nas_delay", "nas_delay <> 0")} as avg_nas_delay,
               {_mean("late_aircraft_delay", "late_aircraft_delay <> 0")}
                 as avg_late_aircraft_delay,
               {_mean("security_delay", "security_delay <> 0")} as avg_security_delay,
               mode(carrier_name order by carrier_name) as worst_carrier,
               mode(route order by route) as worst_route
        from int_flights_enriched group by all""",
    "mart_delay_analysis": f"""
        select s.*, {_percent("flight_count", "total", 4)} as pct_of_total
        from delay_segments s, (select count(*) as total from int_flights_enriched)""",
    "mart_route_analysis": f"""
        select *, (rank() over (order by on_time_rate desc))::integer as route_reliability_rank
        from (
          select route, origin, dest, origin_airport_name, dest_airport_name, origin_city,
                 dest_city, distance_bucket, carrier_name,
                 count(*) as total_flights,
                 {_percent(_count(_ON_TIME_ARR), "count(*)")} as on_time_rate,
                 {_percent(_count("is_cancelled"), "count(*)")} as cancellation_rate,
                 {_mean("arr_delay_minutes", "arr_delay_minutes > 0")} as avg_arr_delay_minutes,
                 {_mean("distance", "true")} as avg_distance,
                 mode(primary_delay_cause order by primary_delay_cause)
                   as most_common_delay_cause,
                 mode(dep_time_period order by dep_time_period) as most_common_delay_period
          from int_flights_enriched group by all
        ) where total_flights >= 10""",
}


def _flights(columns: str) -> str:
    return f"select flight_id, {columns} from stg_flights"


def _enriched(columns: str) -> str:
    return f"select flight_id, {columns} from int_flights_enriched"


def _violations(kind: str, table: str, column: str, where: str) -> str:
    return (
        f"select '{kind}' as \"check\", '{table}' as table_name, '{column}' as column_name, "
        f"(select count(*) from {table} where {where}) as violations"
    )


def _repeats(table: str, column: str) -> str:
    return (
        f"select 'unique' as \"check\", '{table}' as table_name, '{column}' as column_name, "
        f"(select count(*) from (select {column} from {table} where {column} is not null "
        f"group by {column} having count(*) > 1)) as violations"
    )


# The columns that each table must have.
_NOT_NULL = {
    "stg_flights": ("flight_id", "fl_date", "reporting_airline", "origin", "dest"),
    "stg_airlines": ("iata_code", "carrier_name"),
    "stg_airports": ("iata_code", "airport_name"),
    "int_flights_enriched": (
        "flight_id", "fl_date", "reporting_airline", "carrier_name", "origin", "origin_airport_name", "dest", "dest_airport_name",
    ),
    "mart_carrier_performance": (
        "carrier_name", "reporting_airline", "flight_month", "total_flights",
    ),
    "mart_airport_performance": ("iata_code", "airport_name", "total_departures", "airport_rank"),
    "mart_delay_analysis": ("delay_label", "primary_delay_cause", "flight_count"),
    "mart_route_analysis": ("route", "carrier_name", "total_flights"),
}
_LABELS = "'On Time', 'Minor Delay', 'Moderate Delay', 'Significant Delay', 'Severe Delay'"
_ACCEPTED = (
    ("stg_flights", "dep_time_period", "'Morning', 'Afternoon', 'Evening', 'Night'"),
    (
        "stg_flights",
        "primary_delay_cause",
        "'Carrier', 'Weather', 'NAS', 'Security', 'Late Aircraft', 'None'",
    ),
    ("int_flights_enriched", "delay_label", _LABELS),
    ("int_flights_enriched", "distance_bucket", "'Short Haul', 'Medium Haul', 'Long Haul'"),
    ("mart_delay_analysis", "delay_label", _LABELS),
)
_RANGES = (
    ("stg_flights", "distance", 1, 6000),
    ("stg_flights", "dep_hour", 0, 23),
    ("stg_flights", "arr_delay_minutes", -120, 1500),
    ("stg_airports", "latitude", -90, 90),
    ("stg_airports", "longitude", -180, 180),
    ("int_flights_enriched", "distance", 1, 6000),
    ("int_flights_enriched", "arr_delay_minutes", -120, 1500),
    ("mart_carrier_performance", "cancellation_rate", 0, 100),
    ("mart_carrier_performance", "on_time_arrival_rate", 0, 100),
    ("mart_carrier_performance", "on_time_departure_rate", 0, 100),
    ("mart_airport_performance", "departure_cancellation_rate", 0, 100),
    ("mart_delay_analysis", "avg_arr_delay_minutes", -120, 1500),
    ("mart_route_analysis", "on_time_rate", 0, 100),
    ("mart_route_analysis", "cancellation_rate", 0, 100),
)
_EXCLUSIVE = (
    ("mart_carrier_performance", "avg_arr_delay_minutes"),
    ("mart_airport_performance", "avg_departure_delay"),
    ("mart_route_analysis", "avg_arr_delay_minutes"),
)
_UNIQUE = (
    ("stg_flights", "flight_id"),
    ("stg_airlines", "iata_code"),
    ("stg_airports", "iata_code"),
    ("int_flights_enriched", "flight_id"),
    ("mart_airport_performance", "iata_code"),
)
_UNION = " union all "

_FLIGHT_COLUMNS = ", ".join(f.name for f in schema.FLIGHT_FIELDS)


def _lacks(column: str) -> str:
    """Whether a flight's file has no such column."""
    return f"month(fl_date) % {fixture.LAYOUTS} = 2" if column in fixture.LACKING else "false"


def _loaded_columns() -> str:
    return ", ".join(
        f"case when not ({_lacks(f.name)}) then {f.name} end as {f.name}" for f in schema.FLIGHT_FIELDS
    )


def _profile() -> str:
    """Per column: flights, missing ones, and those that the fixture planted."""
    planted = {column: (value, every) for column, value, every in fixture.PLANTED}

    def of(field: schema.Field) -> str:
        value, every = planted.get(field.name, ("", 0))
        here = f"flight_id % {every} = 0" if every else "false"
        long = bool(field.max_length) and len(value) > field.max_length
        return (
            f"select '{field.name}' as column_name, count(*) as rows, "
            f"count(*) filter (({field.name} is null and not ({here})) or {_lacks(field.name)}) as missing, "
            f"count(*) filter ({here if not long else 'false'}) as unparsable, "
            f"count(*) filter ({here if long else 'false'}) as too_long, "
            f"count(*) filter ({_lacks(field.name)}) as lacking_rows, true as sized from flight_raw"
        )

    return " union all ".join(of(field) for field in schema.FLIGHT_FIELDS)

_QUERIES: dict[str, str] = {
    "load_flights": f"select {_loaded_columns()} from flight_raw",
    "load_zipped_flights": f"select {_FLIGHT_COLUMNS} from flight_raw",
    "load_metadata": "select count(*) as flights, count(*) as stamped, count(*) as named from flight_raw",
    "profile_flights": _profile(),
    "surrogate_keys": """
        select count(*) as flights, 1::bigint as first_id, count(*) as last_id, count(*) as ids
        from flight_raw""",
    "load_manifest": """
        select rows, (last_id - rows + 1)::bigint as first_id, last_id, true as committed
        from (
            select third, rows, sum(rows) over (order by third)::bigint as last_id
            from (select month(fl_date) % 3 as third, count(*) as rows from flight_raw group by 1)
        )
        union all select null, null, null, false""",
    "reloaded_flights": """
        select source_file, count(*) as flights,
               nullif(count(*) filter (fl_date between date '1995-01-01' and date '1995-01-31'), 0)
                   as found_by_date
        from flight_raw group by source_file""",
    "load_airports": f"""
        select trim(iata_code) as iata_code, nullif(icao_code, '') as icao_code, airport_name,
               city, country, latitude, longitude, altitude, timezone, dst
        from airport_raw
        where length(trim(iata_code)) = 3""",
    "load_airlines": f"""
        select trim(iata_code) as iata_code, nullif(icao_code, '') as icao_code, airline_name,
               country, active
        from airline_raw where active = 'Y'""",
    "stg_flights": "select * from stg_flights",
    "stg_airlines": "select * from stg_airlines",
    "stg_airports": "select * from stg_airports",
    "dep_hour_bucket": _flights("crs_dep_time, dep_hour, arr_hour, dep_time_period"),
    "weekday_weekend": _flights("fl_date, day_of_week_name, is_weekend"),
    "primary_delay_cause": _flights("total_delay_minutes, primary_delay_cause"),
    "delay_flags_nullable": _flights(
        "arr_delay_minutes, is_cancelled, is_diverted, is_delayed_departure, is_delayed_arrival"
    ),
    "route_concat": _flights("origin, dest, route"),
    "route_missing_end": """
        select *, origin || '-' || dest as route
        from (
            select flight_id, case when flight_id % 50 <> 0 then origin end as origin,
                   case when flight_id % 70 <> 0 then dest end as dest
            from flight_raw
        )""",
    "us_state_from_city": "select iata_code, city, country, us_state from stg_airports",
    "rounded_coordinates": "select iata_code, latitude, longitude from stg_airports",
    "distance_bucket": _enriched("distance, distance_bucket"),
    "same_state_flag": _enriched("origin_state_name, dest_state_name, is_same_state_flight"),
    "month_truncation": _flights("make_date(year(fl_date), month(fl_date), 1) as flight_month"),
    "join_airline": _enriched("reporting_airline, carrier_name"),
    "join_airports_two_roles": _enriched(
        "origin, origin_airport_name, origin_city, origin_state_name, dest, dest_airport_name, "
        "dest_city, dest_state_name"
    ),
    "join_cancellation": _enriched("cancellation_code, cancellation_reason"),
    "join_delay_range": _enriched("arr_delay_minutes, delay_label"),
    "join_many_ranges": """
        select c_custkey, c_acctbal::double as balance, s_suppkey
        from customer left join (
            select s_suppkey, case when s_suppkey % 17 <> 0 then s_acctbal::double end as low,
                   case when s_suppkey % 19 <> 0
                        then s_acctbal::double + (s_suppkey % 13) * 7.25::double end as high
            from supplier
        ) on (low is null or c_acctbal::double >= low) and (high is null or c_acctbal::double <= high)""",
    "int_flights_enriched": "select * from int_flights_enriched",
    "departures_arrivals": (
        "select iata_code, total_departures, total_arrivals from mart_airport_performance"
    ),
    "mart_carrier_performance": "select * from mart_carrier_performance",
    "mart_airport_performance": "select * from mart_airport_performance",
    "mart_delay_analysis": "select * from mart_delay_analysis",
    "mart_route_analysis": "select * from mart_route_analysis",
    "on_time_rates": f"""
        select reporting_airline, {_percent(_count(_ON_TIME_DEP), "count(*)")} as departure,
               {_percent(_count(_ON_TIME_ARR), "count(*)")} as arrival,
               {_percent(_count("is_cancelled"), "count(*)")} as cancelled,
               {_count("is_diverted")} as diverted
        from int_flights_enriched group by reporting_airline""",
    "filtered_means": f"""
        select reporting_airline,
               {_mean("dep_delay_minutes", "dep_delay_minutes > 15")} as late_departure,
               {_mean("arr_delay_minutes", "arr_delay_minutes > 15")} as late_arrival,
               {_mean("arr_delay_minutes", "arr_delay_minutes > 0")} as any_arrival,
               {_mean("arr_delay_minutes", "true")} as all_arrival
        from int_flights_enriched group by reporting_airline""",
    "nonzero_component_means": f"""
        select reporting_airline,
               {_mean("carrier_delay", "carrier_delay <> 0")} as carrier_delay,
               {_mean("weather_delay", "weather_delay <> 0")} as weather_delay,
               {_mean("nas_delay", "nas_delay <> 0")} as nas_delay,
               {_mean("security_delay", "security_delay <> 0")} as security_delay,
               {_mean("late_aircraft_delay", "late_aircraft_delay <> 0")} as late_aircraft_delay
        from int_flights_enriched group by reporting_airline""",
    "carrier_delay_share": f"""
        select reporting_airline,
               {_percent(_minutes("carrier_delay"), _minutes("total_delay_minutes"))}
                 as pct_carrier_caused
        from int_flights_enriched group by reporting_airline""",
    "weather_nas_share": f"""
        select origin, {_percent(_count("weather_delay > 0"), "count(*)")} as weather,
               {_percent(_count("nas_delay > 0"), "count(*)")} as nas
        from int_flights_enriched group by origin""",
    "group_modes": """
        select origin, arg_min(dest, (-n, dest)) as top_destination
        from (select origin, dest, count(*) as n from int_flights_enriched group by all)
        group by origin""",
    "distinct_counts": """
        select origin, count(distinct route) as routes,
               count(distinct reporting_airline) as carriers
        from int_flights_enriched group by origin""",
    "rank_carrier_months": """
        select carrier_name, reporting_airline, flight_month, total_flights, total_flights_rank
        from mart_carrier_performance""",
    "rank_airports": """
        select iata_code, total_departures, airport_rank from mart_airport_performance""",
    "rank_routes": """
        select route, carrier_name, on_time_rate, route_reliability_rank
        from mart_route_analysis""",
    "share_of_total": f"""
        select route, flights, {_percent("flights", "sum(flights) over ()", 4)} as pct_of_total
        from (select route, count(*) as flights from int_flights_enriched group by route)""",
    "load_report": f"""
        select count(*) as total_rows, min(fl_date) as min_date, max(fl_date) as max_date,
               count(distinct reporting_airline) as unique_airlines,
               count(distinct origin) as unique_origins,
               {_count("cancelled = 1")} as total_cancelled,
               {_mean("arr_delay_minutes", "arr_delay_minutes > 0")} as avg_arr_delay_minutes,
               ifnull({_percent(_count("cancelled = 1"), "count(*)")}, 0) as cancellation_rate
        from flight_raw""",
    "date_span": """
        select count(*) as total_rows, min(fl_date) as min_date, max(fl_date) as max_date
        from flight_raw""",
    "headline_metrics": """
        select count(*) as total_flights, count(distinct reporting_airline) as airlines,
               count(distinct origin) as airports from flight_raw""",
    "carrier_leaderboard": """
        select carrier_name, reliability_score, total_flights, cancellation_rate
        from mart_carrier_performance""",
    "carriers_ascending": """
        select carrier_name, reliability_score, total_flights, cancellation_rate
        from mart_carrier_performance""",
    "delay_causes": """
        select primary_delay_cause, count(*) as flights from int_flights_enriched
        where primary_delay_cause <> 'None' group by primary_delay_cause""",
    "delay_cause_share": f"""
        select *, {_percent("flights", "sum(flights) over ()")} as share_pct
        from (select primary_delay_cause, count(*) as flights from int_flights_enriched
              where primary_delay_cause <> 'None' group by primary_delay_cause)""",
    "time_of_day": f"""
        select dep_time_period, {_mean_of_means("avg_arr_delay_minutes", 1)} as avg_delay
        from mart_delay_analysis group by dep_time_period""",
    "worst_routes": """
        select route, carrier_name, total_flights, on_time_rate, cancellation_rate
        from mart_route_analysis where total_flights >= 100
        order by on_time_rate asc nulls last, route nulls last, carrier_name nulls last,
                 total_flights, cancellation_rate
        limit 10""",
    "weekend_split": f"""
        select is_weekend, {_mean_of_means("avg_arr_delay_minutes", 1)} as avg_delay,
               sum(flight_count)::bigint as total_flights
        from mart_delay_analysis group by is_weekend""",
    "busiest_airports": """
        select iata_code, airport_name, total_departures, avg_departure_delay
        from mart_airport_performance
        order by total_departures desc, iata_code nulls last, airport_name nulls last
        limit 10""",
    "delayed_airports": """
        select iata_code, airport_name, total_departures, avg_departure_delay
        from mart_airport_performance where total_departures >= 500
        order by avg_departure_delay desc nulls last, iata_code nulls last,
                 airport_name nulls last
        limit 10""",
    "distance_delay": f"""
        select distance_bucket, {_mean_of_means("avg_arr_delay_minutes", 1)} as avg_delay,
               sum(flight_count)::bigint as total_flights
        from mart_delay_analysis group by distance_bucket""",
    "top_delayed_carriers": f"""
        select carrier_name, {_mean_of_means("avg_arr_delay_minutes", 2)} as avg_delay_min,
               sum(total_flights)::bigint as total_flights
        from mart_carrier_performance group by carrier_name
        order by avg_delay_min desc nulls last, carrier_name nulls last
        limit 5""",
    "most_cancelled_routes": """
        select route, cancellation_rate, total_flights from mart_route_analysis
        order by cancellation_rate desc nulls first, route nulls last, total_flights
        limit 10""",
    "cause_breakdown": f"""
        select primary_delay_cause, sum(flight_count)::bigint as occurrences,
               {_mean_of_means("avg_arr_delay_minutes", 2)} as avg_delay_min
        from mart_delay_analysis group by primary_delay_cause""",
    "busiest_by_rank": """
        select iata_code, airport_name, total_departures, airport_rank
        from mart_airport_performance
        order by airport_rank, iata_code nulls last, airport_name nulls last
        limit 10""",
    "check_unique": _UNION.join(_repeats(*pair) for pair in _UNIQUE),
    "check_not_null": _UNION.join(
        _violations("not_null", table, column, f"{column} is null")
        for table, columns in _NOT_NULL.items()
        for column in columns
    ),
    "check_accepted_values": _UNION.join(
        _violations("accepted_values", table, column, f"{column} not in ({values})")
        for table, column, values in _ACCEPTED
    ),
    "check_accepted_range": _UNION.join(
        _violations("accepted_range", table, column, f"{column} < {low} or {column} > {high}")
        for table, column, low, high in _RANGES
    ),
    "check_range_exclusive": _UNION.join(
        _violations("range_exclusive", table, column, f"{column} <= 0 or {column} >= 1500")
        for table, column in _EXCLUSIVE
    ),
    "check_valid_delays": _violations(
        "valid_delays",
        "stg_flights",
        "arr_delay_minutes",
        "greatest(arr_delay_minutes, dep_delay_minutes) > 1500",
    ),
    "check_positive_distance": _violations(
        "positive_distance", "stg_flights", "distance", "ifnull(distance, 0) <= 0 and cancelled = 0"
    ),
}


def _needed(sql: str) -> list[str]:
    """Names of the subqueries ``sql`` builds on, directly or not, in definition order."""
    found: set[str] = set()
    pending = [sql]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        new = (words & _CTES.keys()) - found
        found |= new
        pending += [_CTES[name] for name in new]
    return [name for name in _CTES if name in found]


# What each ordered report is sorted by; ties go by its columns from left to right, NULL last.
_ORDERS = {
    "carrier_leaderboard": (
        "reliability_score desc nulls first",
        ("carrier_name", "reliability_score", "total_flights", "cancellation_rate"),
    ),
    "carriers_ascending": (
        "reliability_score asc nulls last",
        ("carrier_name", "reliability_score", "total_flights", "cancellation_rate"),
    ),
    "delay_causes": ("flights desc", ("primary_delay_cause", "flights")),
    "time_of_day": ("avg_delay desc nulls first", ("dep_time_period", "avg_delay")),
    "worst_routes": (
        "on_time_rate asc nulls last",
        ("route", "carrier_name", "total_flights", "on_time_rate", "cancellation_rate"),
    ),
    "busiest_airports": (
        "total_departures desc",
        ("iata_code", "airport_name", "total_departures", "avg_departure_delay"),
    ),
    "delayed_airports": (
        "avg_departure_delay desc nulls last",
        ("iata_code", "airport_name", "total_departures", "avg_departure_delay"),
    ),
    "distance_delay": (
        "avg_delay desc nulls first", ("distance_bucket", "avg_delay", "total_flights"),
    ),
    "top_delayed_carriers": (
        "avg_delay_min desc nulls last", ("carrier_name", "avg_delay_min", "total_flights"),
    ),
    "most_cancelled_routes": (
        "cancellation_rate desc nulls first", ("route", "cancellation_rate", "total_flights"),
    ),
    "cause_breakdown": (
        "occurrences desc", ("primary_delay_cause", "occurrences", "avg_delay_min"),
    ),
    "busiest_by_rank": (
        "airport_rank asc", ("iata_code", "airport_name", "total_departures", "airport_rank"),
    ),
    "mart_carrier_performance": (
        "reliability_score desc nulls last", ("carrier_name", "reporting_airline", "flight_month"),
    ),
    "mart_airport_performance": (
        "total_departures desc nulls last", ("iata_code", "airport_name", "city", "state"),
    ),
    "mart_route_analysis": (
        "total_flights desc nulls last", ("route", "carrier_name", "distance_bucket"),
    ),
}


def _with_places(name: str) -> str:
    by, ties = _ORDERS[name]
    order = ", ".join([by, *(f"{column} asc nulls last" for column in ties)])
    return f"select *, row_number() over (order by {order})::int as place from ({_QUERIES[name]})"


_QUERIES |= {f"order_{name}": _with_places(name) for name in _ORDERS}


def oracle_sql() -> dict[str, str]:
    out = {}
    for query, sql in _QUERIES.items():
        ctes = ",\n".join(f"{name} as ({_CTES[name]})" for name in _needed(sql))
        out[query] = f"with {ctes}\n{sql}" if ctes else sql
    return out
