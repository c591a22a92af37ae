"""Flight-shaped raw tables derived from the test tables.

The expressions are read alike by Spark SQL and by DuckDB, so both sides of a
comparison start from the same rows. A tenth of the flights share one route, and a few
thousandths break a rule each: a repeated id (h = 993), no or zero distance (994, 995), and
minutes beyond any plausible delay (996, 997, the latter all of one unknown carrier).
"""

from __future__ import annotations

import itertools
import os
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skymart import schema
from skymart.cluster import shared_folder
from skymart.sources.warehouse import Warehouse

MISSING = "\\N"

_LINES = """
    select l_orderkey as ok, l_linenumber as ln, l_partkey as pk, l_suppkey as sk,
           l_shipdate as sd,
           case when l_partkey % 10 = 0 then 3 else s_nationkey end as sn,
           case when l_partkey % 10 = 0 then 8 else c_nationkey end as cn,
           (l_partkey * 7 + l_orderkey * 13 + l_linenumber * 31) % 1000 as h
    from {lineitem}
    join {orders} on l_orderkey = o_orderkey
    join {supplier} on l_suppkey = s_suppkey
    join {customer} on o_custkey = c_custkey
"""

_DELAYED = """
    select *,
           case when h < 25 then null when h < 600 then 0 when h = 997 then 1600
                else (pk * 11 + ok * 3) % 240 end as ad,
           case when h < 20 then null when h < 550 then 0 when h = 996 then 1700
                else (pk * 5 + ok * 7) % 200 end as dd
    from lines
"""

#: The columns of a flight, in the parts in which Spark derives them.
_PARTS = (
    """case when h = 993 then 993
           else ((ok * 8 + ln) * 100000 + pk) * 10000 + sk end as flight_id,
      cast(sd as date) as fl_date,
      case when h = 997 then 'AZ'
           else concat('A', chr(cast(65 + pk % 12 as int))) end as reporting_airline,
      concat('N', cast(sk as string)) as tail_number,
      cast(pk % 900 + 100 as string) as flight_number,
      cast(10000 + sn as int) as origin_airport_id,
      concat('P', lpad(cast(sn as string), 2, '0')) as origin,
      concat('City ', cast(sn as string)) as origin_city_name,
      concat('State ', cast(sn % 5 as string)) as origin_state""",
    """cast(10000 + cn as int) as dest_airport_id,
      concat('P', lpad(cast(cn as string), 2, '0')) as dest,
      concat('City ', cast(cn as string)) as dest_city_name,
      concat('State ', cast(cn % 5 as string)) as dest_state,
      case when h = 999 then null
           else cast((ok % 25) * 100 + pk % 60 as int) end as crs_dep_time,
      case when h >= 20 then cast((ok % 24) * 100 + pk % 60 as double) end as dep_time,
      cast(case when dd = 0 then 0 - pk % 10 else dd end as double) as dep_delay,
      cast(dd as double) as dep_delay_minutes""",
    """case when h >= 20 then cast(5 + pk % 20 as double) end as taxi_out,
      case when h >= 20 then cast((ok % 24) * 100 + (pk + 9) % 60 as double) end as wheels_off,
      case when h >= 25 then cast(((ok + 1) % 24) * 100 + pk % 60 as double) end as wheels_on,
      case when h >= 25 then cast(3 + pk % 9 as double) end as taxi_in,
      cast(((ok + 2) % 25) * 100 + pk % 60 as int) as crs_arr_time,
      case when h >= 25 then cast(((ok + 2) % 24) * 100 + pk % 60 as double) end as arr_time,
      cast(case when ad = 0 then 0 - pk % 20 else ad end as double) as arr_delay,
      cast(ad as double) as arr_delay_minutes,
      cast(case when h < 20 then 1 else 0 end as double) as cancelled,
      case when h < 20 then chr(cast(65 + ok % 4 as int)) end as cancellation_code,
      cast(case when h >= 20 and h < 25 then 1 else 0 end as double) as diverted""",
    """cast(60 + pk % 300 as double) as crs_elapsed_time,
      case when h >= 25 then cast(58 + pk % 310 as double) end as actual_elapsed_time,
      case when h >= 25 then cast(40 + pk % 280 as double) end as air_time,
      cast(case when h = 995 then 0 when h = 994 then null
           else ((sn * 37 + cn * 53) % 25) * 100 + 50 end as double) as distance""",
    """cast(case when ad >= 15 then case when ok % 6 = 0 then ad
           when ok % 6 = 1 then ad - ad % 7 else 0 end end as double) as carrier_delay,
      cast(case when ad >= 15 then case when ok % 6 = 2 then ad else 0 end end as double)
        as weather_delay,
      cast(case when ad >= 15 then case when ok % 6 = 3 then ad else 0 end end as double)
        as nas_delay,
      cast(case when ad >= 15 then case when ok % 6 = 4 then ad
           when ok % 6 = 1 then ad % 7 else 0 end end as double) as security_delay,
      cast(case when ad >= 15 then case when ok % 6 = 5 then ad else 0 end end as double)
        as late_aircraft_delay,
      sd as ingested_at,
      concat('flights_', cast(year(sd) as string), '_',
             lpad(cast(month(sd) as string), 2, '0'), '.csv') as source_file""",
)

_FLIGHTS = f"\n    select\n      {',\n      '.join(_PARTS)}\n    from delayed\n"

_AIRPORTS = """
    select
      cast(n_nationkey + 1 as int) as airport_id,
      case when n_nationkey = 24 then concat(chr(92), 'N')
           else concat(' P', lpad(cast(n_nationkey as string), 2, '0')) end as iata_code,
      case when n_nationkey % 3 = 0 then ''
           else concat('K', lpad(cast(n_nationkey as string), 3, '0')) end as icao_code,
      concat(n_name, ' Intl ') as airport_name,
      case when n_nationkey % 2 = 0
           then concat('City ', cast(n_nationkey as string), ', S', cast(n_regionkey as string))
           else concat('City ', cast(n_nationkey as string)) end as city,
      case when n_nationkey % 7 = 3 then 'Canada' else 'United States' end as country,
      cast(n_nationkey * 3123457 - 37500000 as double) / cast(1000000 as double) as latitude,
      cast(n_nationkey * 4123457 - 120000000 as double) / cast(1000000 as double) as longitude,
      cast(n_nationkey * 100 as double) as altitude,
      ' America/New_York ' as timezone,
      'A' as dst
    from {nation}
"""

_AIRLINES = """
    select
      cast(n_nationkey + 1 as int) as airline_id,
      case when n_nationkey = 11 then '  '
           when n_nationkey < 11 then concat('A', chr(cast(65 + n_nationkey as int)))
           else concat(' B', chr(cast(65 + n_nationkey as int))) end as iata_code,
      '' as icao_code,
      concat(' ', n_name, ' Air ') as airline_name,
      'United States' as country,
      case when n_nationkey in (14, 19, 24) then 'N' else 'Y' end as active
    from {nation}
"""

# name -> SQL over the test tables, in braces, and the names before it
CTES = {
    "lines": _LINES,
    "delayed": _DELAYED,
    "flight_raw": _FLIGHTS,
    "airport_raw": _AIRPORTS,
    "airline_raw": _AIRLINES,
}
TABLES = ("lineitem", "orders", "supplier", "customer", "nation")


#: lines, with one shuffle of lineitem: the customers' nations come to the orders first.
_LINES_OF_ORDERS = _LINES.replace(
    "join {orders} on l_orderkey = o_orderkey",
    "join (select o_orderkey, c_nationkey from {orders} join {customer} on o_custkey = c_custkey)"
    " on l_orderkey = o_orderkey",
).replace("    join {customer} on o_custkey = c_custkey\n", "")
#: More partitions than a table has, and what a flight is derived from.
_APART = 1_000_000
_USED = "ok, ln, pk, sk, sd, sn, cn, h, ad, dd"


def _files(sf_dir: str) -> dict[str, str]:
    return {table: f"parquet.`{sf_dir}/{table}.parquet`" for table in TABLES}


def _query(spark: SparkSession, sf_dir: str, name: str, *needed: str) -> DataFrame:
    files = _files(sf_dir)
    ctes = ", ".join(f"{cte} as ({CTES[cte].format(**files)})" for cte in (*needed, name))
    return spark.sql(f"with {ctes} select * from {name}")


def _loaded(df: DataFrame) -> DataFrame:
    return df.withColumn("ingested_at", F.expr("timestamp_ntz '2024-02-01 00:00:00'"))


def flight_raw(spark: SparkSession, sf_dir: str, once: bool = False) -> DataFrame:
    """The rows of CTES, with every order's customer looked up before its lines meet it.

    ``once`` joins and writes the lines now, for queries that read the flights several times.

    The columns are derived part by part. A coalesce() to more partitions than there are moves no row
    and keeps the parts from becoming one method, which would be too long for the JVM to compile.
    """
    lines = _LINES_OF_ORDERS.format(**_files(sf_dir))
    if once:
        folder = _folder(spark, "lines")
        spark.sql(lines).write.parquet(folder)
        lines = f"select * from parquet.`{folder}`"
    steps, last = [f"lines as ({lines})", f"delayed as ({CTES['delayed']})"], "delayed"
    for number, part in enumerate(_PARTS):
        steps.append(f"part_{number} as (select /*+ coalesce({_APART}) */ *, {part} from {last})")
        last = f"part_{number}"
    return spark.sql(f"with {', '.join(steps)} select * except ({_USED}) from {last}")


def airport_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(_query(spark, sf_dir, "airport_raw"))


def airline_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(_query(spark, sf_dir, "airline_raw"))


#: What a flight's file lacks, by its layout: the last third of the months has no such columns.
LACKING = ("air_time", "taxi_out")
LAYOUTS = 3
#: Values that do not parse or are too long: column, value, and the flights (of flight_id) with it.
PLANTED = (
    ("fl_date", "some day", 97),
    ("distance", "far", 89),
    ("arr_delay", "NaN", 83),
    ("crs_dep_time", "905.5", 79),
    ("cancelled", "1.0 or so", 61),
    ("tail_number", "N" + "1" * 24, 73),
    ("reporting_airline", "AAAAAAAAAAA", 71),
)


def _text(name: str, planted: bool) -> Column:
    text = F.col(name).cast("string")
    for column, value, every in PLANTED if planted else ():
        if column == name:
            text = F.when(F.col("flight_id") % every == 0, F.lit(value)).otherwise(text)
    return text


def flight_files(spark: SparkSession, sf_dir: str, planted: bool = False) -> list[str]:
    """The flights as CSV files in the shared folder, in three layouts by month.

    Plain headers; headers with endings, a second Origin and an unnamed column behind the others;
    other places and fewer columns. With ``planted`` some values do not parse or are too long.
    """
    folder = _folder(spark, "flights")
    flights = flight_raw(spark, sf_dir, once=True).withColumn("_layout", F.month("fl_date") % LAYOUTS)
    for layout in range(LAYOUTS):
        fields = [f for f in schema.FLIGHT_FIELDS if layout < 2 or f.name not in LACKING]
        ending = "_m1" if layout == 1 else ""
        columns = [_text(f.name, planted).alias(f.header + ending) for f in fields]
        if layout == 1:
            columns += [F.lit("XX").alias("Origin_m2"), F.lit("x").alias("Unnamed: 40")]
        if layout == 2:
            columns.reverse()
        own = flights.filter(F.col("_layout") == layout).select(*columns)
        own.write.csv(f"{folder}/{layout}", header=True, escape='"')
    return [f"{folder}/{layout}" for layout in range(LAYOUTS)]


def zipped_flight_files(spark: SparkSession, sf_dir: str) -> str:
    """The flights as zipped CSV files, one archive for each task; their number follows the rows."""
    folder = _folder(spark, "zipped")
    titles = ",".join(f.header + "_m1" for f in schema.FLIGHT_FIELDS)
    line = F.to_csv(F.struct(*[F.col(f.name) for f in schema.FLIGHT_FIELDS]), {"escape": '"'})
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    lines = flight_raw(spark, sf_dir).repartition(max(ARCHIVES, -(-rows // ARCHIVE_ROWS))).select(
        line.alias("line"), F.spark_partition_id().alias("part")
    )
    place = folder.removeprefix("file:")
    os.makedirs(place)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        part = first.column("part")[0].as_py()
        with (
            zipfile.ZipFile(f"{place}/.{part}", "w", zipfile.ZIP_DEFLATED) as archive,
            archive.open("flights.csv", "w", force_zip64=True) as member,
        ):
            member.write(f"{titles}\n".encode())
            for batch in itertools.chain([first], batches):
                member.write("".join(f"{x}\n" for x in batch.column("line").to_pylist()).encode())
        os.replace(f"{place}/.{part}", f"{place}/flights_{part}.zip")
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32())})

    lines.mapInArrow(write, "part int").collect()
    return folder


#: Archives at least, and rows of lineitem for each.
ARCHIVES, ARCHIVE_ROWS = 6, 500_000


def stored_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flights without ids, joined and written once for the loads that read them by month."""
    folder = _folder(spark, "raw")
    flight_raw(spark, sf_dir).drop("flight_id").write.parquet(folder)
    return spark.read.parquet(folder)


def warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(spark, _folder(spark, "warehouse"))


def lookup_file(spark: SparkSession, raw: DataFrame, columns: tuple[str, ...]) -> str:
    """A lookup as lines of quoted fields without a header; fields it lacks are missing marks."""
    folder = _folder(spark, "lookup")
    fields = [
        F.coalesce(F.col(c).cast("string"), F.lit(MISSING)) if c in raw.columns else F.lit(MISSING)
        for c in columns
    ]
    quoted = [F.concat(F.lit('"'), F.replace(f, F.lit('"'), F.lit('""')), F.lit('"')) for f in fields]
    raw.select(F.concat_ws(",", *quoted).alias("value")).write.text(folder)
    return folder


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
