"""Headerless airport and airline ``.dat`` files with fields by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skymart import schema
from skymart.sources.flight_files import utc_now

_QUOTED = r'"(?:\\.|[^"\\])*"'


def read_positional(spark: SparkSession, paths: list[str], columns: tuple[str, ...]) -> DataFrame:
    """Rows with the given columns as text; lines with more fields than that are dropped.

    Short lines end in NULLs. Fields are counted outside of quotes, so that a trailing
    empty field counts too.
    """
    line = F.col("value")
    fields = F.size(F.split(F.regexp_replace(line, _QUOTED, ""), ","))
    layout = ", ".join(f"{name} string" for name in columns)
    # A quote inside quotes is written as \" or as a doubled quote.
    doubled = F.contains(line, F.lit('""')) & ~F.contains(line, F.lit('\\"'))
    row = F.when(doubled, F.from_csv(line, layout, {"escape": '"'})).otherwise(
        F.from_csv(line, layout)
    )
    return (
        spark.read.text(paths)
        .filter((F.trim(line) != "") & (fields <= len(columns)))
        .select(row.alias("row"))
        .select("row.*")
    )


def clean_code(code: Column) -> Column:
    """Without white space at either end; the missing mark becomes NULL."""
    return F.nullif(F.regexp_replace(code, r"^\s+|\s+$", ""), F.lit("\\N"))


def _typed(rows: DataFrame, fields: tuple[schema.Field, ...]) -> DataFrame:
    def column(field: schema.Field) -> Column:
        text = F.col(field.name)
        return text if field.type == "string" else text.try_cast(field.type)

    return rows.select(*[column(f).alias(f.name) for f in fields], utc_now().alias("ingested_at"))


def read_airports(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Airports with a code of three characters."""
    rows = read_positional(spark, paths, schema.AIRPORT_FILE_COLUMNS)
    rows = rows.withColumn("iata_code", clean_code(F.col("iata_code")))
    return _typed(rows.filter(F.length("iata_code") == 3), schema.AIRPORT_FIELDS)


def read_airlines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Active airlines with a code."""
    rows = read_positional(spark, paths, schema.AIRLINE_FILE_COLUMNS)
    rows = rows.withColumn("iata_code", clean_code(F.col("iata_code")))
    kept = rows.filter(F.col("iata_code").isNotNull() & (F.col("active") == "Y"))
    return _typed(kept, schema.AIRLINE_FIELDS)
