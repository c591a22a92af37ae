"""Dense row numbers from counts of two levels: no row is shuffled to be numbered.

The rows are written once with the number of their partition and their place in it. Counts of the
partitions, one short row each, become the number at which each partition starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_PLACE_BITS = 33


def placed(df: DataFrame, place: str) -> DataFrame:
    """Add where a row stands: its partition's number and its place there. Fixed once written."""
    return df.withColumn(place, F.monotonically_increasing_id())


def starts(df: DataFrame, place: str, first: int = 1) -> DataFrame:
    """One row for each partition of written rows: part, rows, and the number of its first row.

    There are as many rows as the writing job had tasks, which is why a single window may see all.
    """
    rows = df.groupBy(F.shiftright(place, _PLACE_BITS).alias("part")).agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.partitionBy().orderBy("part")) - F.col("rows")
    return rows.select("part", "rows", (before + F.lit(first)).cast("long").alias("start"))


def dense(df: DataFrame, place: str, number: str, first: int = 1) -> DataFrame:
    """Replace ``place`` of written rows by ``number``: first, first + 1, ... without a gap.

    Numbers follow the order of partitions and of rows in them.
    """
    part = F.shiftright(place, _PLACE_BITS)
    at = starts(df, place, first).select(F.col("part").alias("__part"), F.col("start").alias("__start"))
    numbered = df.join(F.broadcast(at), part == F.col("__part"))
    inside = F.col(place).bitwiseAND((1 << _PLACE_BITS) - 1)
    return numbered.withColumn(number, F.col("__start") + inside).drop(place, "__part", "__start")
