"""Lookups whose hot keys are dealt over many tasks."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot from this part of all rows on, so that fewer keys than that are hot; and from so
#: many rows on, below which one task may take them.
HOT_PART, HOT_ROWS = 1000, 10_000


class Heat(NamedTuple):
    """How many rows have a key, and how many have the most frequent one."""

    rows: int
    hottest: int

    def most(self) -> float:
        return max(self.rows / HOT_PART, HOT_ROWS)


def _counts(rows: DataFrame, key: str) -> DataFrame:
    keyed = rows.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key"))
    return keyed.agg(F.count("*").alias("__n"))


def heat(rows: DataFrame, key: str) -> Heat:
    few = rows.filter(F.col(key).isNotNull()).limit(HOT_ROWS + 1).count()
    if few <= HOT_ROWS:
        return Heat(few, few)
    found = _counts(rows, key).agg(F.sum("__n").alias("rows"), F.max("__n").alias("hottest")).first()
    return Heat(found.rows or 0, found.hottest or 0)


def salted_lookup(
    rows: DataFrame,
    heated: Heat,
    table: DataFrame,
    key: str,
    table_key: str,
    spread: Column,
    how: str = "inner",
) -> DataFrame:
    """``rows`` joined with ``table`` on ``key`` == ``table_key``, which is then dropped.

    Keys of the table are unique. A key with more than ``heated.most()`` rows is dealt over several
    tasks by ``spread``, a number of each row, and the table's row is repeated for them; there are
    fewer than HOT_PART such keys, so that they can be broadcast. Without one it is a plain join.
    """
    on = F.col(key) == F.col(table_key)
    every = heated.most()
    if heated.hottest <= every:
        return rows.join(table, on, how).drop(table_key)
    hot = _counts(rows, key).filter(F.col("__n") > every)
    hot = F.broadcast(hot.select("__key", F.ceil(F.col("__n") / every).cast("int").alias("__splits")))
    left = rows.join(hot, F.col(key) == F.col("__key"), "left")
    salt = F.coalesce(F.pmod(spread, F.col("__splits")), F.lit(0)).cast("int")
    left = left.withColumn("__salt", salt).drop("__key", "__splits")
    right = table.join(hot, F.col(table_key) == F.col("__key"), "left")
    last = F.coalesce(F.col("__splits") - 1, F.lit(0))
    right = right.withColumn("__copy", F.explode(F.sequence(F.lit(0), last)))
    right = right.drop("__key", "__splits")
    joined = left.join(right, on & (F.col("__salt") == F.col("__copy")), how)
    return joined.drop(table_key, "__copy", "__salt")
