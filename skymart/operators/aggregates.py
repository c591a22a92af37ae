"""Aggregates that stay distributed when the data or one group grows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skymart.functions import exact
from skymart.functions.flights import first_match


def most_frequent(value: str, count: str) -> Column:
    """Aggregate over (value, count) rows: the value with the highest count.

    The lowest value wins a tie and NULL never wins. Together with a preceding count per
    group and value it is a mode whose partial results are counts, not rows.
    """
    best = F.min(F.when(F.col(value).isNotNull(), F.struct(-F.col(count), F.col(value))))
    return best[value]


def most_frequent_of(counts: dict[str, Column]) -> Column:
    """Mode over a closed set of labels, given the count of each; the lowest label wins a tie."""
    top = F.greatest(*counts.values())
    return first_match([(~(top > 0), None), *((counts[v] == top, v) for v in sorted(counts))])


def global_rank(df: DataFrame, by: str, rank: str) -> DataFrame:
    """rank() over (order by ``by`` desc nulls first) without one task sorting all rows.

    Ties share a rank and leave a gap. Only the distinct values of ``by`` are ordered in
    one task: at most 10,001 for a percentage with two decimals; for group sizes over N
    facts at most sqrt(2 N), since distinct sizes must sum to N or less. Both sides of the join
    read the one shuffle of the aggregate in ``df``.
    """
    sizes = df.groupBy(F.col(by).alias("_value")).agg(exact.row_count().alias("_rows"))
    ahead = Window.orderBy(F.desc_nulls_first("_value")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    ranks = sizes.select(
        "_value", (F.coalesce(F.sum("_rows").over(ahead), F.lit(0)) + 1).cast("int").alias(rank)
    )
    return df.join(ranks, F.col(by).eqNullSafe(F.col("_value"))).drop("_value")


def share_of_total(df: DataFrame, count: str, of: DataFrame, share: str, scale: int) -> DataFrame:
    """Percentage of each row's ``count`` in the number of rows of ``of``.

    The total is a scalar subquery over the rows that were counted; from stored parquet
    it reads no column, and no window gathers ``df`` in one task.
    """
    total = of.agg(exact.row_count()).scalar()
    return df.withColumn(share, exact.percent(F.col(count), total, scale))
