"""Connected components by contraction, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skymart.cluster import settle

#: Rows of labels and links are so narrow against documents that a partition takes several times more.
NARROW = 4


def settle_narrow(df: DataFrame) -> DataFrame:
    """settle() into fewer partitions, so that each shuffle of the rows leaves fewer files."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return settle(df.coalesce(max(2, partitions // NARROW)))


def contracted(
    labels: DataFrame, links: DataFrame, waiting: DataFrame | None
) -> tuple[DataFrame, DataFrame]:
    """One round: labels (node, label) after joining linked ones, and the links still waiting.

    links has nodes a and b, waiting has labels u and v from earlier rounds. Every label takes the
    smallest among its own and its neighbours'; links are then moved to the new labels, and those
    within one label vanish. At least half the labels of a component go in two rounds.
    """
    ends = labels.select(F.col("node").alias("a"), F.col("label").alias("u"))
    edges = links.join(ends, "a").select("b", "u")
    ends = ends.withColumnsRenamed({"a": "b", "u": "v"})
    edges = edges.join(ends, "b").filter("u <> v").select("u", "v")
    edges = edges.union(waiting) if waiting is not None else edges
    return _round(labels, settle_narrow(edges.distinct()))


def _round(labels: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    parents = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("parent"))
    moved = labels.join(parents, labels["label"] == parents["u"], "left")
    up = parents.select("u", F.col("parent").alias("p"))
    vp = parents.select(F.col("u").alias("v"), F.col("parent").alias("q"))
    left = edges.join(up, "u").join(vp, "v").filter("p <> q")
    left = left.select(F.col("p").alias("u"), F.col("q").alias("v")).distinct()
    labels = moved.select("node", F.coalesce("parent", "label").alias("label"))
    return settle_narrow(labels), settle_narrow(left)


def merged(labels: DataFrame, waiting: DataFrame) -> DataFrame:
    """labels when no link waits: the label of a component is the smallest of its labels."""
    while not waiting.isEmpty():
        labels, waiting = _round(labels, waiting)
    return labels
