"""Lookups give the same rows whether or not a key is dealt over tasks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from skymart.operators import skew


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot_rows", [skew.HOT_ROWS, 20])
def test_salted_lookup_equals_a_join(spark, monkeypatch, how, hot_rows):
    monkeypatch.setattr(skew, "HOT_ROWS", hot_rows)
    key = F.when(F.col("n") % 3 == 0, 7).when(F.col("n") % 11 == 0, None).otherwise(F.col("n") % 50)
    rows = spark.range(900).select(F.col("id").alias("n")).withColumn("key", key.cast("long"))
    table = spark.range(40).select(F.col("id").alias("of"), (F.col("id") * 2).alias("value"))
    heated = skew.heat(rows, "key")
    if hot_rows == 20:
        assert heated.rows == rows.filter("key is not null").count()
        assert heated.hottest == rows.filter("key = 7").count() > heated.most()
    found = skew.salted_lookup(rows, heated, table, "key", "of", F.col("n"), how)
    expected = rows.join(table, F.col("key") == F.col("of"), how).drop("of")
    assert found.columns == expected.columns
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))


def test_hot_keys_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 100)
    rows = spark.range(5000).select(F.col("id").alias("n"), F.lit(7).cast("long").alias("key"))
    table = spark.range(10).select(F.col("id").alias("of"), F.col("id").alias("value"))
    found = skew.salted_lookup(rows, skew.heat(rows, "key"), table, "key", "of", F.col("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = found.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(parts) > 1 and sum(r["count"] for r in parts) == 5000
