"""Left outer lookups of a large fact table in a dimension table.

A dimension is broadcast only after its row count was found to be within a bound.
Beyond the bound the equi lookup is a plain join, which Spark shuffles and whose hot
keys adaptive execution splits, and the range lookup becomes equi joins: distinct values meet the
ranges in bins that are as wide as the range, then facts meet their value. Where that would make
more than PAIRS pairs of a value and a range, they are not written: facts in the order of their values are
cut into slices, a range is copied to the slices it meets, and the rows come straight from their join.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from skymart.cluster import settle

BROADCAST_ROWS = 200_000
BROADCAST_RANGES = 64
#: A range lies in bins of the width BIN_WIDTH * BIN_GROWTH**n that make it touch few of them.
BIN_WIDTH = 60
BIN_GROWTH = 8
#: Bins reach so far; what lies beyond, infinity too, falls into the last ones.
_FARTHEST = 1e300
#: Distinct values and ranges of one bin, multiplied and summed over bins, up to which pairs are written.
PAIRS = 20_000_000
#: Facts of a slice, and of its ranges how many meet them in one cell.
CELL_FACTS, CELL_RANGES = 8192, 16384
#: Facts and ranges that meet at once; a cell has some dozens of either.
PACKET, BLOCK = 512, 512
#: Slices that one task sorts, and tasks at most.
_SORTED, _TASKS = 8, 4096
#: More partitions than a join has: such a coalesce() moves no row and ends a compiled stage, which
#: would otherwise hold all rows that come of one row of the join.
_APART = 1_000_000


def within(df: DataFrame, rows: int) -> bool:
    """True if ``df`` has at most ``rows`` rows; reads no more than that plus one."""
    return df.limit(rows + 1).count() <= rows


def equi_lookup(
    facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, small: bool
) -> DataFrame:
    """Left outer join that keeps every fact; a repeated dimension key repeats the fact.

    ``dim`` must share no column name with ``facts``; ``dim_key`` is dropped.
    """
    side = F.broadcast(dim) if small else dim
    return facts.join(side, F.col(fact_key) == F.col(dim_key), "left").drop(dim_key)


def range_lookup(
    facts: DataFrame,
    ranges: DataFrame,
    value: str,
    low: str,
    high: str,
    max_broadcast: int = BROADCAST_RANGES,
    bin_width: int = BIN_WIDTH,
    max_pairs: int = PAIRS,
) -> DataFrame:
    """Left outer join on ``value`` between ``low`` and ``high``, both ends included.

    A null bound is an open end. Overlapping ranges repeat the fact; a value in no range, a null
    or NaN gets NULLs. Many ranges are put, each with its width's bins, into at most BIN_GROWTH + 1
    bins whatever their width; each distinct value looks into its bin of every width that occurs.
    Bins only find candidates: values meet the bounds as they are.
    """

    def meets(column: str) -> Column:
        own = F.col(column)
        above = own >= F.coalesce(F.col(low), own)
        return above & (own <= F.coalesce(F.col(high), own)) & ~F.isnan(own.cast("double"))

    def finite(column: Column) -> Column:
        near = F.greatest(F.least(column.cast("double"), F.lit(_FARTHEST)), F.lit(-_FARTHEST))
        return F.when(column.isNotNull(), near)

    if within(ranges, max_broadcast):
        return facts.join(F.broadcast(ranges), meets(value), "left").drop(low, high)

    values = facts.groupBy(F.col(value).alias("_value")).agg(F.count("*").alias("_facts"))
    values = settle(values.filter(~F.isnan(F.col("_value").cast("double"))))
    at = finite(F.col("_value"))
    ends = values.agg(F.min(at).alias("least"), F.max(at).alias("most"), F.sum("_facts").alias("facts")).first()
    # No range needs bins beyond the values; so an open or endless one has few.
    least, most = (F.lit(x if x is not None else 0.0) for x in (ends.least, ends.most))
    begin = F.greatest(F.coalesce(finite(F.col(low)), least), least)
    end = F.least(F.coalesce(finite(F.col(high)), most), most)
    widest = (F.col("_end") - F.col("_begin")) / bin_width
    level = F.ceil(F.log(float(BIN_GROWTH), F.greatest(widest, F.lit(1.0))))

    def bin_of(column: Column) -> Column:
        width = F.lit(float(bin_width)) * F.pow(F.lit(float(BIN_GROWTH)), F.col("_level"))
        return F.floor(column / width)

    met = ranges.withColumns({"_begin": begin, "_end": end}).filter("_begin <= _end")
    met = settle(met.withColumn("_level", level).withColumn("_range", F.monotonically_increasing_id()))
    binned = met.withColumn("_bin", F.explode(F.sequence(bin_of(F.col("_begin")), bin_of(F.col("_end")))))
    binned = binned.drop("_begin", "_end")
    levels = [r["_level"] for r in met.select("_level").distinct().collect()]
    every = F.array(*map(F.lit, levels)).cast("array<long>")

    def probed(rows: DataFrame, column: str) -> DataFrame:
        near = finite(F.col(column))
        return rows.withColumn("_level", F.explode(every)).withColumn("_bin", bin_of(near))

    keys = ["_level", "_bin"]
    probes = probed(values.drop("_facts"), "_value")
    crowds = probes.groupBy(*keys).agg(F.count("*").alias("_values"))
    crowds = crowds.join(binned.groupBy(*keys).agg(F.count("*").alias("_ranges")), keys)
    pairs = crowds.agg(F.sum(F.col("_values").cast("double") * F.col("_ranges"))).first()[0] or 0
    if pairs <= max_pairs:
        found = probes.join(binned.drop("_range"), keys).filter(meets("_value"))
        found = settle(found.drop(*keys, low, high))
        if within(found, BROADCAST_ROWS):
            found = F.broadcast(found)
        return facts.join(found, F.col(value) == F.col("_value"), "left").drop("_value")
    return _in_slices(facts, met.drop("_begin", "_end", "_level", "_range"), value, low, high, ends.facts)


def _in_slices(
    facts: DataFrame, ranges: DataFrame, value: str, low: str, high: str, number: int
) -> DataFrame:
    """The rows of range_lookup, of which there may be far more than could be written.

    Each of the ``number`` facts is dealt to one slice. A range is copied to the slices it meets; but for its
    first and last one it finds all facts there, so copies are few beside the rows they make. In a slice,
    arrays of facts and of ranges meet, and become rows only behind their join.
    """
    fact, span = F.col("_fact"), F.col("_range")
    own = F.col(f"_fact.{value}")
    if not isinstance(facts.select(value).schema[0].dataType, T.NumericType):
        own = own.cast("double")

    def reaches(end: Column, to: Column) -> Column:
        """An open end reaches everything."""
        return F.coalesce(end <= to, F.lit(True))

    hashed = [F.col(f.name) for f in facts.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    known = F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))
    rows = facts.filter(known).select(F.struct("*").alias("_fact"), F.xxhash64(*hashed).alias("_mixed"))
    rows = rows.repartitionByRange(min(math.ceil(number / (_SORTED * CELL_FACTS)), _TASKS), own, "_mixed")
    rows = rows.sortWithinPartitions(own, "_mixed").select("_fact", F.monotonically_increasing_id().alias("_at"))
    sliced = settle(rows).withColumn("_slice", F.expr(f"_at div {CELL_FACTS}"))

    slices = settle(sliced.groupBy("_slice").agg(F.min(own).alias("_least"), F.max(own).alias("_most")))
    jumps = [1 << n for n in reversed(range(slices.count().bit_length()))]
    slices = slices.agg(F.sort_array(F.collect_list(F.struct("_slice", "_least", "_most"))).alias("_slices"))

    def first_ones(holds: Callable[[Column], Column]) -> Column:
        """How many slices ``holds`` is true of; they come before all others."""
        step = lambda n, jump: F.when(holds(F.get("_slices", n + jump - 1)), n + jump).otherwise(n)
        return F.aggregate(F.array(*map(F.lit, jumps)), F.lit(0), step)

    low_end, high_end = span[low], span[high]
    before = first_ones(lambda s: s["_most"] < low_end)
    until = first_ones(lambda s: (s["_least"] <= high_end) | (high_end.isNull() & s["_least"].isNotNull()))
    laid = ranges.select(F.struct("*").alias("_range"), F.monotonically_increasing_id().alias("_mixed"))
    laid = laid.crossJoin(F.broadcast(slices)).withColumns({"_before": before, "_until": until})
    met = F.slice("_slices", F.col("_before") + 1, F.greatest(F.col("_until") - F.col("_before"), F.lit(0)))
    laid = laid.select("_range", "_mixed", F.posexplode(met).alias("_place", "_met"))
    laid = laid.select("_range", "_mixed", "_place", F.col("_met._slice").alias("_slice"))

    counts = laid.groupBy("_slice").agg(F.count("*").alias("_ranges"))
    cut = settle(counts.select("_slice", "_ranges", F.ceil(F.col("_ranges") / CELL_RANGES).alias("_parts")))
    cells = min(max(1, cut.agg(F.sum("_parts")).first()[0] or 0), _TASKS)
    cut = F.broadcast(cut) if within(cut, BROADCAST_ROWS) else cut
    cell = ["_slice", "_part"]

    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))
    packets = sliced.join(cut, "_slice").withColumn("_part", parts).repartition(cells, *cell)
    packets = packets.groupBy(*cell, F.expr(f"_at div {PACKET}").alias("_packet")).agg(
        F.min(own).alias("_least"), F.max(own).alias("_most"), F.collect_list("_fact").alias("_facts")
    )
    blocks = F.col("_parts") * F.ceil(F.col("_ranges") / F.col("_parts") / BLOCK)
    blocks = laid.join(cut, "_slice").withColumn("_block", F.pmod(F.xxhash64("_mixed"), blocks))
    blocks = blocks.withColumn("_part", F.pmod("_block", "_parts")).repartition(cells, *cell)
    blocks = blocks.groupBy(*cell, "_block").agg(F.collect_list("_range").alias("_ranges"))
    near = F.filter("_ranges", lambda r: reaches(r[low], F.col("_most")) & reaches(F.col("_least"), r[high]))
    found = packets.join(blocks, cell).select("_facts", near.alias("_near")).filter(F.size("_near") > 0)
    found = found.coalesce(_APART).select(F.explode("_facts").alias("_fact"), "_near")
    found = found.coalesce(_APART).select("_fact", F.explode("_near").alias("_range"))
    others = [f for f in ranges.schema.fields if f.name not in (low, high)]
    found = found.filter(reaches(span[low], own) & reaches(own, span[high]))
    found = found.select("_fact.*", *[span[f.name].alias(f.name) for f in others])

    # A fact is alone if no range that begins before it in its slice, or in slices before, reaches it.
    end = F.struct(span[high].isNull().alias("open"), span[high].alias("high"))
    begun = laid.select("_slice", F.when(F.col("_place") == 0, span[low]).alias("_from"), end.alias("_end"))
    begun = begun.groupBy("_slice", "_from").agg(F.max("_end").alias("_end"))
    events = sliced.select("_slice", own.alias("_from"), "_fact").unionByName(begun, allowMissingColumns=True)
    so_far = Window.partitionBy("_slice").orderBy("_from", fact.isNotNull())
    events = events.withColumn("_reach", F.max("_end").over(so_far.rowsBetween(Window.unboundedPreceding, 0)))
    reach = F.col("_reach")
    held = F.coalesce(reach["open"] | (reach["high"] >= own), F.lit(False))
    alone = events.filter(fact.isNotNull() & ~held).select("_fact.*").union(facts.filter(~F.coalesce(known, F.lit(False))))
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in others]
    return found.union(alone.select("*", *nulls))
