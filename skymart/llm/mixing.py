"""Mixing sources to target weights by proportionate-fair (Pfair) scheduling.

The rows of a source are cut into blocks. Slots are filled one block at a time in periods: a
period holds, of every source, as many blocks as its integer share (its last blocks, if fewer are
left). A source with m of a period's P blocks has the weight m / P; its i-th block (from 0) is
released at slot floor(i P / m) of the period and due before slot ceil((i + 1) P / m). Each slot
goes to the released block with the earliest deadline. As the weights add up to 1, every slot is
filled and every deadline met, so at every slot each source has had its weight of the slots, give
or take less than one block.

Only the slots of the distinct periods are computed (at most two more than twice the number of
sources, as a period changes only where a source ends); a block's slot follows from its number.
Everything is DataFrame functions; rows are numbered by two levels of counts, never by one task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skymart.llm.arrow import fresh, named

#: Rows of a block.
BLOCK_ROWS = 16
#: Blocks of a period over all sources, when shares follow from the sizes of the sources.
PERIOD = 400
#: Without given shares, a source's weight is its number of rows to this power.
EXPONENT = 0.7
#: Parts of a source in which its rows are numbered.
PART_BITS = 12


def _down(a: Column, b: Column) -> Column:
    """a / b rounded down, of whole numbers from 0, exactly."""
    return F.call_function("div", a, b)


def _up(a: Column, b: Column) -> Column:
    return _down(a + b - 1, b)


def _numbered(rows: DataFrame) -> DataFrame:
    """rows with `number`, from 0 within their source, in the order of their hash."""
    hashed = rows.withColumn("hash", F.shiftrightunsigned(F.xxhash64("doc_id"), 1))
    hashed = hashed.withColumn("part", F.shiftright("hash", 63 - PART_BITS).cast("int"))
    counts = hashed.groupBy("source", "part").agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("earlier", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    counts = counts.select(
        F.col("source").alias("own_source"), F.col("part").alias("own_part"), "earlier"
    )
    inside = Window.partitionBy("source", "part").orderBy("hash", "doc_id", "content")
    ranked = hashed.withColumn("inside", F.row_number().over(inside) - 1)
    same = F.col("source").eqNullSafe(F.col("own_source")) & (F.col("part") == F.col("own_part"))
    return ranked.join(counts, same).select(
        *rows.columns, (F.col("earlier") + F.col("inside")).alias("number")
    )


def _sources(rows: DataFrame, shares: Mapping[str, int] | None) -> DataFrame:
    """source, blocks, share, sources (of all, sorted) and turns: where a period's members change.

    turns are the numbers of the first of equal periods.
    """
    sizes = rows.groupBy("source").agg(F.count("*").alias("rows"))
    blocks = F.ceil(F.col("rows") / BLOCK_ROWS).alias("blocks")
    if shares is not None:
        if any(s < 1 for s in shares.values()):
            raise ValueError("shares are whole numbers from 1")
        given = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair]) if shares else None
        own = F.element_at(given, F.col("source")) if given is not None else F.lit(None)
        share = F.coalesce(own, F.lit(1)).cast("long")
    else:
        weight = F.pow(F.col("rows").cast("double"), F.lit(EXPONENT))
        whole = F.sum(weight).over(Window.partitionBy())
        share = F.greatest(F.lit(1), F.round(weight * PERIOD / whole)).cast("long")
    sized = sizes.select("source", blocks, share.alias("share"))
    everyone = F.collect_list(F.struct("source", "blocks", "share")).over(Window.partitionBy())
    sized = sized.withColumn("sources", F.array_sort(everyone))
    full = F.transform("sources", lambda s: F.floor(s["blocks"] / s["share"]))
    turns = F.concat(F.array(F.lit(0).cast("long")), full, F.transform(full, lambda k: k + 1))
    return sized.withColumn("turns", F.array_sort(F.array_distinct(turns)))


def _periods(sources: DataFrame) -> DataFrame:
    """One row for each distinct period: first (its number), begins (its first slot), members.

    members is the sorted array of the sources with blocks in it: source, blocks.
    """
    one = sources.filter(F.col("source").eqNullSafe(F.col("sources")[0]["source"]))
    each = one.select("sources", F.explode("turns").alias("first"))
    left = F.transform(
        "sources",
        lambda s: F.struct(
            s["source"].alias("source"),
            F.greatest(
                F.least(s["blocks"] - F.col("first") * s["share"], s["share"]), F.lit(0)
            ).alias("blocks"),
        ),
    )
    begins = F.aggregate(
        "sources",
        F.lit(0).cast("long"),
        lambda total, s: total + F.least(s["blocks"], F.col("first") * s["share"]),
    )
    return each.select(
        "first",
        begins.alias("begins"),
        F.filter(left, lambda m: m["blocks"] > 0).alias("members"),
    ).filter(F.size("members") > 0)


def _slots(periods: DataFrame) -> DataFrame:
    """Which slot of its period each block of a source gets: one row for first, source and turn.

    size is the period's number of blocks and of_source those of the source.
    """
    size = F.aggregate("members", F.lit(0).cast("long"), lambda n, m: n + m["blocks"])
    periods = periods.withColumn("size", size)
    whole = F.col("size")

    def choose(state: Column, slot: Column) -> Column:
        def option(member: Column, place: Column) -> Column:
            done = F.element_at(state["done"], place + 1)
            blocks = member["blocks"]
            released = (done < blocks) & (_down(done * whole, blocks) <= slot)
            due = _up((done + 1) * whole, blocks)
            return F.when(released, F.struct(due.alias("due"), place.alias("place")))

        best = F.array_min(F.transform(F.col("members"), option))["place"]
        return F.struct(
            F.transform(
                state["done"], lambda d, i: F.when(i == best, d + 1).otherwise(d)
            ).alias("done"),
            F.concat(state["order"], F.array(best)).alias("order"),
        )

    nothing = F.transform("members", lambda m: F.lit(0).cast("long"))
    begin = F.struct(nothing.alias("done"), F.array().cast("array<int>").alias("order"))
    order = F.aggregate(
        F.sequence(F.lit(0).cast("long"), F.col("size") - 1), begin, choose, lambda s: s["order"]
    )
    filled = periods.select(
        "first", "begins", "size", "members", F.posexplode(order).alias("slot", "place")
    )
    turn = F.row_number().over(Window.partitionBy("first", "place").orderBy("slot")) - 1
    member = F.element_at("members", F.col("place") + 1)
    return filled.select(
        "first",
        "begins",
        "size",
        "slot",
        turn.cast("long").alias("turn"),
        member["source"].alias("of"),
        member["blocks"].alias("of_source"),
    )


def schedule(docs: DataFrame, shares: Mapping[str, int] | None = None) -> DataFrame:
    """doc_id, source, content, block, release, deadline, slot, place of every row of docs.

    Every row is kept once. slot is its block's place among all blocks, in [release, deadline),
    and place its own in the block; content is a hash of the text. Rows of a source are taken in the order of their hashed
    doc_id. shares gives whole numbers of blocks a period for sources; others have 1. Without it
    a source's share is its part of PERIOD by its size to the power of EXPONENT, at least 1.

    A null source is a source of its own; a null doc_id is ordered like any other. Rows with one
    doc_id follow each other, and equal rows are interchangeable. Once a source has ended, the
    weights of a period are those of the others. No rows give none.
    """
    kept = set(docs.columns)
    content = F.xxhash64("text") if "text" in kept else F.lit(0).cast("long")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        content.alias("content"),
    )
    sources = _sources(rows, shares)
    filled = _slots(_periods(sources))
    numbered = _numbered(rows).withColumn("block", F.floor(F.col("number") / BLOCK_ROWS))
    own = sources.select(F.col("source").alias("of"), "share", "turns")
    known = numbered.join(own, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    period = F.floor(F.col("block") / F.col("share"))
    known = known.select(
        "doc_id",
        "source",
        "content",
        "number",
        "block",
        period.alias("period"),
        (F.col("block") - period * F.col("share")).alias("in_turn"),
        F.array_max(F.filter("turns", lambda t: t <= period)).alias("in_first"),
    )
    same = (
        (F.col("in_first") == F.col("first"))
        & (F.col("in_turn") == F.col("turn"))
        & F.col("source").eqNullSafe(F.col("of"))
    )
    start = F.col("begins") + (F.col("period") - F.col("first")) * F.col("size")
    size, blocks = F.col("size"), F.col("of_source")
    return known.join(filled, same).select(
        "doc_id",
        "source",
        "content",
        "block",
        (start + _down(F.col("turn") * size, blocks)).alias("release"),
        (start + _up((F.col("turn") + 1) * size, blocks)).alias("deadline"),
        (start + F.col("slot")).alias("slot"),
        (F.col("number") - F.col("block") * BLOCK_ROWS).alias("place"),
    )


def mixed(docs: DataFrame, shares: Mapping[str, int] | None = None) -> DataFrame:
    """docs in mixed order, with all their columns and mix_slot, the slot of the row's block.

    Rows equal in doc_id, source and text get the slot of the first of them. docs need a text; a
    mix_slot of their own is replaced.
    """
    id_, source, hash_, at = fresh("id", "source", "hash", "at")
    slots = schedule(docs, shares).groupBy(
        F.col("doc_id").alias(id_), F.col("source").alias(source), F.col("content").alias(hash_)
    ).agg(F.min(F.struct("slot", "place")).alias(at))
    same = (
        named("doc_id").cast("long").eqNullSafe(F.col(id_))
        & named("source").cast("string").eqNullSafe(F.col(source))
        & (F.xxhash64(named("text")) == F.col(hash_))
    )
    others = [named(c) for c in docs.columns if c != "mix_slot"]
    placed = docs.join(slots, same).orderBy(at)
    return placed.select(*others, F.col(at)["slot"].alias("mix_slot"))
