"""Exact dedup by deterministic block naming.

A normalised text is cut into blocks of fixed size. The distinct blocks get integer names in
sorted order, then adjacent pairs of names are named the same way, round after round, until one
name is left of each document: two documents have equal names if and only if their texts are
equal. Names are ranks inside a fixed number of buckets, so no task sorts all blocks.

Blocks travel once, to be named; documents refer to them by a 128-bit digest. Digests prove
nothing by themselves: naming gathers the distinct contents of each digest (copies are merged
before the shuffle) and, should two contents ever share a digest, starts again with another seed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skymart.cluster import settle
from skymart.llm.arrow import doc_texts, map_rows, texts

BLOCK_BYTES = 4096
NAME_BUCKETS = 4096


def _blocks(data: bytes, size: int) -> list[bytes]:
    return [data[i : i + size] for i in range(0, max(1, len(data)), size)]


def normalised(text: str) -> bytes:
    """Lower case for A-Z only, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower()


def _digest_rows(seed: int, size: int):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for doc_id, text in texts(batches):
            data = normalised(text)
            digests = [xxhash.xxh3_128_digest(b, seed) for b in _blocks(data, size)]
            yield doc_id, hashlib.sha256(data).hexdigest(), digests

    return rows


def _block_rows(seed: int, size: int):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for _, text in texts(batches):
            for block in _blocks(normalised(text), size):
                yield xxhash.xxh3_128_digest(block, seed), block

    return rows


def _name(*keys: str) -> Column:
    """An integer for each distinct row of keys: its rank among the sorted keys of a bucket."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(NAME_BUCKETS))
    rank = F.row_number().over(Window.partitionBy(bucket).orderBy(*keys))
    return F.shiftleft(bucket, 40) + rank


def _named_blocks(docs: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Documents with their blocks' digests, and the integer name of each digest."""
    seed = 0
    while True:
        blocks = map_rows(docs, _block_rows(seed, size), "digest binary, block binary")
        contents = blocks.groupBy("digest").agg(F.size(F.collect_set("block")).alias("contents"))
        names = settle(contents.select("digest", "contents", _name("digest").alias("name")))
        if names.filter("contents > 1").isEmpty():
            ddl = "doc_id long, text_sha256 string, digests array<binary>"
            listed = map_rows(docs, _digest_rows(seed, size), ddl)
            return listed.withColumn("row", F.monotonically_increasing_id()), names
        seed += 1


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """row, doc_id, text_sha256, and level and name, which identify the text without collision."""
    listed, names = _named_blocks(doc_texts(docs), block_bytes)
    listed = settle(listed)
    parts = listed.select(
        "row", F.size("digests").alias("parts"), F.posexplode("digests").alias("place", "digest")
    )
    parts = settle(
        parts.join(names.select("digest", "name"), "digest").select("row", "parts", "place", "name")
    )
    longest = parts.agg(F.max("parts")).first()[0] or 1
    done, level = [], 0
    while True:
        done.append(parts.filter("parts = 1").select("row", F.lit(level).alias("level"), "name"))
        if longest == 1:
            break
        even = F.col("place") % 2 == 0
        pairs = (
            parts.filter("parts > 1")
            .groupBy("row", "parts", F.floor(F.col("place") / 2).cast("int").alias("place"))
            .agg(
                F.max(F.when(even, F.col("name"))).alias("first"),
                F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("second"),
            )
        )
        distinct = pairs.select("first", "second").distinct()
        named = distinct.select("first", "second", _name("first", "second").alias("name"))
        halved = F.ceil(F.col("parts") / 2).cast("int").alias("parts")
        parts = settle(
            pairs.join(named, ["first", "second"]).select("row", halved, "place", "name")
        )
        longest, level = (longest + 1) // 2, level + 1
    final = done[0]
    for more in done[1:]:
        final = final.union(more)
    return listed.drop("digests").join(final, "row")


def exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document, with the document of its text that stays.

    Texts are equal when they are equal after lower-casing A-Z; a null text is empty, and empty
    texts are equal to each other. Of equal texts the row with the largest doc_id stays (a null
    doc_id only if there is no other; of repeated rows with one doc_id, one). No rows give no rows.
    Columns other than doc_id and text are not read.

    Returns doc_id, keep_id, group_size, kept, text_sha256.
    """
    rows = settle(identities(docs, block_bytes))
    groups = rows.groupBy("level", "name").agg(
        F.max(F.struct("doc_id", "row")).alias("keep"), F.count("*").alias("group_size")
    )
    return rows.join(groups, ["level", "name"]).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        "text_sha256",
    )
