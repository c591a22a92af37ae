"""The corpus pipeline: from raw documents to mixed, encoded ones, in five stages.

Every stage works on all that the one before it kept, and all but the last return the columns of
documents. Mixing adds `mix_slot`, the place of a document's block in the mix, and returns the rows
in that order; encoding carries it on, so that the mix can be restored wherever rows are dealt.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skymart.cluster import shared_folder
from skymart.llm import bpe, language_id, line_dedup, mixing, shingle_join

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; learned from the labelled ones among them."""
    return language_id.accepted(docs, language_id.fit(docs, F.lit(True)))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand, or nearly so, in an earlier one; none goes.

    n_chars follows the text.
    """
    shorter = line_dedup.without_repeats(docs)
    return shorter.withColumn("n_chars", F.char_length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each component of near duplicates."""
    return shingle_join.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix."""
    return mixing.mixed(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, mix_slot, n_tokens, ids and digests of every document."""
    return bpe.encode(docs, WORD_BPE, ["mix_slot"])


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("mix", mix),
    ("encoding", encoding),
]

#: Nearest centroids, edit distances of segments' lines and merges of bytes have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over the documents of sf_dir.

    Every stage but the last is written to the shared folder and read again, so that no later one
    computes it anew; the files stay until deleted, as the result is read from them.
    """
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
