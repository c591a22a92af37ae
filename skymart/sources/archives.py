"""Zipped flight files as a data source: one partition per archive, whose CSV member is streamed.

A zip stream cannot be split, so the work spreads over archives. A task opens its archive where it lies and
reads the member in batches, so that its memory depends neither on the archive nor on the member. The rows are
text columns, typed by the same Spark expressions as those of plain files.

Archives are opened by Arrow's file systems (local or mounted folders, HDFS, S3, Google Cloud).
"""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from skymart.cluster import ship
from skymart.sources import flight_files

FORMAT = "zipped_flights"
BATCH_ROWS = 50_000
#: Bytes that are fetched at once from an archive's file system.
BUFFER_BYTES = 1 << 20
_SCHEMA = ", ".join(f"{name} string" for name in (*flight_files.NAMES, "source_file", "path"))


class ZippedFlights(DataSource):
    """The known columns of the first ``.csv`` member of each archive as text, its name and path.

    Option paths: the archives as a JSON list.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> ZippedReader:
        return ZippedReader(json.loads(self.options["paths"]))


class ZippedReader(DataSourceReader):
    def __init__(self, paths: list[str]) -> None:
        self.paths = paths

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(path) for path in self.paths]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        with opened(partition.value) as file:
            yield from _batches(partition.value, file)


def opened(path: str) -> BinaryIO:
    """A file that can be read from any place, in whatever file system its path names."""
    if "://" not in path and path.startswith("file:"):
        path = "file://" + path.removeprefix("file:")
    if "://" not in path:
        return open(path, "rb", buffering=BUFFER_BYTES)
    system, name = fs.FileSystem.from_uri(path)
    return io.BufferedReader(system.open_input_file(name), BUFFER_BYTES)


def _member(archive: zipfile.ZipFile, path: str) -> str:
    for name in archive.namelist():
        if name.lower().endswith(".csv"):
            return name
    raise ValueError(f"no CSV file in {path}")


def _batches(path: str, file: BinaryIO) -> Iterator[pa.RecordBatch]:
    with zipfile.ZipFile(file) as archive:
        name = _member(archive, path)
        with io.TextIOWrapper(archive.open(name), encoding="utf-8", newline="") as lines:
            line = next((x for x in lines if x.strip("﻿ \t\r\n")), None)
            if line is None:
                return
            header = flight_files.split_header(line.rstrip("\r\n"))
            positions = flight_files.known_positions(header)
            if not positions:
                raise ValueError(f"no known column in the header of {path}")
            try:
                frames = pd.read_csv(
                    lines,
                    header=None,
                    names=range(len(header)),
                    usecols=sorted(positions.values()),
                    dtype=str,
                    keep_default_na=False,
                    na_values=[""],
                    index_col=False,
                    chunksize=BATCH_ROWS,
                )
            except pd.errors.EmptyDataError:  # a header and nothing else
                return
            for frame in frames:
                yield _batch(frame, positions, name.rsplit("/", 1)[-1], f"{path}!{name}")


def _batch(
    frame: pd.DataFrame, positions: dict[str, int], source_file: str, path: str
) -> pa.RecordBatch:
    def column(name: str) -> pa.Array:
        if name in positions:
            return pa.array(frame[positions[name]], pa.string(), from_pandas=True)
        return pa.nulls(len(frame), pa.string())

    own = {name: column(name) for name in flight_files.NAMES}
    own["source_file"] = pa.repeat(pa.scalar(source_file), len(frame))
    own["path"] = pa.repeat(pa.scalar(path), len(frame))
    return pa.RecordBatch.from_pydict(own)


def read_zipped_text_columns(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The known columns as text, source_file (the member's name) and file_key."""
    ship(spark)
    spark.dataSource.register(ZippedFlights)
    files = [file["path"] for file in flight_files.listed(spark, paths)]
    rows = spark.read.format(FORMAT).option("paths", json.dumps(files)).load()
    return rows.withColumn(flight_files.KEY, flight_files.file_key(F.col("path"))).drop("path")


def read_zipped_csv(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Typed flights from the first ``.csv`` member of each archive."""
    return flight_files.typed(read_zipped_text_columns(spark, paths))
