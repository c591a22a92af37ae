"""Monthly flight CSV files as typed rows.

Headers differ between files. One job looks at the first line of each file, in the executors; files
whose known columns stand at the same places form one scan, and the scans are stacked by name.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from skymart import schema
from skymart.cluster import ship

NAMES = tuple(field.name for field in schema.FLIGHT_FIELDS)
_BY_HEADER = {field.header: field.name for field in schema.FLIGHT_FIELDS}
KEY = "file_key"
#: Lines of a file that reach Python at a time while its header is looked for.
_PROBED_LINES = 64


def split_header(line: str) -> list[str]:
    return next(csv.reader([line.lstrip("﻿")]))


def known_positions(header: Iterable[str]) -> dict[str, int]:
    """Position of each known column in a file.

    ``_m<digits>`` endings do not count, the first of equal names wins, and unnamed or
    unknown columns are left out.
    """
    positions: dict[str, int] = {}
    for position, title in enumerate(header):
        column = _BY_HEADER.get(re.sub(r"_m\d+$", "", title))
        if column is not None:
            positions.setdefault(column, position)
    return positions


def listed(spark: SparkSession, paths: list[str]) -> list[dict]:
    """path and bytes of the files under ``paths`` (files, folders or globs), which are not read."""
    files = spark.read.format("binaryFile").load(paths).select("path", "length")
    return sorted(({"path": row.path, "bytes": row.length} for row in files.collect()), key=str)


#: A file is one partition of the header job, whatever its size and that of the others.
_WHOLE_FILE = str(1 << 50)
_HEADER = "path string, bytes long, titles array<string>"


def headers(spark: SparkSession, paths: list[str]) -> list[Row]:
    """path, bytes and titles of each file; a file without a line that is not blank has no titles.

    Each file is a task that ends at its header: only the rows of one batch are read. The job has a
    session of its own, whose settings keep files whole and apart.
    """
    ship(spark)
    probe = spark.newSession()
    probe.conf.set("spark.sql.files.maxPartitionBytes", _WHOLE_FILE)
    probe.conf.set("spark.sql.files.openCostInBytes", _WHOLE_FILE)
    probe.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(_PROBED_LINES))
    lines = probe.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"), "value"
    )
    found = {row.path: row for row in lines.mapInArrow(_first_lines, _HEADER).collect()}
    none = probe.read.format("binaryFile").load(paths)
    every = none.select(F.col("_metadata.file_path").alias("path"), F.col("length").alias("bytes"))
    empty = [Row(path=r.path, bytes=r.bytes, titles=None) for r in every.collect() if r.path not in found]
    return sorted([*found.values(), *empty], key=lambda row: row.path)


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line of a file that is not blank; what comes behind it is not asked for."""
    for batch in batches:
        for at, line in enumerate(batch.column("value").to_pylist()):
            if line.strip("\ufeff \t\r"):
                row = batch.slice(at, 1)
                titles = pa.array([split_header(line.rstrip("\r"))], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [row.column("path"), row.column("bytes"), titles], ["path", "bytes", "titles"]
                )
                return


Layout = tuple[int, tuple[tuple[str, int], ...]]


def _layouts(found: Iterable[Row]) -> dict[Layout, list[str]]:
    """Files by their number of columns and the places of the known ones.

    A file without any line has no rows; one without a known column is an error.
    """
    groups: dict[Layout, list[str]] = {}
    for file in found:
        if file.titles is None:
            continue
        positions = known_positions(file.titles)
        if not positions:
            raise ValueError(f"no known column in the header of {file.path}")
        layout = len(file.titles), tuple(sorted(positions.items()))
        groups.setdefault(layout, []).append(file.path)
    return groups


def file_key(path: Column) -> Column:
    """A name for one load, made of the whole path: files of one name in two folders differ."""
    return F.concat(F.lit("f"), F.lower(F.hex(F.xxhash64(path))))


def _scan(
    spark: SparkSession, layout: Layout, files: list[str], multi_line: bool, metadata: bool
) -> DataFrame:
    width, positions = layout[0], dict(layout[1])
    present = F.array(*[F.lit(name) for name in sorted(positions)])
    more = [F.col("_metadata.file_size").alias("bytes"), present.alias("present")]
    all_text = ", ".join(f"p{i} string" for i in range(width))
    reader = spark.read.schema(all_text).options(header=True, escape='"', multiLine=multi_line)
    return reader.csv(files).select(
        *[
            F.col(f"p{positions[name]}").alias(name)
            if name in positions
            else F.lit(None).cast("string").alias(name)
            for name in NAMES
        ],
        F.col("_metadata.file_name").alias("source_file"),
        file_key(F.col("_metadata.file_path")).alias(KEY),
        *(more if metadata else []),
    )


def read_text_columns(
    spark: SparkSession, paths: list[str], multi_line: bool = False, metadata: bool = False
) -> DataFrame:
    """The known columns as text, NULL where a file lacks the column, source_file and file_key.

    ``multi_line`` allows line breaks inside quotes; such files can't be split between tasks.
    ``metadata`` adds the file's bytes, and present, the known columns that it has.
    """
    groups = _layouts(headers(spark, paths))
    if not groups:
        raise ValueError(f"no flight files in {paths}")
    scans = [_scan(spark, layout, files, multi_line, metadata) for layout, files in groups.items()]
    return reduce(DataFrame.unionByName, scans)


def parsed(text: Column, type_: str) -> Column:
    """Text as ``type_``; whole numbers may be written with a fraction part of zero.

    NaN and infinity are not numbers, nor is a fraction a whole number: both are NULL.
    """
    if type_ == "string":
        return text
    if type_ not in ("int", "double"):
        return text.try_cast(type_)
    number = text.try_cast("double")
    if type_ == "int":
        return F.when(number == F.floor(number), number.try_cast("int"))
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def utc_now() -> Column:
    return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())


def typed(text_columns: DataFrame, *more: str) -> DataFrame:
    """Typed flights with load metadata; text that does not parse becomes NULL."""
    return text_columns.select(
        *[parsed(F.col(f.name), f.type).alias(f.name) for f in schema.FLIGHT_FIELDS],
        utc_now().alias("ingested_at"),
        "source_file",
        *more,
    )


def read_flights(spark: SparkSession, paths: list[str]) -> DataFrame:
    return typed(read_text_columns(spark, paths))


def keyed(text_columns: DataFrame) -> DataFrame:
    """Typed flights with file_key, which tells loads apart."""
    return typed(text_columns, KEY)


def columns_of_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Per file and column of the contract or the file: whether each of the two has it."""
    rows = []
    for file in headers(spark, paths):
        titles = file.titles or []
        positions = known_positions(titles)
        name = file.path.rsplit("/", 1)[-1]
        rows += [(name, known, True, known in positions) for known in NAMES]
        own = [t for at, t in enumerate(titles) if t and at not in positions.values()]
        rows += [(name, title, False, True) for title in own]
    return spark.createDataFrame(
        rows, "source_file string, column_name string, expected boolean, present boolean"
    )


def profile(text_columns: DataFrame) -> DataFrame:
    """Per file and column: rows, and how many are missing, unparsable or too long.

    With bytes and present, as profiled() adds them, the file's size and whether it has the column.
    One pass with a partial aggregate per file, told apart by their whole paths.
    """
    known = {"bytes", "present"} <= set(text_columns.columns)
    key = [c for c in (KEY,) if c in text_columns.columns]
    figures, results = [F.count(F.lit(1)).alias("rows")], []
    if known:
        figures += [F.max("bytes").alias("bytes"), F.max("present").alias("present")]
    for field in schema.FLIGHT_FIELDS:
        text = F.col(field.name)
        unparsable = text.isNotNull() & parsed(text, field.type).isNull()
        too_long = F.length(text) > (field.max_length or 2**31 - 1)
        figures += [
            F.count_if(text.isNull()).alias(f"{field.name}_missing"),
            F.count_if(unparsable).alias(f"{field.name}_unparsable"),
            F.count_if(too_long).alias(f"{field.name}_too_long"),
        ]
        own = [
            F.lit(field.name).alias("column_name"),
            F.col("rows"),
            F.col(f"{field.name}_missing").alias("missing"),
            F.col(f"{field.name}_unparsable").alias("unparsable"),
            F.col(f"{field.name}_too_long").alias("too_long"),
        ]
        if known:
            own += [F.array_contains("present", field.name).alias("present"), F.col("bytes")]
        results.append(F.struct(*own))
    counts = text_columns.groupBy("source_file", *key).agg(*figures)
    return counts.select("source_file", F.inline(F.array(*results)))


def profiled(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The profile of files with their sizes and which of the expected columns they have.

    Sizes and columns are known to the scans, so that they need no pass of their own. A file
    without rows has none.
    """
    return profile(read_text_columns(spark, paths, metadata=True))
