"""Running Python over Arrow batches of documents, batch by batch and document by document."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from skymart.cluster import ship

#: Rows gathered before a batch is handed back to Spark, and bytes of text or arrays in them.
BATCH_ROWS = 4096
BATCH_BYTES = 8 << 20
_LONG = (bytes, str, np.ndarray)


def texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int | None, str]]:
    """doc_id and text of every row; a missing text is empty."""
    for batch in batches:
        ids, column = batch.column("doc_id"), batch.column("text")
        for i in range(batch.num_rows):
            yield ids[i].as_py(), column[i].as_py() or ""


def packed(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Tuples as record batches of bounded size."""
    waiting: list[tuple] = []
    size = 0
    for row in rows:
        waiting.append(row)
        size += sum(x.nbytes if isinstance(x, np.ndarray) else len(x) for x in row if isinstance(x, _LONG))
        if len(waiting) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield _batch(waiting, schema)
            waiting, size = [], 0
    if waiting:
        yield _batch(waiting, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def arrow_schema(df: DataFrame, ddl: str) -> pa.Schema:
    return to_arrow_schema(df.sparkSession.createDataFrame([], ddl).schema)


def give_back() -> None:
    """Return free memory to the system: workers live on, beside the heap of their executor.

    Arrow's pool and the C library keep what they have freed, the latter even between used blocks.
    """
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def map_rows(
    df: DataFrame, rows: Callable[[Iterator[pa.RecordBatch]], Iterable[tuple]], ddl: str
) -> DataFrame:
    """Apply a generator of tuples to each partition's batches."""
    ship(df.sparkSession)
    schema = arrow_schema(df, ddl)

    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from packed(rows(batches), schema)
        give_back()

    return df.mapInArrow(partition, ddl)


def doc_columns() -> tuple[Column, Column]:
    """The two columns that the operators read; other columns never reach them."""
    return F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")


def doc_texts(docs: DataFrame) -> DataFrame:
    return docs.select(*doc_columns())


def fresh(*names: str) -> list[str]:
    """Column names that no table has."""
    own = uuid.uuid4().hex
    return [f"{name}_{own}" for name in names]


def named(column: str) -> Column:
    """A column by its whole name, which may hold dots and backticks."""
    return F.col("`" + column.replace("`", "``") + "`")


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
