"""Approximate nearest neighbours by collision counting over single projections.

Rows are dealt into cells of bounded size by their hash. A cell's block keeps, for each of M random projections, its
rows sorted by the projected value. A query opens a window around its own value in every
projection and doubles its width round after round (virtual rehashing: the arrays stay as they
are). A row that has been inside THRESHOLD windows is verified with its exact distance. The search
of a block ends once it has verified K rows and the K-th distance is within the round's radius,
or when all rows are verified.

Queries meet blocks, never single rows: each block of rows is searched for each block of queries,
and the K best of each block are merged by query. Every row is indexed and every query answered.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from skymart.llm.arrow import map_rows

K = 10
PROJECTIONS = 48
#: Part of the projections whose windows must hold a row before it is verified.
THRESHOLD = 0.72
#: Half width of a window, in units of the round's radius.
HALF_WIDTH = 1.3
#: Part of the K-th distance at which the rounds begin, and growth of the radius.
GROWTH = 1.15
BLOCK_ROWS = 8192
QUERY_ROWS = 1024
SEED = 20240607


def _usable(vector: Column) -> Column:
    """Not null, not empty, not zero, every component finite."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _projections(dims: int) -> np.ndarray:
    """Unit-variance directions, equal in every task."""
    return np.random.default_rng([SEED, dims]).standard_normal((dims, PROJECTIONS))


class Block:
    """Sorted projections of a block's rows."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        self.ids, self.rows = ids, rows
        self.squares = np.einsum("ij,ij->i", rows, rows)
        self.directions = _projections(rows.shape[1])
        values = rows @ self.directions
        self.order = np.argsort(values, axis=0, kind="stable").T.astype(np.int32)
        self.values = np.ascontiguousarray(np.take_along_axis(values, self.order.T, axis=0).T)
        self.need = int(np.ceil(THRESHOLD * PROJECTIONS))
        sample = rows[:: max(1, len(rows) // 64)]
        near = np.sqrt(((sample[:, None, :] - sample[None, :, :]) ** 2).sum(axis=2))
        self.first = max(1e-9, float(np.quantile(near[near > 0], 0.02)) * 0.5 if near.any() else 1e-9)

    def search(self, query: np.ndarray, own: int) -> list[tuple[int, float]]:
        """The K nearest rows found, but for the query's own."""
        size = len(self.ids)
        centres = query @ self.directions
        low = np.array([v.searchsorted(c) for v, c in zip(self.values, centres, strict=True)])
        high = low.copy()
        hits = np.zeros(size, np.int16)
        verified = np.zeros(size, bool)
        distances = np.full(size, np.inf)
        radius, found = self.first, 0
        while found < size:
            reach = radius * HALF_WIDTH
            fresh = []
            for p in range(PROJECTIONS):
                values, order = self.values[p], self.order[p]
                a = values.searchsorted(centres[p] - reach, "left")
                b = values.searchsorted(centres[p] + reach, "right")
                fresh += [order[a : low[p]], order[high[p] : b]]
                low[p], high[p] = min(a, low[p]), max(b, high[p])
            hits += np.bincount(np.concatenate(fresh), minlength=size).astype(np.int16)
            ready = np.flatnonzero((hits >= self.need) & ~verified)
            if len(ready):
                verified[ready] = True
                found += len(ready)
                gaps = self.rows[ready] - query
                distances[ready] = np.sqrt(np.einsum("ij,ij->i", gaps, gaps))
                distances[ready[self.ids[ready] == own]] = np.inf
            if found > K and np.partition(distances, K - 1)[K - 1] <= radius:
                break
            if (low == 0).all() and (high == size).all():
                break
            radius *= GROWTH
        taken = np.flatnonzero(np.isfinite(distances))
        taken = taken[np.lexsort((self.ids[taken], distances[taken]))][:K]
        return list(zip(self.ids[taken].tolist(), distances[taken].tolist(), strict=True))


def _matrix(column: pa.ListScalar) -> np.ndarray:
    return np.frombuffer(column.as_py(), np.float64)


def nearest(vectors: DataFrame, queries: Column | None = None) -> DataFrame:
    """The nearest rows of each query row by Euclidean distance, in double precision.

    vectors has vec_id and embedding; queries picks the query rows (default: vec_id divisible by
    100). Vectors that are null, empty, zero, or hold a null or non-finite component take no part,
    and vectors of different length are never compared. Ties go to the smaller vec_id. Repeated
    rows of one vec_id are candidates each, but none is a candidate of its own vec_id. Other
    columns are not read; no rows or no queries give none.

    Returns query_id, rank from 1, vec_id, score; fewer than K rows if there are fewer candidates.
    """
    double = F.col("embedding").cast(T.ArrayType(T.DoubleType()))
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), double.alias("vector"))
    usable = usable.filter(F.col("vec_id").isNotNull() & _usable(F.col("vector"))).withColumn(
        "dims", F.size("vector")
    )
    picked = usable.filter(F.col("vec_id") % 100 == 0 if queries is None else queries)
    cells = max(1, -(-usable.count() // BLOCK_ROWS))
    dealt = usable.withColumn("cell", F.pmod(F.xxhash64("vec_id"), F.lit(cells)).cast("int"))
    blocks = _packed(dealt.repartition("cell"), BLOCK_ROWS)
    asked = _packed(picked.withColumn("cell", F.lit(0)), QUERY_ROWS).withColumn(
        "cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1)))
    )
    met = blocks.withColumnsRenamed({"ids": "block_ids", "rows": "block_rows"}).join(
        asked, ["cell", "dims"]
    )

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        at, block = b"", None
        for batch in batches:
            for i in range(batch.num_rows):
                ids, rows, own_ids, own_rows, dims = (
                    batch.column(c)[i].as_py()
                    for c in ("block_ids", "block_rows", "ids", "rows", "dims")
                )
                if block is None or at != ids:
                    at, block = ids, Block(
                        np.frombuffer(ids, np.int64), np.frombuffer(rows).reshape(-1, dims)
                    )
                asked_rows = np.frombuffer(own_rows).reshape(-1, dims)
                for own, query in zip(np.frombuffer(own_ids, np.int64).tolist(), asked_rows, strict=True):
                    for vec_id, score in block.search(query, own):
                        yield own, vec_id, score

    found = map_rows(met, search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order).cast("int"))
        .filter(F.col("rank") <= K)
        .select("query_id", "rank", "vec_id", "score")
    )


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """cell, dims, ids binary, rows binary: up to size vectors of a cell and length, as arrays."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        waiting: dict[tuple[int, int], list[tuple[int, list[float]]]] = {}
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("cell", "vec_id", "vector"))
            for cell, vec_id, vector in zip(*columns, strict=True):
                key = cell, len(vector)
                group = waiting.setdefault(key, [])
                group.append((vec_id, vector))
                if len(group) == size:
                    yield *key, *_flush(waiting.pop(key))
        for key, group in waiting.items():
            yield *key, *_flush(group)

    return map_rows(rows, pack, "cell int, dims int, ids binary, rows binary")


def _flush(group: list[tuple[int, list[float]]]) -> tuple[bytes, bytes]:
    ids = np.array([i for i, _ in group], np.int64)
    return ids.tobytes(), np.array([v for _, v in group], np.float64).tobytes()
