"""Language-model scores: interpolated modified Kneser-Ney over bigrams.

Words are 64-bit hashes. Counting is two Spark aggregations over the whole training texts: each
task counts its own part first, and packed arrays of its distinct words or bigrams go to shards.
Bigrams are dealt by their first word, so that a context's figures meet in one shard; those of
heavy words (each over a thousandth of all tokens, so at most a thousand words) are dealt by both
words and their figures summed afterwards.

Shards write sorted arrays of hashes with their counts to the folder that all executors share.
Scoring tasks memory-map those arrays and search them in sorted order, a million tokens at a time.

    P(w | u) = max(c(uw) - D(c(uw)), 0) / c(u) + (D1 N1(u) + D2 N2(u) + D3 N3+(u)) / c(u) P(w)
    P(w)     = max(n(w) - E(n(w)), 0) / n + (E1 M1 + E2 M2 + E3 M3+) / n / (V + 1)

c counts bigrams, c(u) and Nk(u) sum up context u, n(w) is the number of distinct words before w,
n their sum, Mk the words with n(w) = k, and V + 1 is the vocabulary with one unknown word. The
discounts D and E are Chen and Goodman's, from the counts of counts of each order; where one of
those is zero, they are 0.5, 1 and 1.5. A text begins behind a start mark and ends with an end.
"""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skymart.cluster import settle, shared_folder, ship
from skymart.llm import tokens
from skymart.llm.arrow import arrow_schema, doc_texts, map_rows

#: Tokens counted before a task hands on what it has, and tokens scored at a time.
COUNT_TOKENS = 4_000_000
SCORE_TOKENS = 1_000_000
#: A word with over this part of all tokens is heavy.
HEAVY = 0.001
START, END = np.uint64(1), np.uint64(2)
#: The arrays of a shard: of words and of bigrams.
WORD_ARRAYS = {
    "words": "u8", "count": "u8", "before": "u8", "total": "u8", "once": "u8", "twice": "u8", "more": "u8",
}
BIGRAM_ARRAYS = {"bigrams": "u8", "times": "u4"}


def local_path(folder: str) -> str:
    """The shared folder as every machine mounts it; memory mapping needs a file system."""
    parts = urlparse(folder)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"{folder} is not mounted on the executors, so it can't be memory-mapped")
    return parts.path


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and the figures of the whole corpus."""

    folder: str
    shard_bits: int
    heavy: tuple[int, ...]
    train_tokens: int
    vocabulary: int
    distinct_bigrams: int
    discounts: tuple[float, float, float]
    lower_discounts: tuple[float, float, float]
    lower_rest: float


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    if not (n1 and n2 and n3 and n4):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
    return tuple(min(max(d, 0.0), float(k)) for k, d in enumerate(found, 1))  # type: ignore[return-value]


def _shard(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _slices(shards: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """shard, begin, end of each run of a sorted array of shards."""
    edges = np.flatnonzero(np.diff(shards)) + 1
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(shards)], strict=True):
        if b > a:
            yield int(shards[a]), a, b


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, sorted, and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
    if not len(begins):
        return keys, *values
    return keys[begins], *(np.add.reduceat(v[order], begins) for v in values)


def _gathered(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[tuple[list, list]]:
    """Hash arrays and word counts of documents, up to about `most` tokens at a time."""
    hashes, counts, held = [], [], 0
    for batch in batches:
        for _, own, of_doc in tokens.hashed_texts(batch):
            hashes.append(own)
            counts.append(of_doc)
            held += len(own) + len(of_doc)
            if held >= most:
                yield hashes, counts
                hashes, counts, held = [], [], 0
    if counts:
        yield hashes, counts


def _sequence(hashes: list, counts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens with an end behind each document, the token before each, and tokens of each document."""
    of_doc = np.concatenate(counts)
    words = np.concatenate(hashes)
    ends = np.cumsum(of_doc)
    sequence = np.insert(words, ends, END)
    sizes = of_doc + 1
    begins = np.cumsum(sizes) - sizes
    before = np.empty_like(sequence)
    before[1:] = sequence[:-1]
    before[begins] = START
    return sequence, before, sizes


# --- counting ---


def _count_words(bits: int):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for hashes, counts in _gathered(batches, COUNT_TOKENS):
            sequence, *_ = _sequence(hashes, counts)
            words, times = np.unique(sequence, return_counts=True)
            for shard, a, b in _slices(_shard(words, bits)):
                yield shard, words[a:b].tobytes(), times[a:b].tobytes()

    return rows


def _blobs(group: pa.Table, column: str, kind) -> np.ndarray:
    parts = [np.frombuffer(x, kind) for x in group.column(column).to_pylist() if x]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _table(schema: pa.Schema, *columns: list) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _merge_words(schema: pa.Schema):
    def merge(group: pa.Table) -> pa.Table:
        words, times = _summed(_blobs(group, "words", "u8"), _blobs(group, "times", "i8"))
        shard = group.column("shard")[0].as_py()
        return _table(
            schema, [shard], [words.tobytes()], [times.tobytes()], [int(times.sum())], [len(words)]
        )

    return merge


def _heavy_words(least: float):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            words = _blobs(pa.table(batch), "words", "u8")
            times = _blobs(pa.table(batch), "times", "i8")
            for word in words[times > least].view("i8").tolist():
                yield (word,)

    return rows


def _count_bigrams(bits: int, heavy: tuple[int, ...]):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        hot = np.array(heavy, np.int64).view(np.uint64)
        for hashes, counts in _gathered(batches, COUNT_TOKENS):
            words, before, _ = _sequence(hashes, counts)
            _, at, times = np.unique(
                tokens.mix(before, words), return_index=True, return_counts=True
            )
            before, words = before[at], words[at]
            dealt = np.where(np.isin(before, hot), tokens.mix(before, words), before)
            order = np.lexsort((before, _shard(dealt, bits)))
            before, words, times, dealt = before[order], words[order], times[order], dealt[order]
            for shard, a, b in _slices(_shard(dealt, bits)):
                own = before[a:b]
                begins = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                runs = np.diff(np.append(begins, len(own))).astype(np.uint32)
                yield (
                    shard,
                    own[begins].tobytes(),
                    runs.tobytes(),
                    words[a:b].tobytes(),
                    times[a:b].astype(np.uint32).tobytes(),
                )

    return rows


def _write(folder: str, kind: dict[str, str], shard: int, arrays: list[np.ndarray]) -> None:
    """Write each array under its name; a repeated task replaces the file by an equal one."""
    for (name, dtype), values in zip(kind.items(), arrays, strict=True):
        target = os.path.join(folder, f"{name}-{shard}")
        waiting = f"{target}.{uuid.uuid4().hex}"
        values.astype(dtype).tofile(waiting)
        os.replace(waiting, target)


def _times_of_times(times: np.ndarray) -> list[int]:
    return [int((times == k).sum()) for k in (1, 2, 3, 4)] + [int((times > 2).sum())]


def _merge_bigrams(schema: pa.Schema, folder: str, bits: int):
    """Write a shard's bigrams; hand on its contexts' figures and how many words are before each."""

    def merge(group: pa.Table) -> pa.Table:
        before = np.repeat(_blobs(group, "before", "u8"), _blobs(group, "runs", "u4"))
        words, times = _blobs(group, "words", "u8"), _blobs(group, "times", "u4").astype(np.int64)
        keys = tokens.mix(before, words)
        order = np.argsort(keys)
        keys, before, words, times = keys[order], before[order], words[order], times[order]
        begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        times = np.add.reduceat(times, begins)
        keys, before, words = keys[begins], before[begins], words[begins]
        shard = group.column("shard")[0].as_py()
        _write(folder, BIGRAM_ARRAYS, shard, [keys, times])
        contexts = _summed(
            before, times, (times == 1).astype("i8"), (times == 2).astype("i8"), (times > 2).astype("i8")
        )
        followers = _summed(words, np.ones(len(words), np.int64))
        rows: list[list] = [[] for _ in schema]
        for kind, (found, *figures) in ((0, contexts), (1, followers)):
            for to, a, b in _slices(_shard(found, bits)):
                packed = np.concatenate([f[a:b] for f in figures]).astype(np.uint32)
                if any((f[a:b] > 0xFFFFFFFF).any() for f in figures):
                    packed = np.concatenate([f[a:b] for f in figures])
                row = (to, kind, found[a:b].tobytes(), packed.tobytes(), [])
                for column, value in zip(rows, row, strict=True):
                    column.append(value)
        for column, value in zip(rows, (-1, 2, b"", b"", _times_of_times(times)), strict=True):
            column.append(value)
        return _table(schema, *rows)

    return merge


def _figures(group: pa.Table, kind: int, width: int) -> list[np.ndarray]:
    """words, and `width` figures of each, from all rows of a kind."""
    words, figures = [], [[] for _ in range(width)]
    for of, own, packed in zip(
        *(group.column(c).to_pylist() for c in ("kind", "words", "figures")), strict=True
    ):
        if of == kind:
            found = np.frombuffer(own, "u8")
            size = len(packed) // (len(found) * width)
            values = np.frombuffer(packed, f"u{size}").astype(np.int64).reshape(width, -1)
            words.append(found)
            for held, value in zip(figures, values, strict=True):
                held.append(value)
    none = np.zeros(0, np.int64)
    return [
        np.concatenate(words) if words else none.astype("u8"),
        *(np.concatenate(f) if f else none for f in figures),
    ]


def _store_words(schema: pa.Schema, folder: str):
    def store(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        counted = _figures(group, 3, 1)
        contexts, followers = _figures(group, 0, 4), _figures(group, 1, 1)
        every = np.unique(np.concatenate([counted[0], contexts[0], followers[0]]))
        columns = [every]
        for (found, *figures) in (counted, followers, contexts):
            at = np.searchsorted(every, found)
            for figure in figures:
                columns.append(np.bincount(at, weights=figure, minlength=len(every)).astype(np.int64))
        _write(folder, WORD_ARRAYS, shard, columns)
        before = columns[2]
        return _table(schema, [_times_of_times(before[before > 0])], [int(before.sum())])

    return store


def train(docs: DataFrame, chosen: Column) -> Model:
    """Count the texts of the rows where chosen holds, and store the model's arrays."""
    ship(docs.sparkSession)
    spark = docs.sparkSession
    taken = doc_texts(docs.filter(chosen))
    bits = min(14, max(3, math.ceil(math.log2(docs.count() + 1)) - 12))
    folder = os.path.join(local_path(shared_folder(spark)), f"kneser-ney-{uuid.uuid4().hex}")
    os.makedirs(folder)

    ddl = "shard long, words binary, times binary, tokens long, distinct_words long"
    counted = (
        map_rows(taken, _count_words(bits), "shard long, words binary, times binary")
        .groupBy("shard")
        .applyInArrow(_merge_words(arrow_schema(docs, ddl)), ddl)
    )
    counted = settle(counted)
    total, vocabulary = counted.agg(F.sum("tokens"), F.sum("distinct_words")).first()
    total, vocabulary = total or 0, vocabulary or 0
    heavy = map_rows(counted.select("words", "times"), _heavy_words(HEAVY * total), "word long")
    heavy = tuple(sorted([r.word for r in heavy.collect()] + [int(START)]))

    ddl = "shard long, kind int, words binary, figures binary, times array<long>"
    bigrams = map_rows(
        taken,
        _count_bigrams(bits, heavy),
        "shard long, before binary, runs binary, words binary, times binary",
    )
    bigrams = bigrams.groupBy("shard").applyInArrow(
        _merge_bigrams(arrow_schema(docs, ddl), folder, bits), ddl
    )
    bigrams = settle(bigrams)
    upper = _totals(bigrams.filter("kind = 2"), "times")
    words = counted.select(
        "shard",
        F.lit(3).alias("kind"),
        "words",
        F.col("times").alias("figures"),
        F.array().cast("array<long>").alias("times"),
    )
    ddl = "times array<long>, total long"
    stored = (
        bigrams.filter("kind < 2")
        .union(words)
        .groupBy("shard")
        .applyInArrow(_store_words(arrow_schema(docs, ddl), folder), ddl)
    )
    stored = settle(stored)
    lower = _totals(stored, "times")
    distinct = stored.agg(F.sum("total")).first()[0] or 0
    below = discounts(*lower[:4])
    rest = sum(d * n for d, n in zip(below, (lower[0], lower[1], lower[4]), strict=True))
    return Model(
        folder, bits, heavy, total, vocabulary, distinct,
        discounts(*upper[:4]), below, rest / distinct if distinct else 1.0,
    )


def _totals(df: DataFrame, column: str) -> list[int]:
    sums = df.agg(*[F.sum(F.col(column)[k]).alias(f"n{k}") for k in range(5)]).first()
    return [n or 0 for n in sums]


# --- scoring ---


class Arrays:
    """The memory-mapped arrays of a model."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.hot = np.array(model.heavy, np.int64).view(np.uint64)
        self.open: dict[tuple[str, int], np.ndarray] = {}

    def array(self, name: str, kind: str, shard: int) -> np.ndarray:
        key = name, shard
        if key not in self.open:
            path = os.path.join(self.model.folder, f"{name}-{shard}")
            filled = os.path.exists(path) and os.path.getsize(path)
            self.open[key] = np.memmap(path, kind, "r") if filled else np.zeros(0, kind)
        return self.open[key]

    def look_up(
        self, arrays: dict[str, str], keys: np.ndarray, shards: np.ndarray
    ) -> list[np.ndarray]:
        """The figures of sorted keys within sorted shards; 0 where a key is missing."""
        (name, kind), *figures = arrays.items()
        found = [np.zeros(len(keys), np.int64) for _ in figures]
        for shard, a, b in _slices(shards):
            own = self.array(name, kind, shard)
            if not len(own):
                continue
            at = np.minimum(own.searchsorted(keys[a:b]), len(own) - 1)
            hit = np.flatnonzero(own[at] == keys[a:b])
            for held, (figure, dtype) in zip(found, figures, strict=True):
                held[a + hit] = self.array(figure, dtype, shard)[at[hit]]
        return found

    def scores(self, words: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 P of each token after the one before it, and each token's training count."""
        m = self.model
        bits = m.shard_bits
        distinct, place = np.unique(np.concatenate([words, before]), return_inverse=True)
        figures = self.look_up(WORD_ARRAYS, distinct, _shard(distinct, bits))
        count, preceding = (f[place[: len(words)]] for f in figures[:2])
        total, once, twice, more = (f[place[len(words) :]] for f in figures[2:])
        keys = tokens.mix(before, words)
        shards = _shard(np.where(np.isin(before, self.hot), keys, before), bits)
        order = np.lexsort((keys, shards))
        times = np.zeros(len(keys), np.int64)
        (times[order],) = self.look_up(BIGRAM_ARRAYS, keys[order], shards[order])
        lower = m.lower_rest / (m.vocabulary + 1)
        if m.distinct_bigrams:
            lower = lower + self._discounted(preceding, m.lower_discounts) / m.distinct_bigrams
        known = total > 0
        divisor = np.where(known, total, 1)
        d1, d2, d3 = m.discounts
        rest = np.where(known, (d1 * once + d2 * twice + d3 * more) / divisor, 1.0)
        return np.log10(self._discounted(times, m.discounts) / divisor + rest * lower), count

    @staticmethod
    def _discounted(times: np.ndarray, by: tuple[float, float, float]) -> np.ndarray:
        table = np.array([0.0, *by])
        return np.maximum(times - table[np.minimum(times, 3)], 0.0)


@lru_cache(maxsize=2)
def _arrays(model: Model) -> Arrays:
    return Arrays(model)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every whole text.

    A null or empty text is its end alone. n_known counts the tokens seen in training, base_score
    is an additive unigram model's log10 probability and score this model's. Repeated rows get
    equal scores; without training texts every probability is 1; no rows give none; other columns
    are not read.
    """

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        arrays = _arrays(model)
        scale = model.train_tokens + 0.1 * (model.vocabulary + 1)
        for ids, hashes, counts in _documents(batches):
            words, before, sizes = _sequence(hashes, counts)
            begins = np.cumsum(sizes) - sizes
            logs, count = np.zeros(len(words)), np.zeros(len(words), np.int64)
            for a in range(0, len(words), SCORE_TOKENS):
                b = a + SCORE_TOKENS
                logs[a:b], count[a:b] = arrays.scores(words[a:b], before[a:b])
            base = np.add.reduceat(np.log10((count + 0.1) / scale), begins)
            yield from zip(
                ids,
                sizes.tolist(),
                np.add.reduceat((count > 0).astype(np.int64), begins).tolist(),
                [model.train_tokens] * len(ids),
                base.tolist(),
                np.add.reduceat(logs, begins).tolist(),
                strict=True,
            )

    ddl = (
        "doc_id long, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double"
    )
    return map_rows(doc_texts(docs), rows, ddl)


def _documents(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list, list]]:
    """doc_ids, hash arrays and word counts of documents, about SCORE_TOKENS tokens at a time."""
    ids, hashes, counts, held = [], [], [], 0
    for batch in batches:
        own_ids = batch.column("doc_id").to_pylist()
        for at, own, of_doc in tokens.hashed_texts(batch):
            ids += own_ids[at : at + len(of_doc)]
            hashes.append(own)
            counts.append(of_doc)
            held += len(own)
            if held >= SCORE_TOKENS:
                yield ids, hashes, counts
                ids, hashes, counts, held = [], [], [], 0
    if ids:
        yield ids, hashes, counts
