"""Maximal runs of repeated words, found by internal pattern matching.

A run of period q and at least 4 q words holds, for the power of two B with q <= B < 2 q, a block of
B words that starts at a multiple of B / 2 and occurs again, for the first time, q words later. So
each such dyadic block asks for its next occurrence in the window of B words behind it: the suffix
array lists the occurrences of a block as one interval, and a wavelet tree over its entries gives the
smallest entry beyond the block's place. Neighbouring blocks with the same answer form a progression, whose
step is a candidate period; it is extended to both sides, word by word, to the whole run.

Spark hands out the documents in Arrow batches. The texts of a slice of a batch are worked
on together with numpy; words of two documents are never equal, so that no match leaves a document.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from skymart.llm.arrow import doc_columns, map_rows

#: A run has at least 6 words and four periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Bytes of text that are worked on at once; a longer document is a slice of its own.
SLICE_BYTES = 4 << 20
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


class Runs(NamedTuple):
    """Runs by document and start (a word number in it), then period."""

    doc: np.ndarray
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Code of each word of all texts, the words by code, and where each text's words begin."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    size = int(offsets[-1] - offsets[0])
    data = np.frombuffer(data, np.uint8, size, int(offsets[0])) if size else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    solid = ~_BLANK[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    inner = offsets[1:-1]
    inner = inner[inner < size]
    first[inner] = solid[inner]
    at = np.flatnonzero(first)
    # Words stand one behind the other once the blanks are taken away.
    kept = data[solid]
    begins = np.append(np.cumsum(solid)[at] - 1, len(kept)).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(at), [None, pa.py_buffer(begins), pa.py_buffer(np.ascontiguousarray(kept))]
    )
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return codes, coded.dictionary, np.searchsorted(at, offsets)


def planted(codes: np.ndarray, begins: np.ndarray, ids: list[int | None]) -> np.ndarray:
    """The words after the contract's change: a tenth of the documents repeat some from a word on."""
    codes = codes.copy()
    for doc, doc_id in enumerate(ids):
        n = int(begins[doc + 1] - begins[doc])
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        if h % 10 or not n:
            continue
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        own = codes[begins[doc] : begins[doc + 1]]
        own[a:] = own[a + np.arange(n - a) % p]
    return codes


class _Queries:
    """Blocks that ask for their next occurrence, with their interval in the suffix array."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []

    def add(self, block: int, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        if len(at):
            self.parts.append((np.full(len(at), block, np.int32), at, low, high))

    def all(self) -> list[np.ndarray]:
        return [np.concatenate(x) for x in zip(*self.parts, strict=True)]


def suffix_array(codes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, _Queries]:
    """The suffixes of all documents in order, by doubling; and the blocks of each doubled size.

    Suffixes of equal first B words are one interval of the array; an interval of one is done.
    A word counts with its document; a document's end is smaller than any word.
    """
    n = len(codes)
    sizes = np.diff(begins)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    local = (np.arange(n) - begins[:-1][doc]).astype(np.int32)
    left = (sizes[doc] - local).astype(np.int32)
    key = doc * (codes.max(initial=0) + 1) + codes
    order = np.argsort(key, kind="stable")
    suffixes = order.astype(np.int32)
    rank = np.zeros(n, np.int32)
    slots, block, queries = np.arange(n), 1, _Queries()
    key = key[order]
    while len(slots):
        # suffixes[slots] is sorted by key; a new key starts an interval.
        fresh = np.append(True, key[1:] != key[:-1])
        heads = np.flatnonzero(fresh)
        counts = np.diff(np.append(heads, len(slots)))
        at = suffixes[slots]
        low = np.repeat(slots[heads], counts).astype(np.int32)
        rank[at] = low
        several = np.repeat(counts > 1, counts)
        slots, at, low = slots[several], at[several], low[several]
        high = low + np.repeat(counts[counts > 1], counts[counts > 1]).astype(np.int32)
        asks = (local[at] % max(1, block // 2) == 0) & (left[at] > block)
        queries.add(block, at[asks], low[asks], high[asks])
        if not len(slots):
            break
        behind = np.full(len(at), -1, np.int64)
        inside = left[at] > block
        behind[inside] = rank[at[inside] + block]
        key = low.astype(np.int64) * (n + 1) + behind + 1
        order = np.argsort(key, kind="stable")
        suffixes[slots], key = at[order], key[order]
        block *= 2
    return suffixes, queries


def successors(
    values: np.ndarray, low: np.ndarray, high: np.ndarray, beyond: np.ndarray
) -> np.ndarray:
    """The smallest of values[low:high] that is larger than beyond, -1 without one, for all queries.

    A wavelet tree, level by level for all queries at once: the first descent counts the entries
    that are not larger, the second finds the next in rank. Only one level is held at a time.
    """
    bits = max(1, int(values.max(initial=0)).bit_length())
    limit = beyond + 1
    a, b = low.astype(np.int64), high.astype(np.int64)
    smaller = np.zeros(len(a), np.int64)
    for zeros, ones_at in _levels(values, bits):
        one = (limit >> zeros.bit & 1).astype(bool)
        left, right = zeros.before[a], zeros.before[b]
        smaller += np.where(one, right - left, 0)
        a = np.where(one, ones_at + a - left, left)
        b = np.where(one, ones_at + b - right, right)
    found = smaller < high.astype(np.int64) - low
    result = np.full(len(low), -1, np.int64)
    a, b, nth = low[found].astype(np.int64), high[found].astype(np.int64), smaller[found]
    value = np.zeros(len(a), np.int64)
    for zeros, ones_at in _levels(values, bits):
        left, right = zeros.before[a], zeros.before[b]
        one = nth >= right - left
        nth = np.where(one, nth - (right - left), nth)
        value |= one.astype(np.int64) << zeros.bit
        a = np.where(one, ones_at + a - left, left)
        b = np.where(one, ones_at + b - right, right)
    result[found] = value
    return result


class _Level(NamedTuple):
    bit: int
    before: np.ndarray


def _levels(values: np.ndarray, bits: int) -> Iterator[tuple[_Level, int]]:
    """From the highest bit: zeros before each place, and where the ones begin on the next level."""
    for bit in reversed(range(bits)):
        one = (values >> bit & 1).astype(bool)
        before = np.zeros(len(values) + 1, np.int64)
        np.cumsum(~one, out=before[1:])
        yield _Level(bit, before), int(before[-1])
        values = np.concatenate([values[~one], values[one]])


def runs_of(codes: np.ndarray, begins: np.ndarray) -> Runs:
    """All maximal runs of the documents."""
    none = np.zeros(0, np.int64)
    if not len(codes):
        return Runs(none, none, none, none)
    sizes = np.diff(begins)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    suffixes, queries = suffix_array(codes, begins)
    if not queries.parts:
        return Runs(none, none, none, none)
    block, at, low, high = queries.all()
    first = begins[:-1][doc]
    local = (suffixes - first[suffixes]).astype(np.int64)
    here = (at - first[at]).astype(np.int64)
    step = successors(local, low, high, here) - here
    fits = (step > block // 2) & (step <= block)
    block, at, step = block[fits].astype(np.int64), at[fits].astype(np.int64), step[fits]
    order = np.lexsort((at, block))
    block, at, step = block[order], at[order], step[order]
    if not len(at):
        return Runs(none, none, none, none)
    # Progressions: neighbouring blocks of a size with one step in one document.
    apart = np.maximum(block // 2, 1)
    joined = (block[1:] == block[:-1]) & (step[1:] == step[:-1]) & (doc[at[1:]] == doc[at[:-1]])
    joined &= at[1:] - at[:-1] == apart[1:]
    heads = np.flatnonzero(np.append(True, ~joined))
    lasts = np.append(heads[1:], len(at)) - 1
    start, stop = at[heads], at[lasts] + block[heads] + step[heads]
    apart, step = apart[heads], step[heads]
    needed = np.maximum(LEAST_WORDS, LEAST_PERIODS * step)
    likely = stop - start + 2 * (apart - 1) >= needed
    found = []
    for s, e, q, least in zip(*(x[likely].tolist() for x in (start, stop, step, needed)), strict=True):
        d = int(doc[s])
        s, e = _extended(codes, s, e, q, int(begins[d]), int(begins[d + 1]))
        if e - s >= least:
            found.append((d, s - int(begins[d]), e - s, q))
    found = sorted(set(found), key=lambda r: (r[0], r[1], r[3]))
    return Runs(*(np.array(x, np.int64) for x in (zip(*found, strict=True) if found else [()] * 4)))


def _extended(codes: np.ndarray, s: int, e: int, q: int, first: int, end: int) -> tuple[int, int]:
    """The longest stretch of period q around s:e within first:end, looked at in growing pieces."""
    size = 16
    while s > first:
        a = max(first, s - size)
        unlike = np.flatnonzero(codes[a:s] != codes[a + q : s + q])
        s = a + int(unlike[-1]) + 1 if len(unlike) else a
        if len(unlike):
            break
        size *= 2
    size = 16
    while e < end:
        b = min(end, e + size)
        unlike = np.flatnonzero(codes[e:b] != codes[e - q : b - q])
        e = e + int(unlike[0]) if len(unlike) else b
        if len(unlike):
            break
        size *= 2
    return s, e


def _kept(runs: Runs, begins: np.ndarray) -> np.ndarray:
    """Words that no run holds behind its first period."""
    change = np.zeros(int(begins[-1]) + 1, np.int64)
    start = begins[runs.doc] + runs.start
    np.add.at(change, start + runs.period, 1)
    np.add.at(change, start + runs.length, -1)
    return np.cumsum(change[:-1]) == 0


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with SLICE_BYTES of text, or one document that has more."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    at, size = 0, 0
    for i, more in enumerate(sizes.tolist()):
        if i > at and size + more > SLICE_BYTES:
            yield batch.slice(at, i - at)
            at, size = i, 0
        size += more
    if at < batch.num_rows:
        yield batch.slice(at)


def _reports(batch: pa.RecordBatch, change: bool) -> Iterator[tuple]:
    ids = batch.column("doc_id").to_pylist()
    codes, known, begins = words_of(batch.column("text"))
    if change:
        codes = planted(codes, begins, ids)
    runs = runs_of(codes, begins)
    kept = _kept(runs, begins)
    bounds = np.append(0, np.cumsum(kept))[begins]
    words = known.take(pa.array(codes[kept]))
    lists = pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), words)
    bodies = pc.binary_join(lists, pa.scalar(b" ", pa.large_binary()))
    of_doc = np.searchsorted(runs.doc, np.arange(len(ids) + 1))
    rows = list(zip(runs.start.tolist(), runs.length.tolist(), runs.period.tolist(), strict=True))
    for i, doc_id in enumerate(ids):
        own = rows[of_doc[i] : of_doc[i + 1]]
        # Exact: two different fractions of such numbers differ by more than 2 ** -64.
        best = min(own, key=lambda r: (-((r[1] << 64) // r[2]), r[0], r[2]), default=None)
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in own)
        yield (
            doc_id,
            len(own),
            *(best or (None, None, None)),
            1000 * best[1] // best[2] if best else None,
            hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(bodies[i].as_buffer()).hexdigest(),
            own,
            bodies[i].as_py().decode(),
        )


_DIGESTS = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long,"
    " runs_sha256 string, collapsed_sha256 string"
)
_RUNS = "runs array<struct<start:long,length:long,period:long>>"


def find_runs(docs: DataFrame) -> DataFrame:
    """doc_id, figures and digests of each document, its runs and the text without repetitions.

    A run is a stretch of words with smallest period q, of LEAST_WORDS words and LEAST_PERIODS * q
    at least, that cannot be made longer. The collapsed text has one space between words and lacks
    those that a run holds behind its first q. start, length, period and exponent_milli are of
    the run with the most periods (then: first, then shortest period), null without a run. Null
    and empty texts have no words and no runs; repeated rows get equal rows; a null doc_id is kept;
    other columns are not read; no rows give none. A text is worked on whole; it takes about a
    hundred bytes of memory a word.
    """
    return _found(docs, False, f"{_DIGESTS}, {_RUNS}, collapsed string", 10)


def digests(docs: DataFrame) -> DataFrame:
    """What find_runs gives for documents of which a tenth had a repetition planted, as digests."""
    return _found(docs, True, _DIGESTS, 8)


def _found(docs: DataFrame, change: bool, ddl: str, width: int) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for piece in _slices(batch):
                for row in _reports(piece, change):
                    yield row[:width]

    return map_rows(docs.select(*doc_columns()), rows, ddl)
