"""64-bit hashes of the words of whole texts, computed on arrays of bytes.

A word is a run of bytes other than ASCII white space, lower-cased for A-Z. Its hash is a
polynomial of random byte values, taken from prefix sums over the text, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes worked on at a time; a longer text is cut behind white space.
PIECE = 1 << 19
_SEED = 7919
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _byte_values() -> np.ndarray:
    values = np.random.default_rng(_SEED).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
    values[65:91] = values[97:123]
    return values


_VALUES = _byte_values()
_SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BASE = np.uint64(0xD6E8FEB86659FD93)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, base))])


_tables: dict[str, np.ndarray] = {}


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_tables.get("up", ())) < size:
        _tables["up"], _tables["down"] = _powers(_BASE, size), _powers(_BASE_INVERSE, size)
    return _tables["up"], _tables["down"]


def mix(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """One hash of two, which depends on their order."""
    z = x * _ODD + y
    z ^= z >> np.uint64(29)
    z *= _MIX
    z ^= z >> np.uint64(32)
    return z


def _piece(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words in data; no word reaches over an edge."""
    word = ~_SPACES[data]
    begins, ends = np.empty(len(data), bool), np.empty(len(data), bool)
    begins[0], ends[-1] = word[0], word[-1]
    np.logical_and(word[1:], ~word[:-1], out=begins[1:])
    np.logical_and(word[:-1], ~word[1:], out=ends[:-1])
    inner = edges[(edges > 0) & (edges < len(data))]
    begins[inner] = word[inner]
    ends[inner - 1] |= word[inner - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _power_tables(max(len(data), PIECE) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * up[: len(data)], out=sums[1:])
    hashes = (sums[stops] - sums[starts]) * down[starts]
    return mix(hashes, (stops - starts).astype(np.uint64)), starts


def _text_bounds(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a batch's texts, and where each begins, and the end of the last."""
    column = batch.column("text").fill_null("").cast(pa.large_string())
    column = pa.concat_arrays([column])
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_[bounds[0] : bounds[-1]], bounds - bounds[0]


def hashed_texts(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Groups of whole documents of a batch: the first's index, word hashes, words of each.

    The hashes of a group's documents follow each other.
    """
    data, bounds = _text_bounds(batch)
    at, rows = 0, len(bounds) - 1
    while at < rows:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + PIECE, "right")) - 1)
        to = min(to, rows)
        own = data[bounds[at] : bounds[to]]
        edges = bounds[at : to + 1] - bounds[at]
        if len(own) == 0:
            yield at, np.zeros(0, np.uint64), np.zeros(to - at, np.int64)
        elif len(own) <= 2 * PIECE:
            hashes, starts = _piece(own, edges)
            yield at, hashes, np.diff(np.searchsorted(starts, edges))
        else:
            hashes = np.concatenate([_piece(x, edges[:1])[0] for x in _cut(own)])
            yield at, hashes, np.array([len(hashes)])
        at = to


def _cut(data: np.ndarray) -> Iterable[np.ndarray]:
    """One long text in pieces that end with white space (or at its end)."""
    at = 0
    while at < len(data):
        to = min(len(data), at + PIECE)
        while to < len(data):
            gaps = np.flatnonzero(_SPACES[data[at:to]])
            if len(gaps):
                to = at + int(gaps[-1]) + 1
                break
            to = min(len(data), to + PIECE)
        yield data[at:to]
        at = to


def hash_words(words: Iterable[bytes]) -> np.ndarray:
    """The hash of each word, as hashed_texts gives it."""
    return np.array(
        [_piece(np.frombuffer(w, np.uint8), np.zeros(0, np.int64))[0][0] for w in words], np.uint64
    )
