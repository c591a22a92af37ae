"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

A word is a point: how often each letter occurs in it. One replaced letter takes one from a count and adds one
to another, an inserted or deleted one changes one count by one, whatever the order of the letters. So the near
words of a word lie within an L1 distance of two, and for each pair of lengths it is known which counts
may be over or under. Each length has a k-d tree. Its top, fitted on a bounded sample of the
words, deals all words over cells; a word asks every cell whose box is near enough, in the tree of
its own length and of the two next to it. Each cell is a group of Spark's, where a tree over its own
words is searched the same way down to small leaves; there the order of letters decides.

Answers leave a cell as one row for each asking word, so that no row is made for a pair.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skymart.cluster import settle, ship
from skymart.llm.arrow import arrow_schema, doc_columns, map_rows, packed
from skymart.operators.skew import heat, salted_lookup

#: Fixed values of the contract: letters of a run, least length and occurrences, and times as frequent.
LETTERS = "[a-zÀ-ÿ]"
LEAST_CHARS, LEAST_COUNT, TIMES = 7, 2, 10
DELETED = 31
#: Words that fit the tops of the trees (a sample by hash), and about how many a cell holds. The sample
#: bounds the cells to SAMPLE / SAMPLE_OF_CELL; with more words cells grow, and hot ones are dealt.
SAMPLE, SAMPLE_OF_CELL, CELL_WORDS = 65_536, 16, 65_536
_HASHES = 1 << 30
#: Words of a leaf inside a cell; a larger leaf is one of words with equal letters.
LEAF_WORDS, LARGE_LEAF = 32, 256
#: Pairs of words whose letters are compared at once, times their length.
COMPARED_BYTES = 16 << 20
COUNTED_WORDS = 4096
_MOST = 255
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def runs(docs: DataFrame) -> DataFrame:
    """Runs of LEAST_CHARS letters at least, A-Z lower-cased, of which one in DELETED lacks one."""
    doc_id, text = doc_columns()
    lowered = F.translate(text, _CAPITALS, _CAPITALS.lower())
    # Shorter runs give no words, and a run of that length is matched from its first letter on.
    found = F.regexp_extract_all(lowered, F.lit(f"{LETTERS}{{{LEAST_CHARS},}}"), F.lit(0))
    rows = docs.select(doc_id, F.explode(found).alias("run"))
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    rows = rows.withColumn("h", F.crc32(named.cast("binary")))
    at = F.pmod("h", F.char_length("run")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return rows.select(F.when(F.col("h") % DELETED == 0, short).otherwise(F.col("run")).alias("word"))


def vocabulary(found: DataFrame) -> DataFrame:
    """word and n of the words with LEAST_CHARS code points and LEAST_COUNT occurrences."""
    long = found.filter(F.char_length("word") >= LEAST_CHARS)
    return long.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def letter_counts(words: list[bytes]) -> np.ndarray:
    """A row for each word: how often each of 256 letters occurs, up to 255 times."""
    result = np.empty((len(words), 256), np.uint8)
    for begin in range(0, len(words), COUNTED_WORDS):
        some = words[begin : begin + COUNTED_WORDS]
        row = np.repeat(np.arange(len(some)) * 256, [len(w) for w in some])
        counts = np.bincount(row + np.frombuffer(b"".join(some), np.uint8), minlength=256 * len(some))
        result[begin : begin + len(some)] = np.minimum(counts, _MOST).reshape(-1, 256)
    return result


class Leaf(NamedTuple):
    number: int
    members: np.ndarray


class Split(NamedTuple):
    letter: int
    most: int
    below: Split | Leaf
    above: Split | Leaf


def grow(counts: np.ndarray, leaf_size: int) -> Split | Leaf:
    """A k-d tree: each split takes the letter whose counts vary most, at their median."""
    leaves = 0
    letters = np.flatnonzero(counts.any(axis=0))

    def node(members: np.ndarray) -> Split | Leaf:
        nonlocal leaves
        if len(members) > leaf_size:
            letter = int(letters[np.argmax(counts[np.ix_(members, letters)].var(axis=0))])
            column = counts[members, letter]
            low, high = int(column.min()), int(column.max())
            if low < high:
                most = min(int(np.median(column)), high - 1)
                below = column <= most
                return Split(letter, most, node(members[below]), node(members[~below]))
        leaves += 1
        return Leaf(leaves - 1, members)

    return node(np.arange(len(counts)))


def homes(tree: Split | Leaf, counts: np.ndarray) -> np.ndarray:
    """The number of the leaf in whose box each point lies."""
    result = np.zeros(len(counts), np.int64)

    def down(node: Split | Leaf, asking: np.ndarray) -> None:
        if isinstance(node, Leaf):
            result[asking] = node.number
        elif len(asking):
            below = counts[asking, node.letter] <= node.most
            down(node.below, asking[below])
            down(node.above, asking[~below])

    down(tree, np.arange(len(counts)))
    return result


def boxes(
    tree: Split | Leaf, counts: np.ndarray, over: int, under: int
) -> Iterator[tuple[Leaf, np.ndarray]]:
    """Each leaf with the points whose counts are at most so much over and under its box in all."""
    lows, highs = np.zeros(256, np.int64), np.full(256, _MOST, np.int64)

    def down(node: Split | Leaf, asking: np.ndarray, is_over: np.ndarray, is_under: np.ndarray):
        if not len(asking):
            return
        if isinstance(node, Leaf):
            yield node, asking
            return
        letter, own = node.letter, counts[asking, node.letter].astype(np.int64)
        low, high = int(lows[letter]), int(highs[letter])
        # Left of the split the box ends at most, right of it it begins one above.
        more = is_over + np.maximum(own - node.most, 0) - np.maximum(own - high, 0)
        near = more <= over
        highs[letter] = node.most
        yield from down(node.below, asking[near], more[near], is_under[near])
        highs[letter] = high
        less = is_under + np.maximum(node.most + 1 - own, 0) - np.maximum(low - own, 0)
        near = less <= under
        lows[letter] = node.most + 1
        yield from down(node.above, asking[near], is_over[near], less[near])
        lows[letter] = low

    none = np.zeros(len(counts), np.int64)
    yield from down(tree, np.arange(len(counts)), none, none)


def reach(longer: int) -> tuple[int, int]:
    """How far a word's counts may be over and under those of a near word, longer by so much."""
    return {-1: (1, 0), 0: (1, 1), 1: (0, 1)}[longer]


def _sketches(rows: np.ndarray) -> np.ndarray:
    """64 bits of each word: each count of a letter flips one, so an L1 distance flips no more."""
    letters = np.sort(rows, axis=1).astype(np.int64)
    place = np.broadcast_to(np.arange(letters.shape[1]), letters.shape)
    first = np.ones(letters.shape, bool)
    first[:, 1:] = letters[:, 1:] != letters[:, :-1]
    nth = place - np.maximum.accumulate(np.where(first, place, 0), axis=1)
    bit = ((letters * 37 + nth * 53) % 64).astype(np.uint64)
    return np.bitwise_xor.reduce(np.uint64(1) << bit, axis=1)


def _matrix(words: list[bytes], length: int) -> np.ndarray:
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), length)


def _one_edit(asking: np.ndarray, points: np.ndarray) -> np.ndarray:
    """For each pair of rows: whether one edit makes them equal."""
    size = points.shape[1] - asking.shape[1]
    if size == 0:
        return (asking != points).sum(axis=1) == 1
    longer, shorter = (points, asking) if size > 0 else (asking, points)
    # One letter of the longer goes: equal up to there, and equal shifted by one behind it.
    unlike = longer[:, :-1] != shorter
    first = np.where(unlike.any(axis=1), unlike.argmax(axis=1), shorter.shape[1])
    shifted = (longer[:, 1:] != shorter)[:, ::-1]
    last = np.where(shifted.any(axis=1), shorter.shape[1] - 1 - shifted.argmax(axis=1), -1)
    return last < first


def _without_one(word: bytes, placed: bool) -> set:
    """The word without each of its letters in turn, with the place if it matters."""
    return {(i if placed else 0, word[:i] + word[i + 1 :]) for i in range(len(word))}


def _by_masks(points: list[bytes], asking: list[bytes]) -> Iterator[tuple[int, int]]:
    """Near pairs of a leaf that no split divides, in time linear in both sides."""
    size = len(points[0]) - len(asking[0])
    places: dict[tuple[int, bytes], list[int]] = {}
    for p, word in enumerate(points):
        for key in _without_one(word, size == 0) if size >= 0 else {(0, word)}:
            places.setdefault(key, []).append(p)
    for q, word in enumerate(asking):
        for key in _without_one(word, size == 0) if size <= 0 else {(0, word)}:
            for p in places.get(key, ()):
                if points[p] != word:
                    yield q, p


def near_pairs(points: list[bytes], asking: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of asking words and of points one edit apart; each side has words of one length."""
    if not points or not asking:
        return
    size = len(points[0]) - len(asking[0])
    over, under = reach(size)
    tree = grow(letter_counts(points), LEAF_WORDS)
    rows, others = _matrix(asking, len(asking[0])), _matrix(points, len(points[0]))
    own, theirs = _sketches(rows), _sketches(others)
    at_once = max(1, COMPARED_BYTES // len(points[0]))
    for leaf, near in boxes(tree, letter_counts(asking), over, under):
        members = leaf.members
        if len(members) > LARGE_LEAF:
            pairs = list(_by_masks([points[p] for p in members], [asking[q] for q in near]))
            if pairs:
                q, p = np.array(pairs).T
                yield near[q], members[p]
            continue
        for begin in range(0, len(near), at_once // len(members) + 1):
            some = near[begin : begin + at_once // len(members) + 1]
            flips = np.bitwise_count(own[some][:, None] ^ theirs[members][None, :])
            q, p = np.nonzero(flips <= over + under)
            q, p = some[q], members[p]
            right = _one_edit(rows[q], others[p])
            yield q[right], p[right]


def _answers(points: list[bytes], counts: np.ndarray, asking: list[bytes]) -> Iterator[tuple]:
    """For each asking word with near points: word, their number, and n and word of the best."""
    pairs = list(near_pairs(points, asking))
    if not pairs:
        return
    q, p = (np.concatenate(x) for x in zip(*pairs, strict=True))
    if not len(q):
        return
    place = np.empty(len(points), np.int64)
    place[sorted(range(len(points)), key=points.__getitem__)] = np.arange(len(points))
    order = np.lexsort((place[p], -counts[p], q))
    q, p = q[order], p[order]
    heads = np.flatnonzero(np.append(True, q[1:] != q[:-1]))
    sizes = np.diff(np.append(heads, len(q)))
    for head, size in zip(heads.tolist(), sizes.tolist(), strict=True):
        best = int(p[head])
        yield (
            asking[q[head]].decode("latin-1"), size, int(counts[best]), points[best].decode("latin-1"),
        )


class Forest:
    """The tops of the trees by length, and over how many tasks the words of a hot cell are dealt."""

    def __init__(self, sample: list[bytes], words: int) -> None:
        cells = max(1, words // CELL_WORDS)
        leaf_size = max(SAMPLE_OF_CELL, -(-len(sample) // cells))
        by_length: dict[int, list[bytes]] = {}
        for word in sorted(sample):
            by_length.setdefault(len(word), []).append(word)
        self.trees = {k: _plain(grow(letter_counts(own), leaf_size)) for k, own in by_length.items()}
        self.parts: dict[tuple[int, int], int] = {}

    def at_home(self, length: int, counts: np.ndarray) -> np.ndarray:
        return homes(self.trees.get(length, _ONE), counts)

    def asked(self, length: int, longer: int, counts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        for leaf, asking in boxes(self.trees.get(length + longer, _ONE), counts, *reach(longer)):
            yield leaf.number, asking


def _plain(node: Split | Leaf) -> Split | Leaf:
    """The tree without its sample."""
    if isinstance(node, Leaf):
        return Leaf(node.number, np.zeros(0, np.int64))
    return Split(node.letter, node.most, _plain(node.below), _plain(node.above))


_ONE = Leaf(0, np.zeros(0, np.int64))
Dealt = Callable[[int, list[tuple[bytes, int]]], Iterable[tuple]]


def _by_length(rows: Dealt) -> Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]]:
    """Batches of word and n as lists of words of one length."""

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            own: dict[int, list[tuple[bytes, int]]] = {}
            for word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own.setdefault(len(word), []).append((word.encode("latin-1"), n))
            for length, words in own.items():
                yield from rows(length, words)

    return every


def _dealt(forest: Forest) -> Dealt:
    """A word stands in its cell, in one of the parts of a hot one, and asks all near cells."""

    def rows(length: int, words: list[tuple[bytes, int]]) -> Iterator[tuple]:
        counts = letter_counts([w for w, _ in words])
        for (word, n), leaf in zip(words, forest.at_home(length, counts).tolist(), strict=True):
            part = zlib.crc32(word) % forest.parts.get((length, leaf), 1)
            yield length, leaf, part, True, word.decode("latin-1"), n
        for longer in (-1, 0, 1):
            for leaf, asking in forest.asked(length, longer, counts):
                parts = forest.parts.get((length + longer, leaf), 0)
                for part in range(parts):
                    for q in asking.tolist():
                        yield length + longer, leaf, part, False, words[q][0].decode("latin-1"), 0

    return rows


def _cell(table: pa.Table) -> Iterator[tuple]:
    words = [w.encode("latin-1") for w in table.column("word").to_pylist()]
    stands = table.column("stands").to_pylist()
    n = table.column("n").to_numpy()
    points = [w for w, own in zip(words, stands, strict=True) if own]
    counts = n[np.array(stands, bool)]
    asking: dict[int, list[bytes]] = {}
    for word, own in zip(words, stands, strict=True):
        if not own:
            asking.setdefault(len(word), []).append(word)
    if points:
        for own in asking.values():
            yield from _answers(points, counts, own)


_ANSWERS = "word string, near long, best_n long, best string"


def near_words(words: DataFrame) -> DataFrame:
    """word, near (how many words are one edit away), best_n and best (the most frequent of them).

    words has word (distinct, of letters up to U+00FF) and n. Words without near ones have no row.
    """
    total = words.count()
    share = min(_HASHES, int(SAMPLE / max(total, 1) * _HASHES))
    by_hash = F.pmod(F.xxhash64("word"), F.lit(_HASHES)) < share
    sample = words.filter(by_hash).select("word").limit(2 * SAMPLE).collect()
    forest = Forest([r.word.encode("latin-1") for r in sample], total)

    def stands(length: int, own: list[tuple[bytes, int]]) -> Iterator[tuple]:
        cells = forest.at_home(length, letter_counts([w for w, _ in own]))
        for leaf, size in zip(*np.unique(cells, return_counts=True), strict=True):
            yield length, int(leaf), int(size)

    pair = words.select("word", "n")
    sizes = map_rows(pair, _by_length(stands), "length int, leaf int, size long")
    for row in sizes.groupBy("length", "leaf").agg(F.sum("size").alias("size")).collect():
        forest.parts[row.length, row.leaf] = -(-row.size // (4 * CELL_WORDS))
    dealt = map_rows(
        pair, _by_length(_dealt(forest)),
        "length int, leaf int, part int, stands boolean, word string, n long",
    )
    schema = arrow_schema(words, _ANSWERS)

    def answers(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(packed(_cell(table), schema)), schema)

    ship(words.sparkSession)
    # Rows are few bytes and much work: a task for each cell, whatever adaptive execution makes of bytes.
    cell = ("length", "leaf", "part")
    dealt = dealt.repartition(max(1, sum(forest.parts.values())), *cell)
    found = dealt.groupBy(*cell).applyInArrow(answers, _ANSWERS)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best")))
    found = found.groupBy("word").agg(F.sum("near").alias("near"), best.alias("best"))
    return found.select("word", "near", (-F.col("best.less")).alias("best_n"), "best.best")


def variants(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word.

    The form of a word is its most frequent near word (ties: the smallest in code points), if that is TIMES as
    frequent at least, else null. root follows forms to the last one; as each is more frequent than
    the one before, no chain is a circle, and it has as many steps as n has digits at most.
    """
    words = settle(words)
    joined = words.join(near_words(words).withColumnRenamed("word", "asked"), F.col("word") == F.col("asked"), "left")
    formed = F.col("best_n") >= TIMES * F.col("n")
    rows = settle(
        joined.select(
            "word",
            F.when(formed, F.col("best")).alias("form"),
            "n",
            F.coalesce("near", F.lit(0)).alias("n_near"),
            F.when(formed, F.col("best_n")).alias("form_n"),
        )
    )
    known = rows.select("word", F.col("form").alias("root")).filter("root is not null")
    moved = known.withColumn("moved", F.lit(True))
    while not moved.filter("moved").isEmpty():
        # Each round doubles the steps; a root that is no variant stays.
        ahead = known.select(F.col("word").alias("step"), F.col("root").alias("next"))
        hot = heat(known, "root")
        found = salted_lookup(known, hot, ahead, "root", "step", F.xxhash64("word"), "left")
        root = F.coalesce("next", "root").alias("root")
        moved = settle(found.select("word", root, F.col("next").isNotNull().alias("moved")))
        known = moved.drop("moved")
    rooted = known.withColumnRenamed("word", "variant")
    rows = rows.join(rooted, F.col("word") == F.col("variant"), "left")
    root = F.coalesce("root", "word").alias("root")
    return rows.select("word", "form", root, "n", "n_near", "form_n")
