"""Language identification by nearest centroid.

A text becomes a TF-IDF vector of its byte bigrams and trigrams (lower case for A-Z, hashed to a
fixed number of features, normalised to length 1). Each language has a few centroids, found by
spherical k-means over its labelled texts; a text gets the language of the centroid with the
largest cosine. A text further from its nearest centroid than nearly all held-out texts of its
language and of its size is rejected. For that each half of a language's texts is judged by
centroids of the other half, whole and in windows of growing length, as short texts lie far off.

The model is fitted on the driver from at most PER_LANGUAGE vectors a language (a documented
sample: the labelled texts with the smallest hashed doc_id). Predictions read every whole text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skymart.cluster import ship
from skymart.llm.arrow import doc_texts, map_rows

FEATURES = 4096
PER_LANGUAGE = 600
CENTROIDS = 6
#: Part of a language's texts that are too odd to become a centroid's first member.
OUTLIERS = 0.02
ROUNDS = 8
RANK_PARTS = 64
#: A text is rejected below MARGIN times this quantile of the held-out cosines of its size.
LOW = 0.01
MARGIN = 0.75
#: Sizes at which that is taken (straight lines lie between; smaller texts can't be judged,
#: larger ones are taken with the last), and held-out texts needed for one.
SIZES = 2 ** np.arange(2, 10)
FEW = 20
#: Bytes of the held-out windows.
WINDOWS = tuple(2**k for k in range(2, 13))
#: A text's size is its distinct n-grams, but repeats count too up to this.
REPEATS = 80
UNDETERMINED = "und"
#: Bytes of text worked on at a time; a longer text is counted piece by piece.
PIECE = 1 << 18
_LETTER = regex.compile(r"\p{L}")
_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32


def _counts(data: np.ndarray) -> np.ndarray:
    """Feature counts of one text's bytes."""
    total = np.zeros(FEATURES, np.float32)
    for at in range(0, max(1, len(data)), PIECE):
        low = _LOWER[data[at : at + PIECE + 2]]
        pairs = low[:-1] << 8 | low[1:]
        threes = pairs[:-1] << 8 | low[2:]
        grams = np.concatenate([(pairs | 1 << 24)[: PIECE], threes[: PIECE]])
        slots = (grams * np.uint32(2654435761)) >> np.uint32(20)
        total += np.bincount(slots, minlength=FEATURES)
    return total


def vectors(batch: pa.RecordBatch) -> Iterator[tuple[int | None, bool, np.ndarray]]:
    """doc_id, whether the text has a letter, and the counts, of each row."""
    ids = batch.column("doc_id")
    for i, text in enumerate(batch.column("text")):
        value = text.as_py()
        lettered = bool(value) and _LETTER.search(value) is not None
        data = np.frombuffer((value or "").encode("utf-8", "replace"), np.uint8)
        yield ids[i].as_py(), lettered, _counts(data) if lettered else np.zeros(FEATURES, np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.sqrt(np.einsum("ij,ij->i", rows, rows)), 1e-12)[:, None]


@dataclass
class Model:
    """Fitted centroids: one row each, with its language and the least cosine it accepts at SIZES."""

    languages: list[str]
    centroids: np.ndarray
    floors: np.ndarray
    idf: np.ndarray

    def weigh(self, counts: np.ndarray) -> np.ndarray:
        return _unit(np.log1p(counts) * self.idf)

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest centroid and the cosine, of each row; ties to the first one."""
        cosines = self.weigh(counts) @ self.centroids.T
        nearest = cosines.argmax(axis=1)
        return nearest, np.clip(cosines[np.arange(len(nearest)), nearest], 0.0, 1.0)

    def near(self, counts: np.ndarray, nearest: np.ndarray, cosines: np.ndarray) -> np.ndarray:
        """Whether each row is near enough to its centroid for its size."""
        sized = zip(_sizes(counts), nearest, strict=True)
        least = [np.interp(x, SIZES, self.floors[k], left=0.0) for x, k in sized]
        # A few n-grams over and over are no language: no window holds so few.
        told = ((counts > 0).sum(axis=1) >= SIZES[0]) | (counts.sum(axis=1) < REPEATS)
        return told & (cosines >= np.array(least))


def _sizes(counts: np.ndarray) -> np.ndarray:
    return np.maximum((counts > 0).sum(axis=1), np.minimum(counts.sum(axis=1), REPEATS))


def _cluster(rows: np.ndarray) -> np.ndarray:
    """Centroids by spherical k-means.

    It begins with the mean; each next centroid is a row far from those before, but for the OUTLIERS.
    """
    centroids = _unit(rows.mean(axis=0, keepdims=True))
    while len(centroids) < min(CENTROIDS, len(rows)):
        order = (rows @ centroids.T).max(axis=1).argsort(kind="stable")
        centroids = np.vstack([centroids, rows[order[int(OUTLIERS * len(rows))]]])
    for _ in range(ROUNDS):
        nearest = (rows @ centroids.T).argmax(axis=1)
        sums = [rows[nearest == k].sum(axis=0) for k in range(len(centroids))]
        centroids = _unit(np.vstack([s for s in sums if s.any()]))
    return centroids


def _windows(piece: bytes) -> Iterator[np.ndarray]:
    """The counts of one window of each length, at a place that depends on the text only."""
    place = crc32(piece)
    for size in WINDOWS:
        if size < len(piece):
            at = place % (len(piece) - size + 1)
            yield _counts(np.frombuffer(piece[at : at + size], np.uint8))


def _floors(counts: np.ndarray, pieces: list[bytes], idf: np.ndarray) -> np.ndarray:
    """The least cosine accepted at SIZES, from texts that the centroids don't know.

    Equal texts are in one half. A size with few held-out texts has the floor of the one below.
    """
    names: dict[bytes, int] = {}
    half = np.array([names.setdefault(row.tobytes(), len(names)) % 2 for row in counts])
    floors = np.zeros(len(SIZES))
    if len(names) < 2:
        return floors
    sizes, cosines = [], []
    for k in (0, 1):
        centroids = _cluster(_unit(np.log1p(counts[half != k]) * idf))
        for i in np.flatnonzero(half == k):
            judged = np.vstack([counts[i], *_windows(pieces[i])])
            sizes.append(_sizes(judged))
            cosines.append((_unit(np.log1p(judged) * idf) @ centroids.T).max(axis=1))
    sizes, cosines = np.concatenate(sizes), np.concatenate(cosines)
    last = 0.0
    for place, size in enumerate(SIZES):
        near = cosines[(sizes > size / 2) & ((sizes < size * 2) | (size == SIZES[-1]))]
        last = MARGIN * float(np.quantile(near, LOW)) if len(near) >= FEW else last
        floors[place] = last
    return np.minimum.accumulate(floors[::-1])[::-1]


def fit(docs: DataFrame, labelled: Column) -> Model | None:
    """Learn from the rows where labelled holds, that have a doc_id and a lang, and text with letters.

    None if there is no such row. Ids are ranked by parts of their hash first, then the few that are
    left of each language; only the texts of the chosen ones are moved.
    """
    usable = labelled & F.col("doc_id").isNotNull() & F.col("lang").isNotNull()
    learned = docs.filter(usable & F.col("text").rlike(r"\p{L}")).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", "lang"
    )
    order = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = learned.select("doc_id", "lang", order.alias("order"))
    for parts in (RANK_PARTS, 1):
        part = F.pmod("order", F.lit(parts))
        rank = F.row_number().over(Window.partitionBy("lang", part).orderBy("order", "doc_id"))
        chosen = chosen.withColumn("rank", rank).filter(F.col("rank") <= PER_LANGUAGE).drop("rank")
    # At most PER_LANGUAGE ids a language.
    chosen = learned.join(F.broadcast(chosen.drop("order")), ["doc_id", "lang"], "left_semi")
    chosen = chosen.select("doc_id", "text", "lang")

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for lang, text, (doc_id, _, counts) in zip(
                batch.column("lang").to_pylist(), batch.column("text"), vectors(batch), strict=True
            ):
                data = text.as_py().encode("utf-8", "replace")
                at = crc32(data) % max(1, len(data) - WINDOWS[-1])
                yield lang, doc_id, counts.tobytes(), data[at : at + WINDOWS[-1] + 1]

    sample = map_rows(chosen, rows, "lang string, doc_id long, counts binary, piece binary").collect()
    if not sample:
        return None
    sample.sort(key=lambda r: (r.lang, r.doc_id is None, r.doc_id or 0, r.counts))
    counts = np.frombuffer(b"".join(r.counts for r in sample), np.float32).reshape(-1, FEATURES)
    idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
    weighed = _unit(np.log1p(counts) * idf)
    languages, centroids, floors = [], [], []
    names = np.array([r.lang for r in sample], dtype=object)
    for lang in sorted(set(names)):
        own = _cluster(weighed[names == lang])
        languages += [lang] * len(own)
        centroids.append(own)
        pieces = [bytes(r.piece) for r in sample if r.lang == lang]
        floors += [_floors(counts[names == lang], pieces, idf)] * len(own)
    return Model(languages, np.vstack(centroids).astype(np.float32), np.array(floors), idf)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score (the cosine), rejected (boolean) of every whole text.

    A null text and one without a letter are `und` with score 0 and rejected, and so is every text
    if nothing could be learned. Repeated rows get equal predictions; a tie between centroids goes
    to the language that sorts first; columns other than doc_id and text are not read; no rows
    give none.
    """
    ddl = "doc_id long, lang_pred string, score double, rejected boolean"
    if model is None:
        return docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.lit(UNDETERMINED).alias("lang_pred"),
            F.lit(0.0).alias("score"),
            F.lit(True).alias("rejected"),
        )

    def label(rows: list[tuple[int | None, bool, np.ndarray]]) -> Iterator[tuple]:
        every = np.vstack([counts for *_, counts in rows])
        nearest, cosines = model.predict(every)
        near = model.near(every, nearest, cosines)
        for (doc_id, lettered, _), k, cosine, kept in zip(rows, nearest, cosines, near, strict=True):
            if not lettered:
                yield doc_id, UNDETERMINED, 0.0, True
            else:
                yield doc_id, model.languages[k], float(cosine), not bool(kept)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            waiting = []
            for row in vectors(batch):
                waiting.append(row)
                if len(waiting) == 128:
                    yield from label(waiting)
                    waiting = []
            if waiting:
                yield from label(waiting)

    return map_rows(doc_texts(docs), rows, ddl)


def accepted(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of docs, with all their columns, whose text is not rejected."""
    if model is None:
        return docs.limit(0)
    ship(docs.sparkSession)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain = pa.RecordBatch.from_arrays(
                [pa.array(range(batch.num_rows)), batch.column("text")], names=["doc_id", "text"]
            )
            for a in range(0, batch.num_rows, 128):
                own = list(vectors(plain.slice(a, 128)))
                every = np.vstack([counts for *_, counts in own])
                kept = model.near(every, *model.predict(every)) & np.array([lettered for _, lettered, _ in own])
                yield batch.slice(a, len(own)).filter(pa.array(kept))

    return docs.mapInArrow(keep, docs.schema)


def remainder(doc_id: Column, modulus: int) -> Column:
    """The fold of a document: crc32 of its doc_id as text."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus
