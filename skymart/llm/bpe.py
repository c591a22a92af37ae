"""BPE encoding and decoding with a public word-level vocabulary.

Each word holds a contiguous array of part boundaries (here: the parts' ids) and an array of the
ranks of adjacent parts. The smallest rank is searched, its boundary deleted, and the two
neighbouring ranks looked up anew, until no adjacent parts can be merged. Words are short, so
scanning beats any queue; words beyond LONG_WORD parts use a queue with the same order (rank,
then place), which keeps very long ones from taking quadratic time.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skymart.llm.arrow import doc_columns, doc_texts, map_rows, texts

LONG_WORD = 512
#: Distinct words remembered by a worker; beyond that it forgets all and goes on.
REMEMBERED = 300_000
#: Where the ids are handed on as well, which take memory of their own.
REMEMBERED_BESIDE_IDS = 100_000
NO_RANK = 1 << 60

#: The words of the vocabulary's pre-tokenizer, and the mark of a word's end.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
END = "</w>"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the rest from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class WordBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, content: str, remembered: int = REMEMBERED) -> None:
        self.remembered = remembered
        model = json.loads(content)
        vocabulary: dict[str, int] = model["model"]["vocab"]
        special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.token_of = {i: t for t, i in [*vocabulary.items(), *special.items()]}
        letters = byte_letters()
        self.first_ids = [vocabulary[x] for x in letters]
        self.end_ids = [vocabulary[x + END] for x in letters]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocabulary[a], vocabulary[b]] = (rank, vocabulary[a + b])
        self.special = special
        self.special_split = re.compile("(" + "|".join(map(re.escape, special)) + ")")
        self.by_word: dict[str, list[int]] = {}
        self.by_chunk: dict[bytes, tuple[int, bytes, bytes]] = {}

    def forget(self) -> None:
        """Drop the remembered words; the vocabulary stays."""
        self.by_word.clear()
        self.by_chunk.clear()

    def merge_word(self, data: bytes) -> list[int]:
        parts = [self.first_ids[b] for b in data]
        parts[-1] = self.end_ids[data[-1]]
        if len(parts) > LONG_WORD:
            return self._merge_long(parts)
        merges = self.merges
        none = (NO_RANK, 0)
        ranks = [merges.get(pair, none) for pair in zip(parts, parts[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best is none:
                break
            at = ranks.index(best)
            parts[at] = best[1]
            del parts[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = merges.get((parts[at], parts[at + 1]), none)
            if at:
                ranks[at - 1] = merges.get((parts[at - 1], parts[at]), none)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        merges, size = self.merges, len(parts)
        after, before = [*range(1, size), -1], [-1, *range(size - 1)]
        queue = [
            (*merges[pair], at, *pair)
            for at, pair in enumerate(zip(parts, parts[1:], strict=False))
            if pair in merges
        ]
        queue = [(rank, at, new, a, b) for rank, new, at, a, b in queue]
        heapq.heapify(queue)
        while queue:
            _, at, new, a, b = heapq.heappop(queue)
            nxt = after[at]
            if parts[at] != a or nxt < 0 or parts[nxt] != b:
                continue
            parts[at], parts[nxt] = new, -1
            after[at] = after[nxt]
            if after[at] >= 0:
                before[after[at]] = at
            for left in (before[at], at):
                right = after[left] if left >= 0 else -1
                if right >= 0 and (merge := merges.get((parts[left], parts[right]))):
                    heapq.heappush(queue, (merge[0], left, merge[1], parts[left], parts[right]))
        return [p for p in parts if p >= 0]

    def _word(self, word: str) -> list[int]:
        if (known := self.by_word.get(word)) is None:
            if len(self.by_word) >= self.remembered:
                self.by_word.clear()
            known = self.by_word[word] = self.merge_word(word.encode())
        return known

    def encode_chunk(self, chunk: str) -> list[int]:
        """Ids of text that holds no ASCII white space."""
        ids: list[int] = []
        for piece in self.special_split.split(chunk) if "<|" in chunk else (chunk,):
            if piece in self.special:
                ids.append(self.special[piece])
                continue
            if not piece.isascii():
                # Character by character: the final sigma has no rule of its own.
                piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ")
            for word in WORDS.findall(piece.lower()):
                ids += self._word(word)
        return ids

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.spelled(text)[1].split(), np.int32)

    def decode(self, ids: Iterable[int]) -> str:
        """Tokens joined by spaces: the vocabulary names no decoder."""
        return " ".join(self.token_of[i] for i in ids)

    def spelled(self, text: str) -> tuple[int, bytes, bytes]:
        """Number of ids, the ids in decimal, and the decoded text, both joined by spaces."""
        known, count = self.by_chunk, 0
        ids, decoded = [], []
        for chunk in text.encode("utf-8", "replace").split():
            if (entry := known.get(chunk)) is None:
                entry = self._chunk_entry(chunk)
            if entry[0]:
                count += entry[0]
                ids.append(entry[1])
                decoded.append(entry[2])
        return count, b" ".join(ids), b" ".join(decoded)

    def _chunk_entry(self, chunk: bytes) -> tuple[int, bytes, bytes]:
        if len(self.by_chunk) >= self.remembered:
            self.by_chunk.clear()
        ids = self.encode_chunk(chunk.decode())
        entry = len(ids), " ".join(map(str, ids)).encode(), self.decode(ids).encode()
        if len(chunk) <= LONG_WORD:
            self.by_chunk[chunk] = entry
        return entry


@lru_cache(maxsize=2)
def _loaded(content: str, remembered: int = REMEMBERED) -> WordBpe:
    return WordBpe(content, remembered)


def _vocabulary(path: str) -> str:
    """The vocabulary file's content, which every task gets: under 2 MB, as it does not grow."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(docs: DataFrame, path: str, carried: Sequence[str] = ()) -> DataFrame:
    """doc_id, the carried columns, n_tokens, ids array<int>, and two digests of every whole text.

    ids_sha256 is the digest of the decimal ids joined by one space, decoded_sha256 that of the
    text decoded from them. A null or empty text has no ids, and the digests of an empty string.
    Nulls, ties, repeated rows and other columns make no difference to a row; no rows give none.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(_vocabulary(path))

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        bpe = _loaded(vocabulary.value, REMEMBERED_BESIDE_IDS)
        for batch in batches:
            others = [batch.column(f"carried_{k}").to_pylist() for k in range(len(carried))]
            for at, (doc_id, text) in enumerate(texts([batch])):
                count, ids, decoded = bpe.spelled(text)
                digests = hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()
                numbers = np.array(ids.split(), np.int32)
                yield doc_id, *(o[at] for o in others), count, numbers, *digests
        # The worker may wait beside the next stage of a pipeline.
        bpe.forget()

    own = [F.col(c).alias(f"carried_{k}") for k, c in enumerate(carried)]
    wanted = docs.select(*doc_columns(), *own)
    kinds = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carried)
    ddl = f"doc_id long{kinds}, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string"
    return map_rows(wanted, rows, ddl)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of every row of ids, special tokens included; null ids give an empty text."""
    vocabulary = encoded.sparkSession.sparkContext.broadcast(_vocabulary(path))

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        bpe = _loaded(vocabulary.value)
        for batch in batches:
            ids = batch.column("ids")
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                yield doc_id, bpe.decode(ids[i].as_py() or [])

    wanted = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids")
    return map_rows(wanted, rows, "doc_id long, text string")


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """encode() without the ids: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(_vocabulary(path))

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        bpe = _loaded(vocabulary.value)
        for doc_id, text in texts(batches):
            count, ids, decoded = bpe.spelled(text)
            yield doc_id, count, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()

    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_rows(doc_texts(docs), rows, ddl)
