"""Token counts by count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists the vocabulary's pieces that end at each character. Dynamic
programming keeps, for each place, the best score and the number of pieces on its best path; no
path is stored. Ties follow the tokenizers library: starts are tried from left to right and only
a strictly better score replaces an earlier one, so the longest last piece wins; a character that
is no piece by itself may also be unknown, at the lowest score less 10, and is spelled in bytes.

No piece holds a space mark behind another character. So each run of marks with the word behind
it is segmented by itself, and frequent words are counted once. Scores are whole numbers, sums of
which are exact.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from skymart.llm.arrow import doc_texts, map_rows, texts

#: Fixed values of the vocabulary: the mark that stands for a space, and the unknown penalty.
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED = 400_000
_RUNS = re.compile(f"{SPACE}+[^{SPACE}]*")
_LOWEST = float("-inf")


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a model file, without control, unknown and byte pieces."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        (model.id_to_piece(i), model.get_score(i))
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]


class Counter:
    """Counts the pieces of a text's best segmentation."""

    def __init__(self, pieces: Iterable[tuple[str, float]]) -> None:
        self.automaton = ahocorasick.Automaton()
        scores = []
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
            scores.append(score)
        self.automaton.make_automaton()
        self.unknown = min(scores, default=0.0) - UNKNOWN_PENALTY
        self.single = {p for p, *_ in self.automaton.items() if len(p) == 1}
        self.known: dict[str, int] = {}

    def run(self, run: str) -> int:
        """Pieces of one run; an unknown character counts as many as it has bytes."""
        size = len(run)
        ending: list[list[tuple[int, float]]] = [[] for _ in range(size)]
        for end, piece in self.automaton.iter(run):
            ending[end].append(piece)
        best, count = [0.0] * (size + 1), [0] * (size + 1)
        for end in range(size):
            top, pieces = _LOWEST, 0
            options = ending[end]
            if run[end] not in self.single:
                options = [*options, (1, self.unknown)]
            for length, score in sorted(options, reverse=True):
                start = end + 1 - length
                if (candidate := best[start] + score) > top:
                    top, pieces = candidate, count[start] + 1
                    if score == self.unknown:
                        pieces += len(run[end].encode("utf-8", "replace")) - 1
            best[end + 1], count[end + 1] = top, pieces
        return count[size]

    def text(self, text: str) -> int:
        """Pieces of a whole text; the vocabulary puts one space before it, an empty one has none."""
        if not text:
            return 0
        known, total = self.known, 0
        for run in _RUNS.findall(SPACE + text.replace(" ", SPACE)):
            if (pieces := known.get(run)) is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                pieces = self.run(run)
                if len(run) <= 256:
                    known[run] = pieces
            total += pieces
        return total


@lru_cache(maxsize=2)
def _counter(pieces: tuple[tuple[str, float], ...]) -> Counter:
    return Counter(pieces)


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and n_bytes (UTF-8) of every whole text.

    Null and empty texts have no tokens. Repeated rows, ties and other columns make no difference;
    no rows give none. The vocabulary (a fixed file of 32,000 pieces) is sent to every worker.
    """
    pieces = docs.sparkSession.sparkContext.broadcast(tuple(vocabulary(path)))

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        counter = _counter(pieces.value)
        for doc_id, text in texts(batches):
            yield doc_id, counter.text(text), len(text.encode("utf-8", "surrogatepass"))

    return map_rows(doc_texts(docs), rows, "doc_id long, n_tokens long, n_bytes long")
