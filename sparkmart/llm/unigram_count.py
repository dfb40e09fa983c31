"""Counting unigram tokens without building them: Aho-Corasick matches and a Viterbi pass that carries counts.

The automaton lists, end by end, every vocabulary piece in a word; the pass keeps for each end the best score and how
many pieces the best path has. Ties follow the tokenizer exactly: a piece replaces another with the same end only with a
higher score, and earlier starts come first, so the longest wins. A character that is no piece of its own may be passed as
unknown at the lowest score less ten, and counts as many pieces as its UTF-8 bytes (byte fallback). Words are what the
tokenizer cuts at spaces, each with a marked space in front; no piece of a word reaches into another, so a text's score
and count are sums over its words and frequent words are worked out once per worker.

Scores are the ranks of the vocabulary file taken as whole numbers, so their sums are exact. A null text counts as empty
(0 pieces, score 0). All other columns pass through; rows are independent of each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from public_tokenizers import path
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sparkmart.llm.frames import col, with_column

VOCABULARY = "piece_bpe_32k.model"
SPACE = "▁"
UNKNOWN, UNKNOWN_PENALTY = 0, 10.0
_CACHED, _LONGEST = 400_000, 64


def vocabulary(name: str = VOCABULARY) -> list[tuple[str, float]]:
    """(piece, score) by id."""
    model = sentencepiece.SentencePieceProcessor(model_file=path(name))
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter:
    def __init__(self, pieces: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for i, (piece, score) in enumerate(pieces):
            self.automaton.add_word(piece, (len(piece), score, i == UNKNOWN))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.known: dict[str, tuple[int, float]] = {}

    def word(self, word: str) -> tuple[int, float]:
        """(pieces, score) of the best path through one word.

        Neighbouring unknowns are one piece to the tokenizer, which falls back to its bytes; ``run`` has the bytes of
        such a run up to an end, and ``count`` the pieces with that run, which is one piece only if it is the unknown
        mark itself, spelled out.
        """
        n = len(word)
        ends: list[list[tuple[int, float, bool]]] = [[] for _ in range(n + 1)]
        for last, value in self.automaton.iter(word):
            ends[last + 1].append(value)
        best, count, run, lone = [0.0] * (n + 1), [0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for end in range(1, n + 1):
            top, begin, single, mark = -1e300, 0, False, False
            for length, score, is_mark in ends[end]:
                total = best[end - length] + score
                if total > top or (total == top and length > begin):
                    top, begin, mark = total, length, is_mark
                if length == 1:
                    single = True
            if not single and best[end - 1] + self.unknown > top:
                top, begin, mark = best[end - 1] + self.unknown, 1, True
            best[end] = top
            before = end - begin
            if not mark:
                count[end] = count[before] + 1
                continue
            run[end] = run[before] + len(word[before:end].encode("utf-8", "surrogatepass"))
            if run[before]:
                count[end] = count[before] - (1 if lone[before] else run[before]) + run[end]
            else:
                lone[end] = begin > 1
                count[end] = count[before] + (1 if lone[end] else run[end])
        return count[n], best[n]

    def _new(self, word: str) -> tuple[int, float]:
        got = self.word(SPACE + word)
        if len(word) <= _LONGEST:
            if len(self.known) >= _CACHED:
                self.known.clear()
            self.known[word] = got
        return got

    def text(self, text: str) -> tuple[int, float]:
        """(pieces, score) of a whole text."""
        if not text:
            return 0, 0.0
        text = text.replace(SPACE, " ")  # the tokenizer takes its own mark for a space
        words = text.split(" ")
        if text[0] == " ":  # no further mark in front of a marked text
            words = words[1:]
        get, new = self.known.get, self._new
        got = [get(w) or new(w) for w in words]
        return sum(n for n, _ in got), sum(s for _, s in got)


@lru_cache(maxsize=2)
def counter(name: str = VOCABULARY) -> Counter:
    """One per Python worker."""
    return Counter(vocabulary(name))


def counted(docs: DataFrame, text: str = "text", keep: list[str] | None = None, n_tokens: str = "n_tokens", score: str = "score", name: str = VOCABULARY) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the number of pieces and the score of each whole text."""
    columns = docs.columns if keep is None else keep
    schema = T.StructType([docs.schema[c] for c in columns] + [T.StructField(n_tokens, T.LongType()), T.StructField(score, T.DoubleType())])
    given = docs.select(*[col(c) for c in columns], *([] if text in columns else [col(text)]))
    at = given.columns.index(text)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = counter(name).text
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                got = [one(t) if t else (0, 0.0) for t in part.column(at).to_pylist()]
                out = with_column(part.select(columns), n_tokens, pa.array([n for n, _ in got], pa.int64()))
                yield with_column(out, score, pa.array([s for _, s in got], pa.float64()))

    return given.mapInArrow(count, schema)
