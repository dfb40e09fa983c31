"""Counts of whole texts, taken chunk by chunk inside tasks."""

from __future__ import annotations

import numpy as np

from sparkmart.llm import spans as S

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_INNER = np.zeros(256, bool)  # continuation bytes of UTF-8
_INNER[128:192] = True


def _in(characters: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in characters]] = True
    return table


_UPPER = _in("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _in("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_LETTER[128:] = True
_DIGIT = _in("0123456789")
_STOP = _in(".!?")
_COMMA = _in(",;:")
_BANG = _in("!")
_BAR = _in("|")


def rule_counts(texts: S.Texts) -> dict[str, np.ndarray]:
    """The counts that quality rules look at, per text.

    n_words; word_chars (code points in words); n_symbols; n_lines (lines with a word); n_dup_lines (of those, equal to
    an earlier line of the text); n_repeat_words (words inside three-word windows that occur twice or more).
    """
    return _rule_counts(texts, S.words(texts))


def _rule_counts(texts: S.Texts, found: S.Spans) -> dict[str, np.ndarray]:
    n = len(texts)
    data = texts.data
    chars = texts.per_text(~(_INNER | S._SPACE)[data])
    line = S.lines(texts)
    filled = np.zeros(len(line.hash), bool)
    if len(found.start):
        nearest = np.searchsorted(found.start, line.start)
        inside = nearest < len(found.start)
        filled[inside] = found.start[nearest[inside]] < line.end[inside]
    again, _ = S.repeated(line.text[filled], line.hash[filled])
    text, index, h = S.windows(found, 3)
    _, anywhere = S.repeated(text, h)
    covered = np.zeros(len(found.hash), bool)
    hit = index[anywhere]
    for k in range(3):
        covered[hit + k] = True
    return {
        "n_words": found.counts,
        "word_chars": chars,
        "n_symbols": texts.per_text(_SYMBOL[data]),
        "n_lines": np.bincount(line.text[filled], minlength=n),
        "n_dup_lines": np.bincount(line.text[filled][again], minlength=n),
        "n_repeat_words": np.bincount(found.text[covered], minlength=n),
    }


#: names of what ``features`` returns, in order
FEATURES = (
    "log_words", "word_length", "symbol_share", "upper_share", "digit_share", "stop_share", "comma_share",
    "bang_share", "bar_share", "dup_line_share", "repeat_share", "distinct_share", "line_length", "wide_share",
)


def features(texts: S.Texts) -> np.ndarray:
    """One row per text, one column per name in ``FEATURES``; an empty text has zeros."""
    found = S.words(texts, lower=True)
    c = _rule_counts(texts, found)
    data = texts.data
    words = np.maximum(c["n_words"], 1).astype(float)
    chars = np.maximum(c["word_chars"], 1).astype(float)
    letters = np.maximum(texts.per_text(_LETTER[data] & ~_INNER[data]), 1).astype(float)
    again, _ = S.repeated(found.text, found.hash)
    distinct = found.counts - np.bincount(found.text[again], minlength=len(texts))
    span = (found.end - found.start) >= 25
    share = lambda table, by: texts.per_text(table[data]) / by
    return np.column_stack((
        np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / words, share(_UPPER, letters),
        share(_DIGIT, chars), share(_STOP, words), share(_COMMA, words), share(_BANG, words), share(_BAR, words),
        c["n_dup_lines"] / np.maximum(c["n_lines"], 1), c["n_repeat_words"] / words, distinct / words,
        np.log1p(c["n_words"] / np.maximum(c["n_lines"], 1)), np.bincount(found.text[span], minlength=len(texts)) / words,
    )).astype(np.float64)
