"""Quality rules: how much of a text lies inside repeated n-grams and lines."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import bounded_batches, has_word, per_text, words

# Characters counted as symbols.
SYMBOLS = "#*$%&|<>"

# Base rule: fewer words, or a larger share of words in repeated 3-word windows, fails.
LEAST_WORDS = 50
MOST_REPEATED = 0.5

# Largest share of a text's word characters inside n-grams that occurred before, by n:
# published limits for web text. A repeat of fewer words is no sign of a bad text.
MOST_COVERED = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
# Largest share of characters in lines that occurred before.
MOST_IN_LINES = 0.20

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Repetition(NamedTuple):
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    line_share: float
    shares: dict[int, float]


def _seen(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per place: whether its code occurs twice or more, and whether it occurred before."""
    order = np.argsort(codes, kind="stable")
    ranked = codes[order]
    same = ranked[1:] == ranked[:-1]
    later = np.zeros(len(codes), bool)
    later[order[1:]] = same
    twice = later.copy()
    twice[order[:-1]] |= same
    return twice, later


def _covered(places: np.ndarray, length: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in a window of ``length`` words that begins at a place."""
    edges = np.zeros(size + 1, np.int64)
    edges[places] += 1
    edges[places + length] -= 1
    return np.cumsum(edges[:-1]) > 0


def repetition(text: str) -> Repetition:
    """Counts and shares of one whole text.

    Windows of three words are compared by exact names. Longer n-grams are compared by
    rolling hashes of word numbers, only at places whose 3-word window is repeated, as no
    other place can begin a repeated n-gram.
    """
    found = words(text)
    size = len(found)
    symbols = sum(map(text.count, SYMBOLS))
    lines, dup_lines, dup_chars, line_chars = set(), 0, 0, 0
    for line in text.split("\n"):
        if not has_word(line):
            continue
        line_chars += len(line)
        if line in lines:
            dup_lines += 1
            dup_chars += len(line)
        lines.add(line)
    line_share = dup_chars / line_chars if line_chars else 0.0
    lengths = np.array(list(map(len, found)), np.int64)
    chars = int(lengths.sum())
    shares = dict.fromkeys(MOST_COVERED, 0.0)
    if size < 3:
        return Repetition(size, chars, symbols, dup_lines, 0, line_share, shares)
    numbers = {word: i for i, word in enumerate(dict.fromkeys(found))}
    ids = np.array(list(map(numbers.__getitem__, found)), np.int64)
    pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1]
    twice, later = _seen(pairs[:-1] * len(numbers) + ids[2:])
    repeats = int(_covered(np.flatnonzero(twice), 3, size).sum())
    places = np.flatnonzero(twice)
    if len(places):
        values = (ids.astype(np.uint64) + np.uint64(1)) * _MULTIPLIER
        rolling, length = values.copy(), 1
        for n in MOST_COVERED:
            while length < n:
                rolling = rolling[:-1] * _MULTIPLIER + values[length:] if size > length else rolling[:0]
                length += 1
            places = places[places + n <= size]
            if not len(places):
                break
            twice, later = _seen(rolling[places])
            if later.any():
                shares[n] = float(lengths[_covered(places[later], n, size)].sum() / chars)
            places = places[twice]
    return Repetition(size, chars, symbols, dup_lines, repeats, line_share, shares)


def base_failed(found: Repetition) -> bool:
    return (
        found.n_words < LEAST_WORDS
        or found.n_repeat_words > MOST_REPEATED * found.n_words
    )


def keeps(found: Repetition) -> bool:
    """The verdict: base rule, repeated n-grams of every length, repeated lines."""
    return (
        not base_failed(found)
        and found.line_share <= MOST_IN_LINES
        and all(found.shares[n] <= most for n, most in MOST_COVERED.items())
    )


def _measure() -> Callable[[str], tuple]:
    def measure(text: str) -> tuple:
        found = repetition(text)
        return *found[:5], base_failed(found), keeps(found), found.line_share, found.shares[5]

    return measure


measured = per_text(
    _measure,
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, line_share double, five_gram_share double",
)


def quality(documents: DataFrame) -> DataFrame:
    """Per document the counts, the base rule and the verdict.

    One row per input row, repeated rows and null ids included. A null or empty text has
    no words and fails. Other columns are not read; an empty table gives an empty result.
    """
    bounded_batches(documents.sparkSession)
    return documents.select("doc_id", measured(F.col("text")).alias("found")).select("doc_id", "found.*")


def kept_documents(documents: DataFrame, text: Column | str = "text") -> DataFrame:
    """The documents the rules keep, all columns as they were, whatever their names."""
    bounded_batches(documents.sparkSession)
    column = F.col(text) if isinstance(text, str) else text
    return documents.filter(measured(column)["kept"])
