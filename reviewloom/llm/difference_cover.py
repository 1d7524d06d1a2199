"""Suffix order by a difference cover of 3, as array operations."""

from __future__ import annotations

import numpy as np

from reviewloom.llm.anchors import LENGTH

# Names of this many nested triples cover more bytes than are ever compared.
_DEPTH = 5
# Three names make one 63-bit number, so a text must not be longer.
LONGEST = 1 << 21


def suffix_order(text: np.ndarray, depth: int = _DEPTH) -> np.ndarray:
    """The suffixes of ``text`` (numbers from 1 on) in order.

    Suffixes that begin at places 1 and 2 modulo 3 are the sample: their triples are sorted
    and named, and the order of the names' text, found the same way, ranks them. The other
    suffixes are a number and a ranked suffix each; they are sorted by that and merged in.
    After ``depth`` nestings names are taken for ranks: suffixes that then count as equal
    share 3 ** depth numbers.
    """
    size = len(text)
    padded = np.concatenate([text, np.zeros(4, np.int64)])
    ones = np.arange(1, size + (size % 3 == 1), 3)
    twos = np.arange(2, size, 3)
    sample = np.concatenate([ones, twos])
    top = int(text.max(initial=0)) + 1
    triples = (padded[sample] * top + padded[sample + 1]) * top + padded[sample + 2]
    names, inverse = np.unique(triples, return_inverse=True)
    inverse = inverse.ravel()
    if len(names) == len(sample) or depth == 1:
        order = np.argsort(inverse, kind="stable")
        ranks = inverse + 1
    else:
        order = suffix_order(inverse + 1, depth - 1)
        ranks = np.empty(len(sample), np.int64)
        ranks[order] = np.arange(1, len(sample) + 1)
    rank = np.zeros(size + 4, np.int64)
    rank[sample] = ranks
    sorted_sample = sample[order]
    sorted_sample = sorted_sample[sorted_sample < size]

    span = int(ranks.max(initial=0)) + 1
    zeros = np.arange(0, size, 3)
    by_one = padded[zeros] * span + rank[zeros + 1]
    zeros = zeros[np.argsort(by_one, kind="stable")]
    first = sorted_sample[sorted_sample % 3 == 1]
    second = sorted_sample[sorted_sample % 3 == 2]

    def short(places):
        return padded[places] * span + rank[places + 1]

    def long(places):
        return (padded[places] * top + padded[places + 1]) * span + rank[places + 2]

    slots = (
        np.arange(len(zeros))
        + np.searchsorted(np.sort(short(first)), short(zeros))
        + np.searchsorted(np.sort(long(second)), long(zeros))
    )
    slots = np.maximum.accumulate(slots - np.arange(len(zeros))) + np.arange(len(zeros))
    merged = np.empty(size, np.int64)
    others = np.ones(size, bool)
    others[slots] = False
    merged[slots] = zeros
    merged[others] = sorted_sample
    return merged


def repeated_windows(data: np.ndarray, windows: np.ndarray, age: np.ndarray) -> np.ndarray:
    """Which windows equal an older one.

    ``windows`` are the places in the bytes ``data`` where windows of ``LENGTH`` bytes
    begin, ``age`` their order. Suffixes are sorted, and those with equal beginnings are
    neighbours then: adjacent prefixes are compared byte by byte.
    """
    number = np.full(len(data), -1, np.int64)
    number[windows] = np.arange(len(windows))
    order = number[suffix_order(data.astype(np.int64) + 1)]
    order = order[order >= 0]
    views = np.lib.stride_tricks.sliding_window_view(data, LENGTH)
    same = np.zeros(len(order), bool)
    for at in range(0, len(order) - 1, 1 << 15):
        rows = views[windows[order[at : at + (1 << 15) + 1]]]
        same[at + 1 : at + len(rows)] = (rows[1:] == rows[:-1]).all(axis=1)
    begins = np.flatnonzero(~same)
    oldest = np.minimum.reduceat(age[order], begins) if len(order) else age[:0]
    later = np.zeros(len(windows), bool)
    later[order] = age[order] != np.repeat(oldest, np.diff(np.append(begins, len(order))))
    return later
