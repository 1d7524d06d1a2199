"""Windows of a text by content-defined anchors.

Every window of ``LENGTH`` bytes has an anchor: of the ``GRAM``-byte strings inside it, the
first with the smallest hash. Equal windows have equal anchors at equal places, so a window
can only occur again where its anchor does. Windows that follow each other mostly share an
anchor; such a run of windows is one entry.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

LENGTH = 100
GRAM = 32
_WIDTH = LENGTH - GRAM + 1
# Windows handled at once: the arrays of a piece stay in the cache.
PIECE = 1 << 15

_PLACE_BITS = np.uint64(24)
_PLACE = np.uint64((1 << 24) - 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def _powers(base: int) -> np.ndarray:
    size = PIECE + 2 * LENGTH
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, base, np.uint64))])


_POWERS = [_powers(base) for base in _BASES]
_INVERSES = [_powers(pow(base, -1, 1 << 64)) for base in _BASES]


class Entries(NamedTuple):
    """Per run of windows with one anchor: the anchor's hash, the hash of all its bytes and
    of the anchor's place in them, the first window's place and the number of windows."""

    anchor: np.ndarray
    span: np.ndarray
    place: np.ndarray
    windows: np.ndarray


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(31))) * _MIX
    return value ^ (value >> np.uint64(29))


def entries(data: bytes) -> Entries:
    """The entries of all windows of ``data``; none if it is shorter than a window."""
    whole = np.frombuffer(data, np.uint8)
    count = len(whole) - LENGTH + 1
    parts = [_piece(whole, at, min(PIECE, count - at)) for at in range(0, max(count, 0), PIECE)]
    if not parts:
        none = np.empty(0, np.uint64)
        return Entries(none, none, none.astype(np.int64), none.astype(np.int64))
    return Entries(*(np.concatenate(column) for column in zip(*parts)))


def _piece(whole: np.ndarray, at: int, count: int) -> Entries:
    values = whole[at : at + count + LENGTH - 1].astype(np.uint64) + np.uint64(1)
    sums = [
        np.concatenate([[np.uint64(0)], np.cumsum(values * powers[: len(values)])])
        for powers in _POWERS
    ]

    def hashed(which: int, low, high):
        return _mixed((sums[which][high] - sums[which][low]) * _INVERSES[which][low])

    first = sums[0]
    grams = _mixed((first[GRAM:] - first[:-GRAM]) * _INVERSES[0][: len(first) - GRAM])
    places = np.arange(len(grams), dtype=np.uint64)
    ranked = (grams & ~_PLACE) | places
    # the smallest of every _WIDTH neighbours: from the end of a block and from its begin
    blocks = -(-len(ranked) // _WIDTH)
    padded = np.full(blocks * _WIDTH, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(ranked)] = ranked
    square = padded.reshape(blocks, _WIDTH)
    upto = np.minimum.accumulate(square, axis=1).ravel()
    onward = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    anchors = (np.minimum(onward[:count], upto[_WIDTH - 1 : _WIDTH - 1 + count]) & _PLACE).astype(np.int64)
    begins = np.concatenate([[0], np.flatnonzero(np.diff(anchors)) + 1])
    ends = np.append(begins[1:], count)
    own = anchors[begins]
    spans = hashed(1, begins, ends - 1 + LENGTH) + (own - begins).astype(np.uint64) * _MIX
    return Entries(grams[own], _mixed(spans), begins + at, ends - begins)
