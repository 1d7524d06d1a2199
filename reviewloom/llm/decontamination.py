"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from reviewloom import session
from reviewloom.llm.common import bounded_batches

# A tile has at least this many tokens; so has a seed. Items with fewer are one tile, found
# where all their tokens stand in a row.
LEAST_TILE = 5
# Share of an item's tokens that tiles must cover, in whatever order they stand.
LEAST_COVERAGE = 0.6
# Benchmark items are sent to the documents in blocks of so many tokens.
BLOCK_TOKENS = 1_000_000

# A token is a run of letters and digits, case folded: punctuation, layout and case of a
# copied passage may differ. In scripts that put no spaces between words (Thai to Khmer,
# kana, Chinese characters) every letter is a token.
_UNSPACED = (
    r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF"
    r"\uF900-\uFAFF\U00020000-\U0003FFFF"
)
_tokens = re.compile(rf"[{_UNSPACED}]|[^\W_{_UNSPACED}]+").findall
# In texts without those and without other signs than ASCII ones, the same tokens are cut
# faster as bytes.
_other_sign = re.compile(rf"[{_UNSPACED}]|[^\x00-\x7f\w]").search
_SIGNS = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
_SIEVE = 22
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PIECE = 1 << 16


def _powers(base: int) -> np.ndarray:
    return np.concatenate(
        [np.ones(1, np.uint64), np.cumprod(np.full(_PIECE - 1, base, np.uint64))]
    )


_POWERS = _powers(0xD6E8FEB86659FD93)
_INVERSES = _powers(pow(0xD6E8FEB86659FD93, -1, 1 << 64))


def token_hashes(text: str) -> np.ndarray:
    """The tokens of a text as hashes, all by array operations.

    A token's hash is the difference of two prefix sums of bytes times powers, shifted
    back to power 0, so it does not depend on where the token stands.
    """
    text = text.lower()
    if text.isascii() or not _other_sign(text):
        found = text.encode().translate(_SIGNS).split()
    else:
        found = [token.encode() for token in _tokens(text)]
    if not found:
        return np.empty(0, np.uint64)
    data = np.frombuffer(b" ".join(found), np.uint8)
    ends = np.append(np.flatnonzero(data == 32), len(data))
    starts = np.append(0, ends[:-1] + 1)
    parts, first = [], 0
    while first < len(ends):  # pieces of whole tokens that stay in the cache
        begin = starts[first]
        last = int(np.searchsorted(ends, begin + _PIECE - 1, side="right"))
        if last == first:  # a token longer than a piece
            token = data[begin : ends[first]].tobytes()
            parts.append(np.array([xxh64_intdigest(token)], np.uint64))
            first += 1
            continue
        piece = data[begin : ends[last - 1]].astype(np.uint64)
        sums = np.append(np.uint64(0), np.cumsum((piece + np.uint64(1)) * _POWERS[: len(piece)]))
        low, high = starts[first:last] - begin, ends[first:last] - begin
        value = (sums[high] - sums[low]) * _INVERSES[low]
        parts.append((value ^ (value >> np.uint64(29))) * _BASE)
        first = last
    return np.concatenate(parts)


def _grams(tokens: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of ``length`` tokens."""
    size = len(tokens) - length + 1
    if size <= 0:
        return tokens[:0]
    value = tokens[:size].copy()
    for i in range(1, length):
        value = value * _BASE + tokens[i : i + size]
    return value


def _running(tokens: np.ndarray, backward: np.ndarray) -> np.ndarray:
    """Sums of tokens times powers, from which a window of any length is hashed at once.
    ``backward`` are the powers of the inverse base."""
    return np.append(np.uint64(0), np.cumsum(tokens * backward[: len(tokens)]))


def _window_hashes(sums: np.ndarray, forward: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    return (sums[at + length] - sums[at]) * forward[at]


def _free_windows(free: np.ndarray, length: int) -> np.ndarray:
    """Where windows of ``length`` places without a mark begin."""
    marks = np.append(0, np.cumsum(~free))
    return np.flatnonzero(marks[length:] == marks[: len(marks) - length])


def _base_powers(base: int, number: int) -> np.ndarray:
    return np.append(np.uint64(1), np.cumprod(np.full(max(number, 1), base, np.uint64)))


def _common_runs(i: np.ndarray, j: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """Matches (length, place in item, place in text) from pairs of equal windows: pairs
    that follow each other on a diagonal are one match."""
    order = np.lexsort((i, j - i))
    i, j = i[order], j[order]
    ends = np.flatnonzero((np.diff(i) != 1) | (np.diff(j) != 1))
    first, last = np.append(0, ends + 1), np.append(ends, len(i) - 1)
    sizes = last - first + length
    return list(zip(sizes.tolist(), i[first].tolist(), j[first].tolist()))


def tiled(item: np.ndarray, text: np.ndarray, least: int = LEAST_TILE) -> int:
    """How many tokens of ``item`` greedy string tiling against ``text`` covers.

    Running Karp-Rabin: at a search length the hashes of all windows without a mark come
    from running sums, and equal ones, verified token by token, are extended to whole
    matches. The longest is marked first, on both sides; what a mark leaves of others goes
    back among them. Then the search length is halved, down to ``least``.
    """
    free_item, free_text = np.ones(len(item), bool), np.ones(len(text), bool)
    longest = max(len(item), len(text))
    backward = _base_powers(pow(int(_BASE), -1, 1 << 64), longest)
    forward = _base_powers(int(_BASE), longest)
    sums_item, sums_text = _running(item, backward), _running(text, backward)
    length = min(len(item), len(text))
    while length >= least:
        i, j = _free_windows(free_item, length), _free_windows(free_text, length)
        of_item = _window_hashes(sums_item, forward, i, length)
        of_text = _window_hashes(sums_text, forward, j, length)
        kept = np.isin(of_text, of_item)
        j, of_text = j[kept], of_text[kept]
        order = np.argsort(of_item, kind="stable")
        low = np.searchsorted(of_item[order], of_text)
        counts = np.searchsorted(of_item[order], of_text, side="right") - low
        if counts.sum():
            rows = np.repeat(low - np.append(0, np.cumsum(counts)[:-1]), counts) + np.arange(counts.sum())
            _mark(_common_runs(i[order[rows]], np.repeat(j, counts), length), item, text, free_item, free_text, length)
        if length == least:
            break
        length = max(least, length // 2)
    return int((~free_item).sum())


def _mark(
    matches: list[tuple[int, int, int]],
    item: np.ndarray,
    text: np.ndarray,
    free_item: np.ndarray,
    free_text: np.ndarray,
    length: int,
) -> None:
    """Mark matches, the longest first; of one that is partly marked by then, or whose tokens
    differ for all their hashes, the free and equal pieces of ``length`` are put back."""
    waiting = [(-size, i, j) for size, i, j in matches]
    heapq.heapify(waiting)
    while waiting:
        size, i, j = heapq.heappop(waiting)
        size = -size
        usable = free_item[i : i + size] & free_text[j : j + size]
        usable &= item[i : i + size] == text[j : j + size]
        if usable.all():
            free_item[i : i + size] = free_text[j : j + size] = False
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[False], usable, [False]])))
        for begin, end in edges.reshape(-1, 2).tolist():
            if end - begin >= length:
                heapq.heappush(waiting, (begin - end, i + begin, j + begin))


class Hit(NamedTuple):
    number: int
    covered: int
    tokens: int


class Seeds:
    """The windows of ``length`` tokens of some items, sorted by hash."""

    def __init__(self, items: list[np.ndarray], numbers: list[int], length: int):
        self.length = length
        grams = [_grams(items[n], length) for n in numbers]
        hashes = np.concatenate([*grams, np.empty(0, np.uint64)])
        owners = np.repeat(np.array(numbers, np.int64), [len(g) for g in grams])
        places = np.concatenate([*(np.arange(len(g)) for g in grams), np.empty(0, np.int64)])
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owners = hashes[order], owners[order]
        self.places = places[order].astype(np.int64)
        # whether any seed has these leading bits: leaves out nearly all windows of a text
        self.sieve = np.zeros(1 << _SIEVE, bool)
        self.sieve[self.hashes >> np.uint64(64 - _SIEVE)] = True

    def joined(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Shared seeds: the item, the place in it and the place in the text of each."""
        none = np.empty(0, np.int64)
        own = _grams(text, self.length)
        if not len(own) or not len(self.hashes):
            return none, none, none
        at = np.flatnonzero(self.sieve[own >> np.uint64(64 - _SIEVE)])
        low = np.searchsorted(self.hashes, own[at])
        counts = np.searchsorted(self.hashes, own[at], side="right") - low
        rows = np.repeat(low - np.append(0, np.cumsum(counts))[:-1], counts) + np.arange(counts.sum())
        return self.owners[rows], self.places[rows], np.repeat(at, counts)


class Block:
    """A block of benchmark items, found by their seeds."""

    def __init__(self, items: list[np.ndarray], least: int = LEAST_TILE):
        self.items = items
        lengths: dict[int, list[int]] = {}
        for number, item in enumerate(items):
            if len(item):
                lengths.setdefault(min(least, len(item)), []).append(number)
        self.seeds = [Seeds(items, numbers, length) for length, numbers in sorted(lengths.items())]

    def hits(self, text: np.ndarray, coverage: float = LEAST_COVERAGE) -> list[Hit]:
        """Items of which tiles cover enough, by number.

        Every tile is made of shared seeds, so an item whose seeds in the text cover too
        little is left out at once, and only the text around its seeds is tiled.
        """
        found = []
        for seeds in self.seeds:
            owners, places, where = seeds.joined(text)
            order = np.argsort(owners, kind="stable")
            owners, places, where = owners[order], places[order], where[order]
            borders = np.flatnonzero(np.diff(owners)) + 1
            for begin, end in zip(np.append(0, borders), np.append(borders, len(owners))):
                if begin == end:
                    continue
                number = int(owners[begin])
                item = self.items[number]
                if _union(places[begin:end], seeds.length) < coverage * len(item):
                    continue
                around = _around(text, where[begin:end], seeds.length)
                covered = tiled(item, around, seeds.length)
                if covered >= coverage * len(item):
                    found.append(Hit(number, covered, len(item)))
        return sorted(found)


def _around(text: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """The runs of seeds of a text, one after the other, kept apart by marks."""
    places = np.unique(places)
    breaks = np.flatnonzero(np.diff(places) > length) + 1
    parts = []
    for n, run in enumerate(np.split(places, breaks)):
        parts += [text[run[0] : run[-1] + length], np.array([n], np.uint64)]
    return np.concatenate(parts)


def _union(places: np.ndarray, length: int) -> int:
    """How many places windows of ``length`` cover together."""
    places = np.unique(places)
    return int(np.minimum(np.diff(places), length).sum() + length) if len(places) else 0


def _hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield pd.Series([token_hashes(text).view(np.int64) for text in batch], dtype=object)


def _blocks(benchmark: DataFrame) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Items in blocks of bounded size, hashed on executors and streamed: (item ids, items).
    Items without a token match nothing."""
    hashes = F.pandas_udf(_hashed, "array<bigint>")(F.coalesce("text", F.lit("")))
    ids, items, held = [], [], 0
    for item_id, tokens in benchmark.select("item_id", hashes.alias("tokens")).toLocalIterator():
        if tokens:
            ids.append(item_id)
            items.append(np.array(tokens, np.int64).view(np.uint64))
            held += len(tokens)
        if held >= BLOCK_TOKENS:
            yield ids, items
            ids, items, held = [], [], 0
    if items:
        yield ids, items


def _finder(spark, ids: list, items: list, kind: str, coverage: float) -> Callable[[Column], Column]:
    sent = spark.sparkContext.broadcast((ids, items))

    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names, sent_items = sent.value
        block = Block(sent_items)
        for batch in batches:
            rows = []
            for text in batch:
                hits = block.hits(token_hashes(text), coverage)
                rows.append(
                    ([names[h.number] for h in hits], [h.covered for h in hits], [h.tokens for h in hits])
                )
            yield pd.DataFrame(rows, columns=["item", "covered", "tokens"])

    schema = f"item array<{kind}>, covered array<bigint>, tokens array<bigint>"
    return lambda text: F.pandas_udf(found, schema)(F.coalesce(text, F.lit("")))


def _kind(benchmark: DataFrame) -> str:
    return benchmark.schema["item_id"].dataType.simpleString()


def contaminated(
    documents: DataFrame, benchmark: DataFrame, coverage: float = LEAST_COVERAGE
) -> DataFrame:
    """Pairs of a document and a benchmark item it holds.

    Columns ``doc_id``, ``item_id``, ``covered`` and ``item_tokens`` (tokens), ``coverage``
    and ``contaminated`` (true: only such pairs are returned). The benchmark is a stated
    query set that runs against all documents in blocks of bounded size; each block is
    broadcast and documents are not shuffled. Null and empty texts match nothing, repeated
    rows of either table give repeated pairs, null ids are returned as they are, and empty
    tables give an empty result.
    """
    spark = documents.sparkSession
    bounded_batches(spark)
    kind = _kind(benchmark)
    parts: list[DataFrame] = []
    for ids, items in _blocks(benchmark):
        if parts:  # more than one block: each is finished before the next is sent
            parts[-1] = session.store(parts[-1])
        find = _finder(spark, ids, items, kind, coverage)
        found = documents.select("doc_id", find(F.col("text")).alias("found"))
        parts.append(
            found.select("doc_id", F.explode(F.arrays_zip("found.item", "found.covered", "found.tokens")).alias("hit"))
            .select(
                "doc_id",
                F.col("hit.item").alias("item_id"),
                F.col("hit.covered").alias("covered"),
                F.col("hit.tokens").alias("item_tokens"),
            )
        )
    if not parts:
        no_pairs = f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, item_id {kind}, covered bigint, item_tokens bigint"
        parts = [spark.createDataFrame([], no_pairs)]
    every = parts[0]
    for more in parts[1:]:
        every = every.unionByName(more)
    return every.withColumn("coverage", F.col("covered") / F.col("item_tokens")).withColumn(
        "contaminated", F.lit(True)
    )


def clean_documents(
    documents: DataFrame, benchmark: DataFrame, coverage: float = LEAST_COVERAGE
) -> DataFrame:
    """The documents that hold no benchmark item, all columns as they were.

    Null and empty texts hold none and stay, as do null ids; repeated rows go or stay
    together; columns of any name are returned. Empty tables are results like others.
    """
    spark = documents.sparkSession
    bounded_batches(spark)
    kind = _kind(benchmark)
    kept = documents
    for i, (ids, items) in enumerate(_blocks(benchmark)):
        if i:
            kept = session.store(kept)
        find = _finder(spark, ids, items, kind, coverage)
        kept = kept.filter(F.size(find(F.col("text"))["item"]) == 0)
    return kept
