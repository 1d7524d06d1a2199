"""Token counts: a small table of pre-token lengths first, worker caches for the rest."""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reviewloom.llm.common import bounded_batches

VOCABULARY = "byte_bpe_50k.json"
TOKEN_LIMIT = 512

# Fixed value: the pattern by which this vocabulary's files cut text into pre-tokens.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Pre-tokens a worker remembers beside the table before it starts afresh.
CACHE_ENTRIES = 1_000_000
# Pre-tokens that are encoded as one text.
JOINED = 500
# Characters of texts whose misses are encoded in one call.
GROUP_CHARS = 1_000_000


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the installed vocabulary files lie."""
    import public_tokenizers

    return public_tokenizers.path(name)


def length_table(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Tier one: UTF-8 texts of the vocabulary that are one pre-token, and their lengths.

    The vocabulary was made from the most frequent pre-tokens, so they need no counting in
    the corpus. At most one entry per vocabulary entry, whatever the corpus: the size of
    what is broadcast is bounded by the vocabulary file.
    """
    tokenizer = Tokenizer.from_file(path)
    cut = regex.compile(PIECES)
    texts = sorted(
        text
        for text in (tokenizer.decode([i]) for i in range(tokenizer.get_vocab_size()))
        if text and "�" not in text and cut.fullmatch(text)
    )
    lengths = [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    return np.array([t.encode() for t in texts], object), np.array(lengths, np.uint8)


def _class(members: list[str]) -> str:
    """The body of a character class, neighbours joined to ranges."""
    ranges: list[list[int]] = []
    for code in map(ord, members):
        if ranges and ranges[-1][1] == code - 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "".join(f"\\u{low:04x}-\\u{high:04x}" for low, high in ranges)


def piece_finder() -> Callable[[str], list[str]]:
    """A function that cuts text into pre-tokens.

    Texts within the basic plane, nearly all, go to the standard library's matcher with
    the classes written out, which is several times as fast.
    """
    plane = "".join(map(chr, range(0x10000)))
    letter, number, blank = (_class(regex.findall(c, plane)) for c in (r"\p{L}", r"\p{N}", r"\s"))
    near = re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{blank}{letter}{number}]+"
        f"|[{blank}]+(?![^{blank}])|[{blank}]+"
    ).findall
    beyond = re.compile("[\U00010000-\U0010ffff]").search
    any_plane = regex.compile(PIECES).findall
    return lambda text: near(text) if text.isascii() or not beyond(text) else any_plane(text)


class TokenCounter:
    """Counts tokens text by text as the library does, special strings included."""

    def __init__(self, path: str, table: tuple[np.ndarray, np.ndarray] | None = None):
        self.tokenizer = Tokenizer.from_file(path)
        keys, lengths = length_table(path) if table is None else table
        self.frequent = {k.decode(): int(n) for k, n in zip(keys, lengths, strict=True)}
        # the table and what the worker has met beside it, in one lookup
        self.known = dict(self.frequent)
        self.cut = piece_finder()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        longest_first = sorted(self.special, key=len, reverse=True)
        self.split = re.compile("|".join(map(re.escape, longest_first))).split

    def _learn(self, pieces: set[str]) -> None:
        if len(self.known) > len(self.frequent) + CACHE_ENTRIES:
            self.known = dict(self.frequent)
        new = pieces.difference(self.known)
        # a blank and letters are one pre-token wherever they stand, so many go as one text
        plain = [piece for piece in new if piece[0] == " " and piece[1:].isalpha()]
        for i in range(0, len(plain), JOINED):
            some = plain[i : i + JOINED]
            words = self.tokenizer.encode("".join(some), add_special_tokens=False).word_ids
            for number, tokens in Counter(words).items():
                self.known[some[number]] = tokens
        rest = list(new.difference(plain))
        for piece, encoded in zip(
            rest, self.tokenizer.encode_batch(rest, add_special_tokens=False), strict=True
        ):
            self.known[piece] = len(encoded)

    def counts(self, texts: Iterable[str]) -> Iterator[int]:
        """The tokens of each text. Misses of several texts are encoded together."""
        group: list[tuple[int, list[str]]] = []
        held = 0
        for text in texts:
            parts = self.split(text) if any(s in text for s in self.special) else [text]
            pieces = [piece for part in parts for piece in self.cut(part)] if len(parts) > 1 else self.cut(text)
            group.append((len(parts) - 1, pieces))
            held += len(text)
            if held >= GROUP_CHARS:
                yield from self._sums(group)
                group, held = [], 0
        yield from self._sums(group)

    def _sums(self, group: list[tuple[int, list[str]]]) -> list[int]:
        self._learn(set().union(*(pieces for _, pieces in group)))
        length = self.known.__getitem__
        return [special + sum(map(length, pieces)) for special, pieces in group]

    def count(self, text: str) -> int:
        return next(self.counts([text]))


def token_counts(
    documents: DataFrame, vocabulary: str = VOCABULARY, limit: int = TOKEN_LIMIT
) -> DataFrame:
    """Per document its UTF-8 bytes and tokens, and whether the tokens exceed ``limit``.

    One row per input row, repeated rows and null ids included. A null text is empty: no
    tokens. Other columns are not read; an empty table gives an empty result. No
    pre-token is shuffled: the lookup runs where the text is read.
    """
    spark = documents.sparkSession
    bounded_batches(spark)
    table = spark.sparkContext.broadcast(length_table(vocabulary_path(vocabulary)))

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        counter = TokenCounter(vocabulary_path(vocabulary), table.value)
        for batch in batches:
            yield pd.Series(list(counter.counts(batch)), dtype="int64")

    text = F.coalesce("text", F.lit(""))
    return documents.select(
        "doc_id", F.octet_length(text).cast("bigint").alias("n_bytes"), counted(text).alias("n_tokens")
    ).withColumn("over_limit", F.col("n_tokens") > limit)
