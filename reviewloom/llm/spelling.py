"""Spelling variants by composing a vocabulary acceptor with one edit and itself."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom import session
from reviewloom.llm.edit_automaton import Acceptor, OneEdit

# Least code points and occurrences of a word.
LEAST = 7
OCCURRENCES = 2

# A word's form occurs at least this many times as often.
TIMES = 10

# Of occurrences whose checksum this divides, a code point is deleted.
DELETED = 31

# Words of one acceptor; cells with more are split.
CELL = 20_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RUN = f"[A-Za-zÀ-ÿ]{{{LEAST},}}"


def vocabulary(documents: DataFrame) -> DataFrame:
    """``word`` and ``n``, the words of all whole texts that occur often enough.

    Runs of letters, A to Z in lower case, with the misspellings that the checksum of id
    (null: empty) and run makes. Shorter runs cannot become words, so they are not read.
    Counts are combined before the shuffle.
    """
    runs = documents.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all("text", F.lit(_RUN), F.lit(0))).alias("run"),
    ).select("id", F.translate("run", _UPPER, _LOWER).alias("run"))
    check = F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "UTF-8"))
    length = F.char_length("run")
    at = F.pmod(F.col("h"), length).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, length))
    return (
        runs.select("run", check.alias("h"))
        .select(F.when(F.col("h") % DELETED == 0, cut).otherwise(F.col("run")).alias("word"))
        .filter(F.char_length("word") >= LEAST)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= OCCURRENCES)
    )


# A cell holds the words in which one edit between code points ``left`` and ``edge`` of the
# shorter word may pair: they agree in the first ``left`` code points and in those that
# follow ``edge``. ``size`` is the length of a pair's shorter word. 0 stands for any: then
# the shortest possible one tells how many code points follow ``edge`` at least.
_NAME = ["size", "left", "edge", "head", "tail"]


def _least() -> Column:
    return F.when(F.col("size") == 0, LEAST).otherwise(F.col("size"))


def _named(words: DataFrame) -> DataFrame:
    """``words`` with ``size``, ``left`` and ``edge``, and the code points of their cell."""
    return words.withColumn("head", F.substring("word", F.lit(1), F.col("left"))).withColumn(
        "tail",
        F.substring("word", F.char_length("word") - (_least() - F.col("edge")) + 1, F.char_length("word")),
    )


def _halved(words: DataFrame) -> DataFrame:
    """Each word in both halves of its cell: the edit lies behind or before the middle."""
    middle = F.floor((F.col("left") + F.col("edge")) / 2).cast("int")
    halves = F.array(
        F.struct(middle.alias("left"), F.col("edge").alias("edge")),
        F.struct(F.col("left").alias("left"), middle.alias("edge")),
    )
    return _named(
        words.withColumn("half", F.explode(halves))
        .withColumn("left", F.col("half.left"))
        .withColumn("edge", F.col("half.edge"))
        .drop("half")
    )


def _sized(words: DataFrame) -> DataFrame:
    """Words of cells of any size in the cells of both sizes they may have there."""
    length = F.char_length("word")
    sizes = F.filter(F.array(length - 1, length), lambda c: c >= LEAST)
    open_end = F.col("edge") == _least()
    size = F.explode(F.when(F.col("size") == 0, sizes).otherwise(F.array("size")))
    return (
        words.withColumn("own", size)
        .withColumn("edge", F.when(open_end, F.col("own")).otherwise(F.col("edge")))
        .withColumn("size", F.col("own"))
        .drop("own")
    )


def cells(words: DataFrame, most: int = CELL) -> DataFrame:
    """``words`` (``word``, ``n``) in cells of at most ``most`` words, or of those that one
    free code point allows, so that every pair one edit apart meets in exactly one cell
    whose rule (``_pairs``) it fits.

    A pair agrees before its edit or behind it: at first words are keyed by the first 3 code
    points and by the last 4. Cells found to be crowded are halved again, with words of one
    length and the next by themselves, until none is. A halved cell can no more be crowded
    once a single place is left: it then has a word per letter, and per two letters.
    """
    start = words.select("word", "n", F.lit(0).alias("size"), F.lit(0).alias("left"), F.lit(LEAST).alias("edge"))
    waiting = session.store(_halved(start))
    done = []
    while True:
        crowded = session.store(
            waiting.filter(F.col("edge") - F.col("left") > 1)
            .groupBy(*_NAME)
            .agg(F.count(F.lit(1)).alias("words"))
            .filter(F.col("words") > most)
            .drop("words")
        )
        if crowded.isEmpty():
            return _united([*done, waiting])
        done.append(waiting.join(crowded, _NAME, "left_anti"))
        waiting = session.store(_halved(_sized(waiting.join(crowded, _NAME, "left_semi"))))


def _united(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for more in frames[1:]:
        whole = whole.unionByName(more)
    return whole


def _pairs(size: int, left: int, edge: int, words: list[str]) -> Iterator[tuple[str, str]]:
    """Pairs of one cell. The parts all words share are the way to the initial state and
    from the final ones, so only what lies between is accepted, and composed.

    A pair that agrees up to ``edge`` belongs to the cell of the other half; one of two
    longer words to the cells of the next size.
    """
    least = size or LEAST
    behind = least - edge
    head, tail = words[0][:left], words[0][len(words[0]) - behind :]
    free = sorted(word[left : len(word) - behind] for word in words)
    for a, b in OneEdit(Acceptor(free)).pairs():
        a, b = head + a + tail, head + b + tail
        if edge < least and a[:edge] == b[:edge] or size and len(a) > size:
            continue
        yield a, b


def _near_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per word of each cell its number of near words and the first of them by order."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch[name].tolist() for name in [*_NAME, "word", "n"]))

    for (size, left, edge, _, _), members in groupby(rows(), itemgetter(0, 1, 2, 3, 4)):
        counts = {row[5]: row[6] for row in members}
        if len(counts) == 1:
            continue
        best: dict[str, list] = {}
        for a, b in _pairs(size, left, edge, list(counts)):
            for word, near in ((a, b), (b, a)):
                entry = (-counts[near], near)
                if word in best:
                    best[word][0] += 1
                    best[word][1] = min(best[word][1], entry)
                else:
                    best[word] = [1, entry]
        if best:
            yield pd.DataFrame(
                [(word, near, -key, form) for word, (near, (key, form)) in best.items()],
                columns=["word", "n_near", "form_n", "form"],
            )


def near_words(words: DataFrame, most: int = CELL) -> DataFrame:
    """Per word of ``words`` (``word``, ``n``, distinct) with near words their number
    ``n_near`` and the most frequent one ``form``, smallest of equal ones, with ``form_n``.

    Spark groups the cells; each is one acceptor in a task. A cell sends one row per word.
    """
    keyed = cells(words, most).select(*_NAME, "word", "n")
    found = (
        keyed.repartition(*_NAME)
        .sortWithinPartitions(*_NAME)
        .mapInPandas(_near_of, "word string, n_near long, form_n long, form string")
    )
    first = F.min(F.struct((-F.col("form_n")).alias("key"), "form"))
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), first.alias("first"))
        .select("word", "n_near", "first.form", (-F.col("first.key")).alias("form_n"))
    )


def roots(links: DataFrame) -> DataFrame:
    """Per ``word`` of ``links`` (``word``, ``form``) the last word that forms lead to.

    A form is ten times as frequent as its word, so there are no circles and ways are short.
    Each round doubles the steps taken and is written to the scratch folder.
    """
    reached = session.store(links.select("word", F.col("form").alias("root")))
    while True:
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if reached.join(ahead, "root", "left_semi").isEmpty():
            return reached
        reached = session.store(
            reached.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        )


def variants_of(words: DataFrame, times: int = TIMES, most: int = CELL) -> DataFrame:
    """``words`` (``word``, ``n``) with ``form``, ``root``, ``n_near`` and ``form_n``."""
    words = session.store(words)
    found = words.join(near_words(words, most), "word", "left").withColumn(
        "chosen", F.coalesce(F.col("form_n") >= F.col("n") * times, F.lit(False))
    )
    grouped = session.store(
        found.select(
            "word",
            F.when(F.col("chosen"), F.col("form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(F.col("chosen"), F.col("form_n")).alias("form_n"),
        )
    )
    last = roots(grouped.filter("form IS NOT NULL"))
    return grouped.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def variants(documents: DataFrame) -> DataFrame:
    """Per word of ``documents``: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    Two words are near if one inserted, deleted or replaced code point makes one the other.
    ``form`` is the near word that occurs most, if at least ten times as often; ``root`` is
    where forms lead. Null and empty texts have no words, a null id counts as empty text,
    repeated rows count again, an empty table gives an empty result. Other columns are not
    read.
    """
    return variants_of(vocabulary(documents))
