"""Exact repeats of byte strings across documents, by distributed suffix sorting."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom import session
from reviewloom.llm.anchors import LENGTH, entries
from reviewloom.llm.common import bounded_batches
from reviewloom.llm.difference_cover import LONGEST, repeated_windows

# A place in a document as one number: the byte, and in 7 bits how many windows begin there
# and after.
_WINDOW_BITS = 7
_WINDOWS = (1 << _WINDOW_BITS) - 1
# Anchors with more different surroundings are not sorted in one group; their windows are
# dealt out by content, one by one.
CROWDED = 4096
# Bytes that are sorted together; a group of one anchor's surroundings comes on top.
SORTED_BYTES = 1 << 20
# Rows per document are sent to all executors up to this size, else they are joined.
SENT_BYTES = 32 * 1024 * 1024

_SPREAD = 0x2545F4914F6CDD1D
_NO_ID = (1 << 63) - 1


# A document: its id and, for repeated and null ids, 128 bits of its text's SHA-256.
DOC = ("doc", "high", "low")


def _identity() -> list[Column]:
    """What tells documents apart: the id, null last, and for repeated ids the text."""
    text = F.coalesce("text", F.lit(""))
    digest = F.sha2(text, 256)
    return [
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID)).alias("doc"),
        *(
            F.conv(F.substring(digest, at, 16), 16, -10).cast("bigint").alias(name)
            for at, name in ((1, "high"), (17, "low"))
        ),
        text.alias("text"),
    ]


def _batch(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], names=list(columns))


def _firsts(*keys: np.ndarray) -> np.ndarray:
    """In rows sorted by the keys: where a new value begins."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return new


_ENTRY = "anchor bigint, span bigint, doc bigint, high bigint, low bigint, at bigint, later boolean"


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The entries of each document. Of equal ones in a batch only the oldest still has to be
    compared; the others are marked as later, so a hot string is few rows from here on."""
    for batch in batches:
        docs = [batch.column(n).to_numpy() for n in DOC]
        found = [entries(text.as_py().encode()) for text in batch.column("text")]
        counts = [len(e.place) for e in found]
        if not sum(counts):
            continue
        anchor, span, place, windows = (np.concatenate(c) for c in zip(*found))
        doc, high, low = (np.repeat(column, counts) for column in docs)
        at = (place << _WINDOW_BITS) | windows
        order = np.lexsort((at, low, high, doc, span, anchor))
        anchor, span, doc, high, low, at = (c[order] for c in (anchor, span, doc, high, low, at))
        first = _firsts(anchor, span)
        oldest = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
        same_place = np.logical_and.reduce([c == c[oldest] for c in (doc, high, low, at)])
        kept = first | ~same_place  # rows of one document that is there twice are one
        yield _batch(
            {
                # what needs no comparison goes anywhere, not to where its anchor is compared
                "anchor": np.where(first, anchor.view(np.int64), doc ^ high ^ (at * _SPREAD))[kept],
                "span": span.view(np.int64)[kept],
                "doc": doc[kept],
                "high": high[kept],
                "low": low[kept],
                "at": at[kept],
                "later": ~first[kept],
            }
        )


_FOUND = "anchor bigint, doc bigint, high bigint, low bigint, at bigint, later boolean"


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From entries sorted by anchor, span and age: those whose span is there before
    (``later``), and the oldest of each span where the anchor has several spans.

    Only the last row and, until its anchor has a second span, one entry are remembered.
    """
    last = None  # anchor, span and the oldest of that span: doc, high, low, at
    pending, several = None, False
    for batch in batches:
        anchor, span, *where = (batch.column(n).to_numpy() for n in ("anchor", "span", *DOC, "at"))
        known = batch.column("later").to_numpy(zero_copy_only=False)
        done = [np.column_stack(where)[known]]
        anchor, span, where = anchor[~known], span[~known], [c[~known] for c in where]
        edges: list[np.ndarray] = []
        if len(anchor):
            new = _firsts(anchor, span)
            fresh = _firsts(anchor)
            if last is not None:
                new[0] = (anchor[0], span[0]) != last[:2]
                fresh[0] = anchor[0] != last[0]
            oldest = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
            origin = [np.where(oldest >= 0, c[oldest], last[2 + i] if last else 0) for i, c in enumerate(where)]
            later = ~new & np.logical_or.reduce([c != o for c, o in zip(where, origin)])
            done.append(np.column_stack(where)[later])
            last = (anchor[-1], span[-1], *(o[-1] for o in origin))
            rows = np.column_stack([anchor, *where])[new]
            heads = fresh[new]
            if len(rows):
                if heads[0]:
                    pending, several = None, False
                if pending is not None:
                    rows = np.vstack([pending, rows])
                    heads = np.concatenate([[True], heads])
                classes = np.cumsum(heads)
                sizes = np.bincount(classes)[classes]
                goes_on = classes == 0  # the anchor had several spans already
                out = (sizes > 1) | (goes_on & several)
                final = classes == classes[-1]
                pending = None
                if not out[-1]:
                    pending, several = rows[-1:], False
                elif final.any():
                    several = True
                edges.append(rows[out])
        parts = np.vstack([*edges, np.empty((0, 5), np.int64)])
        repeated = np.vstack(done)
        columns = np.vstack([repeated, parts[:, 1:]]).T
        yield _batch(
            {
                "anchor": np.concatenate([np.zeros(len(repeated), np.int64), parts[:, 0]]),
                **dict(zip((*DOC, "at"), map(np.ascontiguousarray, columns))),
                "later": np.arange(len(repeated) + len(parts)) < len(repeated),
            }
        )


_SPAN = "cluster bigint, doc bigint, high bigint, low bigint, at bigint, bytes binary"


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the entries that are still to be compared, under the key of their group:
    the anchor, or the content of single windows for crowded anchors."""
    for batch in batches:
        out: dict[str, list] = {n: [] for n in ("cluster", *DOC, "at", "bytes")}
        rows = zip(*(batch.column(n).to_pylist() for n in (*DOC, "text", "anchors", "ats", "crowded")))
        for *doc, text, anchors, ats, crowded in rows:
            data = text.encode()
            for anchor, at, single in zip(anchors, ats, crowded):
                place, windows = at >> _WINDOW_BITS, at & _WINDOWS
                if not single:
                    spans = [(anchor, at, data[place : place + windows - 1 + LENGTH])]
                else:
                    spans = []
                    for i in range(place, place + windows):
                        window = data[i : i + LENGTH]
                        key = int.from_bytes(hashlib.blake2b(window, digest_size=8).digest(), signed=True)
                        one = i << _WINDOW_BITS | 1
                        spans.append((key, one, window))
                for key, where, content in spans:
                    for name, value in zip(out, (key, *doc, where, content)):
                        out[name].append(value)
        kinds = (*[pa.int64()] * 5, pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(out.values(), kinds)], names=list(out)
        )


def _sorted_group(places: np.ndarray, spans: list[bytes]) -> dict[str, np.ndarray]:
    """Runs of windows that equal an older one, of spans that are sorted together."""
    data = np.frombuffer(b"".join(spans), np.uint8)
    lengths = np.array(list(map(len, spans)), np.int64)
    starts = np.cumsum(lengths) - lengths
    *docs, ats = places.T
    counts = ats & _WINDOWS
    of = np.repeat(np.arange(len(spans)), counts)
    inside = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    rank = np.empty(len(spans), np.int64)
    rank[np.lexsort((ats, *docs[::-1]))] = np.arange(len(spans))
    later = np.flatnonzero(repeated_windows(data, starts[of] + inside, rank[of] << _WINDOW_BITS | inside))
    of, inside = of[later], inside[later]
    begins = np.flatnonzero(_firsts(of, inside - np.arange(len(inside))))
    runs = np.diff(np.append(begins, len(of)))
    of, inside = of[begins], inside[begins]
    at = (ats[of] - counts[of]) + (inside << _WINDOW_BITS) + runs
    return {**{name: column[of] for name, column in zip(DOC, docs)}, "at": at}


def _suffix_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of spans, which come one after the other, sorted together up to a size.

    Within a group the oldest come first. A group that outgrows one sort, as the copies of
    one window can, goes on with the spans that hold a window not seen before.
    """
    held: list[tuple[tuple[int, ...], bytes]] = []
    size, cluster = 0, None

    def finish():
        places, spans = zip(*held)
        return _sorted_group(np.array(places, np.int64), list(spans))

    for batch in batches:
        for key, *place, span in zip(*(batch.column(n).to_pylist() for n in ("cluster", *DOC, "at", "bytes"))):
            place = tuple(place)
            if held and key == cluster and place == held[-1][0]:
                continue  # a row that is there twice is one document
            if held and key != cluster and size >= SORTED_BYTES:
                yield _batch(finish())
                held, size = [], 0
            elif size + len(span) > LONGEST:
                runs = finish()
                yield _batch(runs)
                repeated = set(zip(*(runs[n].tolist() for n in (*DOC, "at"))))
                held = [x for x in held if x[0] not in repeated]  # all its windows
                size = sum(len(x[1]) for x in held)
            held.append((place, span))
            size, cluster = size + len(span), key
    if held:
        yield _batch(finish())


def _merged(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The byte ranges that a document's repeated windows cover: begins and ends in turn."""
    for batch in batches:
        out = []
        for ats in batch:
            ats = np.sort(np.asarray(ats, np.int64))
            begin = ats >> _WINDOW_BITS
            end = np.maximum.accumulate(begin + (ats & _WINDOWS) - 1 + LENGTH)
            new = np.append(True, begin[1:] > end[:-1])
            ranges = np.column_stack([begin[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]])
            out.append(ranges.ravel())
        yield pd.Series(out)


def _kept(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, ranges in batches:
        rows = []
        for text, cuts in zip(texts, ranges, strict=True):
            data = text.encode()
            kept, at, removed = hashlib.sha256(), 0, 0
            for begin, end in np.asarray(cuts, np.int64).reshape(-1, 2).tolist():
                kept.update(data[at:begin])
                removed, at = removed + end - begin, end
            kept.update(data[at:])
            rows.append((removed, len(cuts) // 2, kept.hexdigest()))
        yield pd.DataFrame(rows, columns=["n_removed", "n_spans", "kept_sha256"])


def removed_ranges(documents: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Per document (``doc``, ``high``, ``low``) with repeats the byte ranges to remove (``cuts``).

    1. Every window's anchor is found where the text is read. Runs of windows meet other
       runs with the same anchor: one shuffle of short rows. Runs with equal bytes are
       repeats of the oldest; runs whose anchor is nowhere else hold no repeats.
    2. Only runs that share an anchor with different bytes, the edges of repeats, are left.
       Their bytes are grouped by anchor, the suffixes of each group are sorted by the
       difference cover algorithm and adjacent prefixes are compared.
    """
    spark = documents.sparkSession
    bounded_batches(spark)
    texts = documents.select(*_identity())
    found = session.store(
        texts.mapInArrow(_entries, _ENTRY)
        .repartition("anchor")
        .sortWithinPartitions("anchor", "span", *DOC, "at")
        .mapInArrow(_compared, _FOUND)
    )
    edges = found.filter(~F.col("later"))
    full = edges.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > crowded)
    # at most one entry per run of a document's windows
    wanted = session.store(
        edges.join(full.select("anchor", F.lit(True).alias("single")), "anchor", "left")
        .groupBy(*DOC)
        .agg(
            F.collect_list(
                F.struct("anchor", "at", F.coalesce("single", F.lit(False)).alias("crowded"))
            ).alias("runs")
        )
    )
    spans = texts.join(wanted, list(DOC)).select(
        *DOC,
        "text",
        F.col("runs.anchor").alias("anchors"),
        F.col("runs.at").alias("ats"),
        F.col("runs.crowded").alias("crowded"),
    )
    sorted_runs = (
        spans.mapInArrow(_spans, _SPAN)
        .repartition("cluster")
        .sortWithinPartitions("cluster", *DOC, "at")
        .mapInArrow(_suffix_sorted, "doc bigint, high bigint, low bigint, at bigint")
    )
    repeats = found.filter("later").select(*DOC, "at").unionByName(sorted_runs)
    return (
        repeats.groupBy(*DOC)
        .agg(F.collect_list("at").alias("ats"))
        .select(*DOC, F.pandas_udf(_merged, "array<bigint>")("ats").alias("cuts"))
    )


def without_repeats(documents: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Per document what is left once each byte of a 100-byte string that also starts
    earlier is removed: ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``.

    Earlier is a smaller ``doc_id`` or an earlier place; a null id comes last. Rows that
    repeat both id and text are one document, and each gets its result; repeated ids with
    different texts are documents in an order of their own. A null or shorter text keeps
    all it has. An empty table gives an empty result; other columns are not read.
    """
    ranges = session.store(removed_ranges(documents, crowded))
    weight = ranges.agg(F.coalesce(F.sum(F.size("cuts") * 8 + 64), F.lit(0)).alias("n")).first()["n"]
    side = F.broadcast(ranges) if weight <= SENT_BYTES else ranges
    rows = documents.select("doc_id", *_identity()).join(side, list(DOC), "left")
    data = F.col("text").cast("binary")
    left = F.pandas_udf(_kept, "n_removed bigint, n_spans bigint, kept_sha256 string")
    cut = rows.filter(F.col("cuts").isNotNull()).select(
        "doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), left("text", "cuts").alias("left")
    ).select("doc_id", "n_bytes", "left.*")
    whole = rows.filter(F.col("cuts").isNull()).select(
        "doc_id",
        F.octet_length("text").cast("bigint").alias("n_bytes"),
        F.lit(0).cast("bigint").alias("n_removed"),
        F.lit(0).cast("bigint").alias("n_spans"),
        F.sha2(data, 256).alias("kept_sha256"),
    )
    return cut.unionByName(whole)
