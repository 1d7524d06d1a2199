"""Spelling variants against brute force over edited strings."""

import collections
import itertools
import random
import re
import zlib

import pytest

from reviewloom.llm import spelling
from reviewloom.llm.edit_automaton import Acceptor, OneEdit

DOCS = "doc_id bigint, text string, word string, n int, id string, run string"
LOWER = str.maketrans(spelling._UPPER, spelling._LOWER)


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(
        long[:k] + long[k + 1 :] == short for k in range(len(long))
    )


def brute_words(rows):
    counts = collections.Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {word: n for word, n in counts.items() if n >= 2}


def brute_variants(words, times=10):
    near = {w: [v for v in words if one_edit(v, w)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= times * words[w] else None
    rows = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return rows


def accepted(machine):
    found, waiting = [], [("", machine.initial)]
    while waiting:
        prefix, state = waiting.pop()
        if machine.accepts[state]:
            found.append(prefix)
        waiting += [(prefix + c, s) for c, s in machine.arcs[state].items()]
    return sorted(found)


def random_words(rng, number, letters="abé", lengths=(0, 6)):
    return sorted({"".join(rng.choice(letters) for _ in range(rng.randint(*lengths))) for _ in range(number)})


def test_acceptor_is_minimal():
    rng = random.Random(5)
    for _ in range(60):
        words = random_words(rng, rng.randint(0, 60))
        machine = Acceptor(words)
        assert accepted(machine) == words
        # as many states as there are different sets of endings
        starts = {w[:k] for w in words for k in range(len(w) + 1)} or {""}
        endings = {frozenset(w[len(s) :] for w in words if w.startswith(s)) for s in starts}
        assert len(machine.arcs) == len(endings)


def test_pairs_of_one_edit():
    rng = random.Random(6)
    for _ in range(60):
        words = random_words(rng, rng.randint(0, 50))
        found = [tuple(sorted(p)) for p in OneEdit(Acceptor(words)).pairs()]
        wanted = {p for p in itertools.combinations(words, 2) if one_edit(*p)}
        assert len(found) == len(set(found)) and set(found) == wanted


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(7)
    letters = "abcàü"
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(7, 12))) for _ in range(15)]
    stems += ["aaaaaaa", "aaaaaaaa", "aaaaaaaab", "baaaaaaa", "aaaaaaaé"]

    def edited(word):
        at, kind = rng.randrange(len(word) + 1), rng.randrange(3)
        return word[:at] + (rng.choice(letters) if kind else "") + word[at + (kind != 1) :]

    rows = []
    for i in range(300):
        words = [rng.choice(stems) for _ in range(12)] + [edited(rng.choice(stems)) for _ in range(4)]
        words += [edited(edited(stems[0])), rng.choice(["Zürich×÷", "SHORT", "x1y2z3"])]
        text = rng.choice([" ", "\n", ", ", "1"]).join(words)
        rows.append((i, text.upper() if i % 9 == 0 else text, "w", 1, "z", "r"))
    rows += [(None, None, None, None, None, None), (None, "aaaaaaab " * 40, "", 0, "", "")]
    rows += [(900, "", "", 0, "", ""), (901, "q" * 50000, "", 0, "", ""), (901, "q" * 50000, "", 0, "", "")]
    rows += [rows[5], rows[5]]
    return spark.createDataFrame(rows, DOCS), rows


def test_vocabulary(docs):
    frame, rows = docs
    assert {r["word"]: r["n"] for r in spelling.vocabulary(frame).collect()} == brute_words(rows)


@pytest.mark.parametrize("most", [20_000, 30, 1])
def test_variants(docs, most):
    """However often crowded cells are split, the same pairs are found."""
    frame, rows = docs
    found = spelling.variants_of(spelling.vocabulary(frame), most=most).collect()
    wanted = brute_variants(brute_words(rows))
    assert len(found) == len(wanted) and {tuple(r) for r in found} == wanted


def test_roots_follow_forms_to_the_last(spark):
    counts = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "abcdefghij": 2000, "zbcdefghij": 2}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = {r["word"]: (r["form"], r["root"]) for r in spelling.variants_of(words).collect()}
    assert found["abcdefg"] == ("abcdefgh", "abcdefghij")
    assert found["zbcdefghij"] == ("abcdefghij", "abcdefghij")
    assert found["abcdefghij"] == (None, "abcdefghij")


def test_cells_stay_small_in_a_crowded_vocabulary(spark):
    """All words share their beginning, their end and their length."""
    rng = random.Random(8)
    words = {"same" + "".join(rng.choice("abcde") for _ in range(5)) + "tail" for _ in range(900)}
    frame = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    split = spelling.cells(frame, most=40)
    assert split.groupBy(*spelling._NAME).count().agg({"count": "max"}).first()[0] <= 40
    found = {r["word"]: r["n_near"] for r in spelling.near_words(frame, most=40).collect()}
    wanted = {w: sum(one_edit(v, w) for v in words) for w in words}
    assert found == {w: n for w, n in wanted.items() if n}


def test_empty(spark):
    assert spelling.variants(spark.createDataFrame([], DOCS)).collect() == []
