"""Secret scans by one combined byte automaton."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.automaton import Automaton, parse, reverse
from reviewloom.llm.common import bounded_batches, per_text


class Rule(NamedTuple):
    """``head`` then ``body``; a match counts when its body has ``least`` bytes or more.

    A match that is too short still takes its place: matches of a rule do not overlap.
    """

    kind: str
    head: str
    body: str
    least: int = 1
    any_case: bool = False


# The three base rules. A match takes a whole run of hexadecimal digits anyway,
# so the least length is part of that pattern; else words full of a to f would be matches.
# In the other patterns counts would multiply the automaton's states, so lengths are checked
# afterwards.
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""",
        r"[A-Za-z0-9+/_.=\-]+",
        12,
        True,
    ),
    Rule("access", "AKIA", r"[A-Z0-9]+", 14),
    Rule("hex", "", r"[0-9a-f]{16,}"),
)
# Public formats of other credentials.
MORE = (
    Rule("private_key", "", r"-----BEGIN\x20([A-Z]+\x20)?PRIVATE\x20KEY-----"),
    Rule("github", r"gh[opsur]_", r"[A-Za-z0-9]+", 36),
    Rule("gitlab", r"glpat-", r"[A-Za-z0-9_\-]+", 20),
    Rule("google", r"AIza", r"[A-Za-z0-9_\-]+", 35),
    Rule("npm", r"npm_", r"[A-Za-z0-9]+", 36),
    Rule("slack", r"xox[abeprs]-", r"[A-Za-z0-9\-]+", 20),
    Rule("stripe", r"[rs]k_(live|test)_", r"[A-Za-z0-9]+", 24),
    Rule("json_web_token", r"eyJ[A-Za-z0-9_\-]+\.", r"eyJ[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]+"),
)
RULES = BASE + MORE

Span = tuple[str, int, int]


class Scanner:
    """All rules in one automaton.

    One pass over a text's bytes tells which rules match in it. Only texts with a match
    are read once more, from the end, by the automaton of the reversed patterns, which
    stops wherever a match begins; from the leftmost begin on, a rule's own automaton
    gives the longest match.
    """

    def __init__(self, rules: Sequence[Rule] = RULES):
        whole = [parse(rule.head + rule.body, rule.any_case) for rule in rules]
        self.rules = list(rules)
        self.forward = Automaton(whole, anywhere=True, once=True)
        self.backward = Automaton([reverse(node) for node in whole], anywhere=True)
        self.anchored = [Automaton([node], anywhere=False) for node in whole]
        self.heads = [
            Automaton([parse(rule.head, rule.any_case)], anywhere=False) if rule.head else None
            for rule in rules
        ]

    def spans(self, text: str) -> list[Span]:
        """Matches by begin, then rule; code points, end exclusive."""
        data = text.encode()
        seen = self.forward.patterns_in(data)
        if not seen:
            return []
        begins = [(len(data) - read, bits) for read, bits in self.backward.match_places(data[::-1])]
        begins.reverse()
        found = []
        for i, rule in enumerate(self.rules):
            if not seen >> i & 1:
                continue
            end = 0
            for begin, bits in begins:
                if begin < end or not bits >> i & 1:
                    continue
                end = self.anchored[i].longest(data, begin)
                head = self.heads[i]
                body = head.longest(data, begin) if head else begin
                if end - body >= rule.least:
                    found.append((begin, i, end))
        found.sort()
        if not found or len(data) == len(text):
            return [(self.rules[i].kind, begin, end) for begin, i, end in found]
        # code points that begin before each byte, counted once for all spans
        begins_one = np.frombuffer(data, np.uint8) & 0xC0 != 0x80
        points = np.concatenate([[0], np.cumsum(begins_one)])
        return [(self.rules[i].kind, int(points[begin]), int(points[end])) for begin, i, end in found]


def joined(spans: Sequence[Span]) -> str:
    return ",".join(f"{kind}:{begin}:{end}" for kind, begin, end in spans)


@functools.cache
def _scanner() -> Scanner:
    """One per Python worker, which runs many tasks."""
    return Scanner()


def _measure() -> Callable[[str], tuple]:
    scanner = _scanner()
    base = [rule.kind for rule in BASE]

    def measure(text: str) -> tuple:
        spans = scanner.spans(text)
        own = [span for span in spans if span[0] in base]
        counts = [sum(span[0] == kind for span in own) for kind in base]
        return *counts, hashlib.sha256(joined(own).encode()).hexdigest(), joined(spans)

    return measure


scan = per_text(
    _measure, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
)


def secrets(documents: DataFrame) -> DataFrame:
    """Per document the secrets in its whole text: counts, digest and all spans.

    One row per input row, repeated rows and null ids included. A null or empty text has
    no spans (digest of the empty text). Other columns are not read; an empty table gives
    an empty result.
    """
    bounded_batches(documents.sparkSession)
    return documents.select("doc_id", scan(F.col("text")).alias("found")).select("doc_id", "found.*")
