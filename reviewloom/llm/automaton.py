"""Byte automata: rule patterns compiled by subset construction and minimisation.

The pattern language is small: literals, ``\\xNN`` and escaped punctuation, classes,
groups, alternation and the counts ``? * + {m} {m,} {m,n}``. Patterns are ASCII; texts
are matched as UTF-8 bytes, so an ASCII match never splits a character.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

ALL = frozenset(range(256))


class _Parser:
    """Recursive descent into nested tuples: (set, bytes), (cat | alt, nodes), (rep, node, low, high)."""

    def __init__(self, pattern: str, any_case: bool):
        self.rest, self.at, self.any_case = pattern, 0, any_case

    def peek(self) -> str:
        return self.rest[self.at : self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.rest[self.at - 1]

    def alternatives(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.take()
            options.append(self.sequence())
        return options[0] if len(options) == 1 else ("alt", options)

    def sequence(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.counted(self.atom()))
        return ("cat", parts)

    def atom(self):
        c = self.take()
        if c == "(":
            inner = self.alternatives()
            self.take()
            return inner
        if c == "[":
            return ("set", self.members())
        return ("set", self.either_case({self.code(c)}))

    def code(self, c: str) -> int:
        if c != "\\":
            return ord(c)
        c = self.take()
        if c != "x":
            return ord(c)
        return int(self.take() + self.take(), 16)

    def members(self) -> frozenset:
        negated = self.peek() == "^"
        if negated:
            self.take()
        found: set[int] = set()
        while self.peek() != "]":
            low = self.code(self.take())
            if self.peek() == "-" and self.rest[self.at + 1] != "]":
                self.take()
                found.update(range(low, self.code(self.take()) + 1))
            else:
                found.add(low)
        self.take()
        found = set(self.either_case(found))
        return ALL - found if negated else frozenset(found)

    def either_case(self, codes: set[int]) -> frozenset:
        if not self.any_case:
            return frozenset(codes)
        letters = [chr(c) for c in codes]
        return frozenset(ord(x) for c in letters for x in (c.lower(), c.upper()))

    def counted(self, node):
        counts = {"?": (0, 1), "*": (0, None), "+": (1, None)}
        while self.peek() and self.peek() in "?*+{":
            c = self.take()
            if c == "{":
                body = ""
                while self.peek() != "}":
                    body += self.take()
                self.take()
                low, comma, high = body.partition(",")
                bounds = (int(low), int(high) if high else None if comma else int(low))
            else:
                bounds = counts[c]
            node = ("rep", node, *bounds)
        return node


def parse(pattern: str, any_case: bool = False):
    return _Parser(pattern, any_case).alternatives()


def reverse(node):
    """The same pattern read from right to left."""
    kind = node[0]
    if kind == "cat":
        return ("cat", [reverse(part) for part in reversed(node[1])])
    if kind == "alt":
        return ("alt", [reverse(part) for part in node[1]])
    if kind == "rep":
        return ("rep", reverse(node[1]), *node[2:])
    return node


class _Nfa:
    def __init__(self):
        self.empty: list[list[int]] = []
        self.moves: list[list[tuple[frozenset, int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1

    def add(self, node, start: int) -> int:
        """Build ``node`` from ``start``; the state it ends in."""
        kind = node[0]
        if kind == "set":
            end = self.state()
            self.moves[start].append((node[1], end))
            return end
        if kind == "cat":
            for part in node[1]:
                start = self.add(part, start)
            return start
        if kind == "alt":
            end = self.state()
            for part in node[1]:
                first = self.state()
                self.empty[start].append(first)
                self.empty[self.add(part, first)].append(end)
            return end
        _, inner, low, high = node
        for _ in range(low):
            start = self.add(inner, start)
        if high is None:
            loop = self.state()
            self.empty[start].append(loop)
            self.empty[self.add(inner, loop)].append(loop)
            return loop
        end = self.state()
        for _ in range(high - low):
            self.empty[start].append(end)
            start = self.add(inner, start)
        self.empty[start].append(end)
        return end

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for nxt in self.empty[todo.pop()]:
                if nxt not in seen:
                    seen.add(nxt)
                    todo.append(nxt)
        return frozenset(seen)


class Automaton:
    """A minimal deterministic automaton over bytes for several patterns at once.

    ``moves`` is one flat transition array: the state after byte ``b`` in state ``s`` is
    ``moves[s + b]``, states being multiples of 256 with the accepting ones last, from
    ``accepting`` on. ``found[s >> 8]`` has bit ``i`` set where pattern ``i`` has just
    matched. ``anywhere`` lets matches begin at every byte; else they begin at the first
    and state ``dead`` says that none can follow. With ``once`` a pattern that has matched
    is followed no further, which is enough to tell whether it matches at all and keeps
    the open ends of several patterns from multiplying the states.
    """

    def __init__(self, nodes: Sequence, anywhere: bool, once: bool = False):
        nfa = _Nfa()
        ends: dict[int, int] = {}
        starts = []
        owner: list[int] = []
        for i, node in enumerate(nodes):
            start = nfa.state()
            starts.append(start)
            end = nfa.add(node, start)
            owner += [i] * (len(nfa.empty) - len(owner))
            ends[end] = ends.get(end, 0) | 1 << i
        first = nfa.closure(starts)
        index, todo, rows, masks = {first: 0}, [first], [], []
        while todo:  # subset construction
            states = todo.pop(0)
            mask = sum(ends.get(s, 0) for s in states)
            masks.append(mask)
            if once:
                states = {s for s in states if not mask >> owner[s] & 1} | (first if anywhere else set())
            targets: list[set[int]] = [set() for _ in range(256)]
            for s in states:
                for codes, nxt in nfa.moves[s]:
                    for c in codes:
                        targets[c].add(nxt)
            row, known = [], {}
            for reached in map(frozenset, targets):
                if reached not in known:
                    nxt = nfa.closure(reached) | (first if anywhere else frozenset())
                    if nxt not in index:
                        index[nxt] = len(index)
                        todo.append(nxt)
                    known[reached] = index[nxt]
                row.append(known[reached])
            rows.append(row)
        moves, masks, first_class = _minimal(np.array(rows), np.array(masks))
        order = np.lexsort((np.arange(len(masks)), masks != 0))
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        self.start = int(place[first_class]) << 8
        self.moves = [int(x) for x in (place[moves[order]] << 8).ravel()]
        self.found = [int(x) for x in masks[order]]
        self.accepting = int((masks == 0).sum()) << 8
        self.dead = next(
            (s << 8 for s in range(len(order)) if not self.found[s]
             and all(x == s << 8 for x in self.moves[s << 8 : (s + 1) << 8])), -1,
        )

    def patterns_in(self, data: bytes) -> int:
        """One pass over the bytes: which patterns match somewhere, as bits."""
        state, seen, moves, accepting, found = self.start, 0, self.moves, self.accepting, self.found
        for byte in data:
            state = moves[state + byte]
            if state >= accepting:
                seen |= found[state >> 8]
        return seen

    def match_places(self, data: bytes) -> list[tuple[int, int]]:
        """(bytes read, patterns as bits) wherever patterns have just matched."""
        state, out, moves, accepting, found = self.start, [], self.moves, self.accepting, self.found
        for i, byte in enumerate(data, 1):
            state = moves[state + byte]
            if state >= accepting:
                out.append((i, found[state >> 8]))
        return out

    def longest(self, data: bytes, at: int) -> int:
        """Where the longest match that begins at ``at`` ends, -1 if none does."""
        state, end, dead = self.start, at if self.start >= self.accepting else -1, self.dead
        for i in range(at, len(data)):
            state = self.moves[state + data[i]]
            if state >= self.accepting:
                end = i + 1
            elif state == dead:
                break
        return end


def _minimal(moves: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """States that no continuation tells apart become one: classes are split until stable."""
    classes = np.unique(masks, return_inverse=True)[1]
    while True:
        signature = np.column_stack([classes, classes[moves]])
        _, first, finer = np.unique(signature, axis=0, return_index=True, return_inverse=True)
        finer = finer.ravel()
        if len(first) == classes.max() + 1:
            return finer[moves[first]], masks[first], int(finer[0])
        classes = finer
