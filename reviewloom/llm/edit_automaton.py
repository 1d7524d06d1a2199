"""Minimised acceptors of finite word sets, and their composition with a one-edit transducer."""

from __future__ import annotations

from collections.abc import Iterator

# A state is a number; its arcs are a dict from a code point to the next state.
Arcs = dict[str, int]


class Acceptor:
    """The smallest deterministic acyclic acceptor of distinct, sorted words.

    Words are added in order. Once the next word leaves a branch, the branch's states are
    final and each is replaced by an equal one if there is one already: states are equal
    if they accept alike and have the same arcs.
    """

    def __init__(self, words: list[str]):
        self.arcs: list[Arcs] = []
        self.accepts: list[bool] = []
        self._known: dict[tuple, int] = {}
        # the branch of the last word: arcs so far, and whether the word ends there
        branch: list[tuple[Arcs, bool]] = [({}, False)]
        last = ""
        for word in words:
            shared = 0
            while shared < min(len(word), len(last)) and word[shared] == last[shared]:
                shared += 1
            self._close(branch, last, shared)
            branch += [({}, False) for _ in word[shared:]]
            branch[-1] = (branch[-1][0], True)
            last = word
        self._close(branch, last, 0)
        self.initial = self._state(*branch[0])

    def _state(self, arcs: Arcs, accepts: bool) -> int:
        name = (accepts, *arcs.items())
        if name not in self._known:
            self._known[name] = len(self.arcs)
            self.arcs.append(arcs)
            self.accepts.append(accepts)
        return self._known[name]

    def _close(self, branch: list[tuple[Arcs, bool]], word: str, keep: int) -> None:
        while len(branch) > keep + 1:
            state = self._state(*branch.pop())
            branch[-1][0][word[len(branch) - 1]] = state


class OneEdit:
    """Enumerates the pairs that an acceptor, a transducer of exactly one edit and the same
    acceptor accept together.

    The transducer has two states: before the edit it copies a code point, replaces it by
    another or inserts one; after it, it copies. A deletion is the insertion seen from the
    other word. Copying before the edit reads the same prefix on both sides, so there both
    acceptors are in one state. After it, what can follow depends only on the pair of
    states, and is found once per pair.
    """

    def __init__(self, acceptor: Acceptor):
        self._of = acceptor
        self._found: dict[tuple[int, int], list[str]] = {}

    def _common(self, p: int, q: int) -> list[str]:
        """What both states accept: the composed machine after the edit."""
        pair = (p, q) if p <= q else (q, p)
        found = self._found.get(pair)
        if found is None:
            ours, theirs = self._of.arcs[p], self._of.arcs[q]
            found = [""] if self._of.accepts[p] and self._of.accepts[q] else []
            if len(theirs) < len(ours):
                ours, theirs = theirs, ours
            for char, following in ours.items():
                if char in theirs:
                    found += [char + rest for rest in self._common(following, theirs[char])]
            self._found[pair] = found
        return found

    def pairs(self) -> Iterator[tuple[str, str]]:
        """Each pair of accepted words one edit apart, once; the shorter word comes first."""
        waiting = [("", self._of.initial)]
        while waiting:
            prefix, state = waiting.pop()
            arcs = list(self._of.arcs[state].items())
            for i, (char, following) in enumerate(arcs):
                waiting.append((prefix + char, following))
                for other, beside in arcs[i + 1 :]:
                    for rest in self._common(following, beside):
                        yield prefix + char + rest, prefix + other + rest
                # inserted before an equal code point is the same as after it: done there
                for rest in self._common(state, following):
                    if not rest.startswith(char):
                        yield prefix + rest, prefix + char + rest
