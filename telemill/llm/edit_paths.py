"""Cheapest edits that give a conversation the order ``(s?(ua)+)?`` of role initials, of equal cost the least in ASCII order.

A dynamic program over the rows keeps, per state of that order, the cheapest edits so far. Edits are
nodes that share their beginning: a node is a letter and a link to the node before it, with its
ancestors at distances of powers of two and a rolling hash of all its letters. Ties are decided
at the first letter after the longest common beginning, which is searched by ancestors and hashes;
the beginnings that hashes call equal are then walked to the node they share.

The letters and the rows fix the cost, so two ways of equal cost at one row and state differ
before either ends, and the lesser beginning stays the lesser whatever follows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

#: states: nothing yet, after the system row, after a user row, after an assistant row
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = (NOTHING, SYSTEM, USER, ASSISTANT)
ACCEPTED = (NOTHING, ASSISTANT)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: fixed values: what edits cost
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
MODULUS, FACTOR = (1 << 61) - 1, 0x1E3779B97F4A7C15


class Turn(NamedTuple):
    """What the program needs of a row: the role's initial, and whether it must go or ends early."""

    initial: str
    must_go: bool
    truncated: bool


class Best(NamedTuple):
    cost: int
    node: int


def after_keeping(state: int, initial: str) -> int | None:
    if initial == "s":
        return SYSTEM if state == NOTHING else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


def wanted(state: int) -> int:
    """The state after a row with the role that has to come next."""
    return ASSISTANT if state == USER else USER


class Paths:
    """Sequences of letters as linked nodes; node 0 is the empty sequence."""

    def __init__(self) -> None:
        self.letter, self.depth, self.hash = [""], [0], [0]
        self.ancestors: list[list[int]] = [[]]

    def add(self, before: int, letter: str) -> int:
        node, known = len(self.letter), self.ancestors
        self.letter.append(letter)
        self.depth.append(self.depth[before] + 1)
        self.hash.append(self.digest(self.hash[before], letter))
        far = [before]
        while len(known[far[-1]]) >= len(far):
            far.append(known[far[-1]][len(far) - 1])
        known.append(far)
        return node

    @staticmethod
    def digest(before: int, letter: str) -> int:
        return (before * FACTOR + ord(letter)) % MODULUS

    def at_depth(self, node: int, depth: int) -> int:
        while (over := self.depth[node] - depth) > 0:
            node = self.ancestors[node][over.bit_length() - 1]
        return node

    def spelled(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.ancestors[node][0]
        return "".join(reversed(out))

    def less(self, left: int, right: int) -> bool:
        """Whether the letters of one node come before those of another in ASCII order."""
        depth = min(self.depth[left], self.depth[right])
        a, b = self.at_depth(left, depth), self.at_depth(right, depth)
        if a == b:
            return self.depth[left] < self.depth[right]
        up, hashes = self.ancestors, self.hash
        for k in range(len(up[a]) - 1, -1, -1):
            if k < len(up[a]) and hashes[up[a][k]] != hashes[up[b][k]]:
                a, b = up[a][k], up[b][k]
        if hashes[a] == hashes[b] or not self._same(up[a][0], up[b][0]):  # hashes met by chance
            return self.spelled(left) < self.spelled(right)
        return self.letter[a] < self.letter[b]

    def _same(self, a: int, b: int) -> bool:
        """Two sequences of one length are equal: their letters, as far as the node they share."""
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.ancestors[a][0], self.ancestors[b][0]
        return True


class Solution(NamedTuple):
    """The cheapest edits from one state to another."""

    start: int
    end: int
    cost: int
    edits: str


def solve(turns: list[Turn], start: int) -> Iterator[Solution]:
    """The cheapest edits of the rows from a state to each state that can be reached."""
    paths = Paths()
    best = _with_inserts({start: Best(0, 0)}, paths)
    for turn in turns:
        found: dict[int, Best] = {}
        late = TRUNCATED if turn.truncated else 0
        for state, (cost, node) in best.items():
            _offer(found, state, cost + DELETE, node, "D", paths)
            if turn.must_go:
                continue
            if (kept := after_keeping(state, turn.initial)) is not None:
                _offer(found, kept, cost + KEEP + late, node, "K", paths)
            _offer(found, wanted(state), cost + REROLE + late, node, "R", paths)
        best = _with_inserts(found, paths)
    for end, (cost, node) in best.items():
        yield Solution(start, end, cost, paths.spelled(node))


def _offer(found: dict[int, Best], state: int, cost: int, before: int, letter: str, paths: Paths) -> None:
    held = found.get(state)
    if held is None or cost < held.cost:
        found[state] = Best(cost, paths.add(before, letter))
    elif cost == held.cost:
        node = paths.add(before, letter)
        if paths.less(node, held.node):
            found[state] = Best(cost, node)


def _with_inserts(found: dict[int, Best], paths: Paths) -> dict[int, Best]:
    """Rows may be inserted after any: a user row, then an assistant row; a third never pays."""
    for state in (NOTHING, SYSTEM, ASSISTANT, USER):
        if state in found:
            cost, node = found[state]
            _offer(found, wanted(state), cost + INSERT, node, "I", paths)
    return found


def replay(rows: Iterable[tuple[str, str]], start: int, edits: str) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of each row that the edits leave or add."""
    state, given = start, iter(rows)
    for edit in edits:
        role, text = ("", "") if edit == "I" else next(given)
        if edit == "D":
            continue
        state = after_keeping(state, role[:1]) if edit == "K" else wanted(state)
        yield edit, role if edit == "K" else NAMES[state], text
