"""Cheapest edits of one conversation, turn by turn: Viterbi over four states with coalescing survivors.

A state is what the repaired roles end in: nothing yet, the system turn, a user or an assistant. Each state keeps one
survivor, a path in a tree of back pointers; a node knows its living children, which is its reference count. Paths that no
survivor leads to are freed, and as soon as all survivors share an ancestor beyond the root, the edits up to there are final
and handed out, so only the unresolved suffix is in memory.

Of equally cheap edits those whose initials come first in ASCII win. Survivors of one turn that differ are never prefixes of each
other (a further initial that is no insertion would be a further turn), so their order is settled by their rank and the initials
added since: the rank carries the comparison of the complete unresolved suffixes from turn to turn, and no suffix is
walked twice. A state is given up once another one can do all that it can for less: an equal total is never given up.
"""

from __future__ import annotations

from functools import cache

EMPTY, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: What may follow a state, and the state after it.
NEXT = {EMPTY: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
#: Insertions from a state that reach another state as cheaply as any: their initials.
BEFORE = {EMPTY: ("", "u", "ua"), SYSTEM: ("", "u", "ua"), USER: ("", "a"), ASSISTANT: ("", "u")}
#: (state, other): what the other state's way to the end can cost more than the state's at most.
EXTRA = {(EMPTY, ASSISTANT): DELETE, (EMPTY, USER): INSERT + DELETE, (EMPTY, SYSTEM): 2 * INSERT,
         (SYSTEM, ASSISTANT): 0, (SYSTEM, EMPTY): 0, (SYSTEM, USER): INSERT,
         (USER, ASSISTANT): INSERT, (USER, EMPTY): INSERT, (USER, SYSTEM): INSERT,
         (ASSISTANT, USER): INSERT, (ASSISTANT, EMPTY): 0, (ASSISTANT, SYSTEM): 2 * INSERT}


def _after(state: int, initials: str) -> int:
    for c in initials:
        state = NEXT[state][c]
    return state


@cache
def choices(state: int, initial: str, must_go: bool, truncated: bool) -> list[tuple]:
    """(cost, initials of the edits, insertions, edit, new role or None, state after) of one turn."""
    out = []
    for new in BEFORE[state]:
        at, cost, tail = _after(state, new), INSERT * len(new), "I" * len(new)
        out.append((cost + DELETE, tail + "D", new, "D", None, at))
        if must_go:
            continue
        if initial in NEXT[at]:
            out.append((cost + TRUNCATED * truncated, tail + "K", new, "K", None, NEXT[at][initial]))
        for c in NAMES:
            if c in NEXT[at]:
                out.append((cost + REROLE + TRUNCATED * truncated, tail + "R", new, "R", NAMES[c], NEXT[at][c]))
    return out


class Node:
    __slots__ = ("parent", "kids", "edit")

    def __init__(self, parent: Node | None, edit: tuple | None) -> None:
        self.parent, self.kids, self.edit = parent, [], edit
        if parent is not None:
            parent.kids.append(self)


class Survivors:
    """``turn`` takes the turns in order and ``end`` closes; both return the edits (turn, insertions, edit, new role) that became final."""

    def __init__(self) -> None:
        self.root = Node(None, None)
        self.tips = {EMPTY: (0, 0, self.root)}  # state: cost, rank, node

    def turn(self, info, initial: str, must_go: bool, truncated: bool) -> list[tuple]:
        best: dict[int, tuple] = {}
        for state, (cost, rank, node) in self.tips.items():
            for choice in choices(state, initial, must_go, truncated):
                key = (cost + choice[0], rank, choice[1])
                if choice[5] not in best or key < best[choice[5]][0]:
                    best[choice[5]] = key, node, choice
        live = [(key, state, node, choice) for state, (key, node, choice) in best.items()
                if not any(key[0] > best[other][0][0] + EXTRA[state, other] for other in best if other != state)]
        live.sort(key=lambda x: x[0][1:])
        old = [node for _, _, node in self.tips.values()]
        self.tips = {state: (key[0], rank, Node(node, (info, choice[2], choice[3], choice[4])))
                     for rank, (key, state, node, choice) in enumerate(live)}
        for node in old:
            while not node.kids and node.parent is not None:  # nothing refers to it any more
                node.parent.kids.remove(node)
                node = node.parent
        return self._agreed()

    def _agreed(self) -> list[tuple]:
        out = []
        while len(self.root.kids) == 1:
            self.root = self.root.kids[0]
            self.root.parent = None
            out.append(self.root.edit)
        return out

    def end(self) -> tuple[list[tuple], str, int]:
        """The remaining edits, the insertions after them and the cost of it all."""
        last = [((cost + INSERT * len(new), rank, "I" * len(new)), node, new) for state, (cost, rank, node) in self.tips.items()
                for new in BEFORE[state] if _after(state, new) in (EMPTY, ASSISTANT)]
        (cost, _, _), node, new = min(last, key=lambda x: x[0])
        rest = []
        while node is not self.root:
            rest.append(node.edit)
            node = node.parent
        return rest[::-1], new, cost
