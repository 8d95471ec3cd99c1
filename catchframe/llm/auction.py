"""Cheapest repair of a run of turns by the auction algorithm for shortest paths.

The lattice has a layer before each row and one after the last; a node is a layer and what came out
last: nothing, a system turn, a user turn or an assistant turn.  Arcs are edits with integer costs.
Each node has a price.  A path starts at the origin.  Where the price of its last node is below
the least cost of an arc plus the price behind it, the price rises to that and the path
contracts by a node; else the path extends along that arc.  Prices stay dual feasible, price(i) <=
cost(i, j) + price(j), so when the path reaches the end it is a shortest one, and every shortest path
consists of tight arcs, those with equality.  The cheapest edits with the least letters are
traced along tight arcs that lead to the end.

Prices start at the costs that no repair avoids: deletions, and the cheaper end of cut-off turns.
"""

from __future__ import annotations

from functools import lru_cache

DELETE, INSERT, REROLE, CUT = 2, 5, 1, 5
# States: nothing yet, system, user, assistant; and the turn that a change or an insertion gives next.
STATES = 4
EMPTY, SYSTEM, USER, ASSISTANT = range(STATES)
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
# Faults of a row: none, blank, repeated, cut off.
FINE, BLANK, COPY, SHORT = "-bdt"

Arc = tuple[str, int, int]


def _edits(initial: str, fault: str, state: int) -> list[tuple[str, int, int]]:
    """Edits of a row: letter, cost and state after it."""
    out = [("D", DELETE, state)]
    if fault in (BLANK, COPY):
        return out
    more, turn = CUT if fault == SHORT else 0, NEXT[state]
    if (initial == "s" and state == EMPTY) or initial == "ua"[turn - USER]:
        out.append(("K", more, SYSTEM if initial == "s" else turn))
    out.append(("R", REROLE + more, turn))
    return out


class Lattice:
    """Nodes and arcs over the rows; ``closed`` adds insertions after the last row and the end of a whole conversation."""

    def __init__(self, initials: str, faults: str, closed: bool):
        self.rows = len(initials)
        self.arcs: list[list[Arc]] = []
        for t in range(self.rows):
            steps: dict[int, list[tuple[str, int, int]]] = {}
            for state in range(STATES):
                steps[state] = _edits(initials[t], faults[t], state)
            for state in range(STATES):
                arcs = [(letter, cost, (t + 1) * STATES + to) for letter, cost, to in steps[state]]
                self.arcs.append([*arcs, ("I", INSERT, t * STATES + NEXT[state])])
        last = self.rows * STATES
        self.end = last + STATES
        for state in range(STATES):
            self.arcs.append([("I", INSERT, last + NEXT[state])] if closed else [])
        if closed:
            for state in (EMPTY, ASSISTANT):
                self.arcs[last + state].append(("", 0, self.end))
            self.arcs.append([])
        # What the rows from each layer on cost at least.
        self.least = [0] * (self.rows + 2)
        for t in range(self.rows - 1, -1, -1):
            self.least[t] = self.least[t + 1] + (0 if faults[t] == FINE else min(DELETE, CUT))

    def towards(self, goal: int) -> Prices:
        return Prices(self, goal)


class Prices:
    """Dual prices towards one goal; they are kept from origin to origin, since they stay feasible."""

    def __init__(self, lattice: Lattice, goal: int):
        self.goal = goal
        self.arcs = self._leading(lattice.arcs, goal)
        self.price = [lattice.least[min(i // STATES, lattice.rows + 1)] for i in range(len(lattice.arcs))]

    @staticmethod
    def _leading(arcs: list[list[Arc]], goal: int) -> list[list[Arc]]:
        """Only arcs to nodes from which the goal can be reached, by layers from the last one."""
        ok = bytearray(len(arcs))
        ok[goal] = 1
        for layer in range((len(arcs) - 1) // STATES, -1, -1):
            nodes = range(layer * STATES, min((layer + 1) * STATES, len(arcs)))
            # Insertions stay in the layer: two rounds cover a chain of two, system, user, assistant.
            for _ in range(3):
                for i in nodes:
                    ok[i] = ok[i] or any(ok[j] for _, _, j in arcs[i])
        return [[a for a in out if ok[a[2]]] for out in arcs]

    def settle(self, origin: int) -> bool:
        """The auction from an origin; false where no way leads to the goal."""
        arcs, price, goal = self.arcs, self.price, self.goal
        if origin != goal and not arcs[origin]:
            return False
        path = [origin]
        while path[-1] != goal:
            i = path[-1]
            best, head = min((cost + price[j], j) for _, cost, j in arcs[i])
            if price[i] < best:
                price[i] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(head)
        return True

    def trace(self, origin: int) -> tuple[int, str]:
        """Cost and letters of the cheapest way from a settled origin; of equal ones the least letters."""
        arcs, price, goal = self.arcs, self.price, self.goal
        tight: dict[int, list[tuple[str, int]]] = {}
        todo, seen, back = [origin], {origin}, {}
        while todo:
            i = todo.pop()
            tight[i] = [(letter, j) for letter, cost, j in arcs[i] if price[i] == cost + price[j]]
            for _, j in tight[i]:
                back.setdefault(j, []).append(i)
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ends, todo = {goal}, [goal]
        while todo:
            for i in back.get(todo.pop(), ()):
                if i not in ends:
                    ends.add(i)
                    todo.append(i)
        letters, i = [], origin
        while i != goal:
            letter, i = min((letter, j) for letter, j in tight[i] if j in ends)
            letters.append(letter)
        return price[origin] - price[goal], "".join(letters)


@lru_cache(maxsize=20_000)
def repair(initials: str, faults: str) -> tuple[int, str]:
    """Cost and edits of a whole conversation."""
    lattice = Lattice(initials, faults, True)
    prices = lattice.towards(lattice.end)
    prices.settle(EMPTY)
    return prices.trace(EMPTY)


def crossings(initials: str, faults: str) -> list[tuple[int, str] | None]:
    """Cost and edits of a part of a conversation from each state to each state, row by row; ``None`` without a way.

    Insertions after the last row belong to the next part.
    """
    lattice = Lattice(initials, faults, False)
    out: list[tuple[int, str] | None] = [None] * (STATES * STATES)
    for to in range(STATES):
        prices = lattice.towards(lattice.rows * STATES + to)
        for start in range(STATES):
            if prices.settle(start):
                out[start * STATES + to] = prices.trace(start)
    return out


def joined(a: list, b: list) -> list:
    """Crossings of two parts, one after the other."""
    out = []
    for start in range(STATES):
        for to in range(STATES):
            ways = [
                (x[0] + y[0], x[1] + y[1])
                for k in range(STATES) if (x := a[start * STATES + k]) and (y := b[k * STATES + to])
            ]
            out.append(min(ways, default=None))
    return out


def closed(cells: list) -> tuple[int, str]:
    """Cost and edits of a whole conversation from the crossings of its rows."""
    lattice = Lattice("", "", True)
    prices = lattice.towards(lattice.end)
    ways = []
    for state in range(STATES):
        if cells[state] and prices.settle(state):
            cost, letters = prices.trace(state)
            ways.append((cells[state][0] + cost, cells[state][1] + letters))
    return min(ways)
