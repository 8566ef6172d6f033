"""Shortest edit sequences of a conversation by the auction algorithm, and their least trace.

A conversation is a string of row codes. Its lattice has four states after every row: nothing said yet,
the system's turn said, a user's turn said, a whole pair said. Arcs keep, rerole or delete the row, or
insert a turn; the end is a last pseudo-row, which only the first and the last state may pass.

``auction`` keeps a price for every node and a path from the origin. At the path's last node i it
compares price[i] with the least of cost + price[j] over the arcs: a lower price is raised to it and the
path contracts by i, an equal one extends the path by the best j. Prices never break
price[i] <= cost + price[j], so when the path meets the target they are a dual optimum: all arcs of all
shortest paths are tight. Tight arcs that lead to the target are followed by least letter; each letter
leads from a state to one other, so that this gives the least of the cheapest sequences.

An auction is pseudo-polynomial in the distance. A longer conversation is therefore cut into blocks of
``LEAF`` rows, whose transfer costs between states are found by auctions with shared prices, and blocks of
blocks in turn; every auction runs over at most ``LEAF`` layers, and the work grows in proportion to the
rows. On the way down a block is traced with the prices behind it as the costs of its exits.
"""

from __future__ import annotations

import functools

LEAF = 16
INF = 1 << 60
#: States: nothing yet, system said, user said, pair said.
STATES = 4
SYSTEM, USER, ASSISTANT, OTHER = range(4)
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)
END = 16
COST = {"D": 4, "I": 3, "K": 0, "R": 3}
CUT = 3  # of a truncated row that stays
#: State after a role, where the pattern (s?(ua)+)? allows it.
AFTER = ({SYSTEM: 1, USER: 2}, {USER: 2}, {ASSISTANT: 3}, {USER: 2})
#: The role that a rerole or an insertion takes in each state.
WANTED = (USER, USER, ASSISTANT, USER)


def code(role: int, fault: int) -> int:
    return 4 * fault + role


def _arcs(c: int) -> list[list[tuple[int, int, str]]]:
    """For each state the arcs (cost, next state, letter) over a row of this code, by letter."""
    if c == END:
        return [[(0, 0, "")], [], [], [(0, 0, "")]]
    fault, role = divmod(c, 4)
    out = []
    for q in range(STATES):
        arcs = [(COST["D"], q, "D")]
        if fault < BLANK:
            more = CUT if fault == TRUNCATED else 0
            if role in AFTER[q]:
                arcs.append((COST["K"] + more, AFTER[q][role], "K"))
            arcs.append((COST["R"] + more, AFTER[q][WANTED[q]], "R"))
        out.append(arcs)
    return out


ROW = [_arcs(c) for c in range(END + 1)]
INSERT = [(COST["I"], AFTER[q][WANTED[q]], "I") for q in range(STATES)]


def auction(arcs: list[list[tuple[int, int, str]]], origin: int, target: int, price: list[int]) -> int:
    """Distance of the target from the origin; raises the prices. All cycles must have positive cost, and
    every node that has a way from the origin must have one to the target."""
    path = [origin]
    while path[-1] != target:
        i = path[-1]
        best, to = INF, -1
        for cost, j, _ in arcs[i]:
            if cost + price[j] < best:
                best, to = cost + price[j], j
        if price[i] == best:
            path.append(to)
        else:
            price[i] = best
            if len(path) > 1:
                path.pop()
    return price[origin] - price[target]


def leading(arcs: list[list[tuple[int, int, str]]], target: int) -> list[bool]:
    """Nodes from which arcs lead to the target."""
    good = [False] * target + [True]
    for layer in range(target - STATES, -1, -STATES):
        for _ in range(3):  # insertions stay in a layer: from any state two of them reach all that they can
            for i in range(layer, layer + STATES):
                good[i] = good[i] or any(good[j] for _, j, _ in arcs[i])
    return good


def tight(arcs: list[list[tuple[int, int, str]]], price: list[int]) -> list[list[tuple[int, int, str]]]:
    return [[a for a in here if price[i] == a[0] + price[a[1]]] for i, here in enumerate(arcs)]


class Block:
    """Consecutive rows, or consecutive blocks."""

    def __init__(self, codes: bytes = b"", parts: list[Block] | None = None):
        self.codes, self.parts = codes, parts
        self.size = len(parts or codes)

    def lattice(self, exits: dict[int, int]) -> tuple[list[list[tuple[int, int, str]]], int]:
        """Arcs of every node, and the target; ``exits`` gives the cost from each state behind the block."""
        arcs: list[list[tuple[int, int, str]]] = []
        for k in range(self.size):
            base = STATES * (k + 1)
            for q in range(STATES):
                if self.parts is None:
                    here = [(c, base + to, x) for c, to, x in ROW[self.codes[k]][q]]
                    c, to, x = INSERT[q]
                    here.append((c, base - STATES + to, x))
                    here.sort(key=lambda arc: arc[2])
                else:
                    here = [(c, base + e, "") for e, c in enumerate(self.parts[k].costs()[q]) if c < INF]
                arcs.append(here)
        target = STATES * (self.size + 1)
        arcs += [[(exits[e], target, "")] if e in exits else [] for e in range(STATES)]
        good = leading(arcs, target)
        return [[a for a in here if good[a[1]]] for here in arcs], target

    def costs(self) -> tuple[tuple[int, ...], ...]:
        """Least cost from each state before the block to each one behind it."""
        if self.parts is None:
            return _leaf_costs(self.codes)
        if not hasattr(self, "_costs"):
            self._costs = _costs(self)
        return self._costs

    def trace(self, state: int, exits: dict[int, int]) -> tuple[str, int, int]:
        """Letters of the least of the cheapest ways from the state to an exit, that exit and the cost."""
        arcs, target = self.lattice(exits)
        price = [0] * (target + 1)
        cost = auction(arcs, state, target, price)
        arcs = tight(arcs, price)
        good = leading(arcs, target)
        letters: list[str] = []
        if self.parts is None:
            at = state
            while at < target - STATES:
                at, x = next((j, x) for _, j, x in arcs[at] if good[j])
                letters.append(x)
            return "".join(letters), at % STATES, cost
        for k, part in enumerate(self.parts):
            base = STATES * (k + 1)
            open_ = {e: price[base + e] for e in range(STATES) if good[base + e]}
            low = min(open_.values())
            text, state, _ = part.trace(state, {e: p - low for e, p in open_.items()})
            letters.append(text)
        return "".join(letters), state, cost


def _costs(block: Block) -> tuple[tuple[int, ...], ...]:
    out = [[INF] * STATES for _ in range(STATES)]
    for e in range(STATES):
        arcs, target = block.lattice({e: 0})
        price = [0] * (target + 1)
        for q in range(STATES):
            if arcs[q]:
                out[q][e] = auction(arcs, q, target, price)
    return tuple(map(tuple, out))


@functools.lru_cache(1 << 15)
def _leaf_costs(codes: bytes) -> tuple[tuple[int, ...], ...]:
    return _costs(Block(codes))


def _solve(codes: bytes) -> tuple[str, int]:
    codes += bytes([END])
    blocks = [Block(codes[k : k + LEAF]) for k in range(0, len(codes), LEAF)]
    while len(blocks) > 1:
        blocks = [Block(parts=blocks[k : k + LEAF]) for k in range(0, len(blocks), LEAF)]
    letters, _, cost = blocks[0].trace(0, {0: 0})
    return letters, cost


_short = functools.lru_cache(1 << 15)(_solve)


def cheapest(codes: bytes) -> tuple[str, int]:
    """Letters of the edits, and their cost."""
    return (_short if len(codes) <= 4 * LEAF else _solve)(codes)


def outcome(codes: bytes, letters: str) -> list[tuple[int, int | None]]:
    """Rows of the repaired conversation: (index of the row or -1, new role or None for its own)."""
    out, state, k = [], 0, 0
    for x in letters:
        if x == "K":
            out.append((k, None))
            state = AFTER[state][codes[k] % 4]
        elif x != "D":
            out.append((k if x == "R" else -1, WANTED[state]))
            state = AFTER[state][WANTED[state]]
        k += x != "I"
    return out
