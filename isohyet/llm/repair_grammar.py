"""Repair of role sequences by weighted interval parsing.

The sequences `(s?(ua)+)?` of role initials are read by four states: start, after
s, after u, after a. The grammar in Chomsky normal form has one symbol per pair
of states, [p,q] -> [p,r] [r,q], and the terminals are edits of a row. A cell of
an interval of rows holds, per symbol, the cheapest (cost, audit): cost first, then the
ASCII-least string of edit initials. Insertions are no rows, so each
terminal cell is closed with the cheapest insertions on both sides.

Every derivation of [p,q] over an interval passes some state at any given row, so
a cell is the same for every place at which its interval is cut. One cut in the middle is
enough, and intervals are combined bottom-up by length: 1, 2, 4, ... Equal costs
over the same rows mean equally many insertions, so no audit of a cell is a proper prefix of
a rival's, and the smaller of two stays the smaller when more is appended.
"""

from __future__ import annotations

START, SYSTEM, USER, ASSISTANT = range(4)
# Where a role initial leads from each state.
STEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ROLES = {"u": "user", "a": "assistant"}
# The symbols of the grammar that derive anything: q can be reached from p.
PAIRS = [(0, 0), (0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 2), (3, 3)]
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
# A row is one letter: its role initial and its first fault.
INITIALS, FAULTS = "suax", ("none", "truncated", "duplicate", "blank")
LETTERS = "ABCDEFGHIJKLMNOP"

Cell = dict[tuple[int, int], tuple[int, str]]


def letter(initial: str, fault: str) -> str:
    return LETTERS[4 * INITIALS.index(initial if initial in ("s", "u", "a") else "x") + FAULTS.index(fault)]


def initial_of(code: str) -> str:
    return INITIALS[LETTERS.index(code) // 4]


def fault_of(code: str) -> str:
    return FAULTS[LETTERS.index(code) % 4]


def combined(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring intervals as one."""
    out: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for q in range(4):
            other = right.get((r, q))
            if other is None:
                continue
            total, best = cost + other[0], out.get((p, q))
            if best is None or total < best[0]:
                out[p, q] = (total, audit + other[1])
            elif total == best[0]:
                out[p, q] = min(best, (total, audit + other[1]))
    return out


def _insertions() -> Cell:
    """The cell of no rows: nothing, or the cheapest insertions between two states."""
    cell: Cell = {(p, p): (0, "") for p in range(4)}
    for (p, initial), q in STEPS.items():
        if initial in ROLES:
            cell[p, q] = (COST[INSERT], INSERT)
    while (grown := combined(cell, cell)) != cell:
        cell = grown
    return cell


NO_ROWS = _insertions()


def _terminal(code: str) -> Cell:
    initial, fault = initial_of(code), fault_of(code)
    cell: Cell = {(p, p): (COST[DELETE], DELETE) for p in range(4)}
    if fault in ("none", "truncated"):
        extra = int(fault == "truncated")
        edits = [(step, COST[KEEP] + extra, KEEP) for step in STEPS if step[1] == initial]
        edits += [(step, COST[REROLE] + extra, REROLE) for step in STEPS if step[1] in ROLES]
        for step, cost, edit in edits:
            key = (step[0], STEPS[step])
            cell[key] = min(cell.get(key, (cost, edit)), (cost, edit))
    return combined(combined(NO_ROWS, cell), NO_ROWS)


TERMINALS = {code: _terminal(code) for code in LETTERS}


class Parser:
    """Cells of words of row letters. Short words are remembered, at most `remembered` of them."""

    def __init__(self, remembered: int = 50_000, short: int = 16):
        self.known: dict[str, Cell] = {"": NO_ROWS}
        self.remembered, self.short = remembered, short

    def cell(self, word: str) -> Cell:
        known = self.known.get(word)
        if known is not None:
            return known
        spans = [word[i:i + self.short] for i in range(0, len(word), self.short)]
        cells = merged([self._small(s) for s in spans])
        if len(word) <= self.short:
            if len(self.known) > self.remembered:
                self.known = {"": NO_ROWS}
            self.known[word] = cells
        return cells

    def _small(self, word: str) -> Cell:
        known = self.known.get(word)
        return known if known is not None else merged([TERMINALS[c] for c in word])


def merged(cells: list[Cell]) -> Cell:
    """The cell of neighbouring intervals, combined bottom-up: pairs, then pairs of pairs."""
    if not cells:
        return NO_ROWS
    while len(cells) > 1:
        pairs = [combined(a, b) for a, b in zip(cells[::2], cells[1::2])]
        cells = pairs + cells[len(pairs) * 2:]
    return cells[0]


def best(cell: Cell) -> tuple[int, str]:
    """Cost and audit of the cheapest whole repair."""
    return min(cell[key] for key in ((START, START), (START, ASSISTANT)) if key in cell)


def next_role(state: int) -> str:
    """The role that a rerole or an insertion gives in a state."""
    return "assistant" if state == USER else "user"
