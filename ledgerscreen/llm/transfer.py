"""Min-plus transfer matrices over audit ropes, and Re-Pair rules that share them.

A turn is a letter: its role's class (system, user, assistant, other) and its fault (none,
truncated, to be deleted).  The states are those of a repaired conversation: 0 nothing
yet, 1 after its system turn, 2 after a user turn, 3 after an assistant turn; it may end in 0 or 3.  A
matrix holds, for a stretch of turns and each pair of states, the least cost of editing it
from one to the other and the edits' initials that reach it, ASCII-least among equal costs.

Insertions stand before a turn or at the very end, so every string of a stretch ends with the
edit of its last turn, and of two different strings of a stretch none begins the other.
Comparing first differences is therefore compatible with joining stretches, and
ranks of strings may stand for the strings in a product of stretches.
"""

from __future__ import annotations

MODULUS, BASE = (1 << 61) - 1, 911_382_323
CLASSES = "sua"          # any other initial: class 3
FAULTS = ("none", "truncated", "delete")
LETTERS = "abcdefghijkl"
STATES = 4
REROLE, DELETE, INSERT = 2, 3, 2
#: Legal steps: (state, class) -> state.
STEP = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}
#: Classes that may stand side by side.
BESIDE = {(0, 1), (1, 2), (2, 1)}
#: Insertions from a state on to the end, and the states that they pass.
TAIL = {0: "", 1: "II", 2: "I", 3: ""}


class Rope:
    """A string as a tree of shared pieces, with its length and a polynomial hash."""
    __slots__ = ("text", "left", "right", "length", "hash", "power")

    def __init__(self, text: str = "", left=None, right=None):
        self.text, self.left, self.right = text, left, right
        if left is None:
            self.length, self.hash, self.power = len(text), 0, pow(BASE, len(text), MODULUS)
            for c in text:
                self.hash = (self.hash * BASE + ord(c)) % MODULUS
        else:
            self.length = left.length + right.length
            self.power = left.power * right.power % MODULUS
            self.hash = (left.hash * right.power + right.hash) % MODULUS

    def __add__(self, other: Rope) -> Rope:
        return self if not other.length else other if not self.length else Rope("", self, other)

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            x = todo.pop()
            if x.left is None:
                out.append(x.text)
            else:
                todo += [x.right, x.left]
        return "".join(out)

    def __lt__(self, other: Rope) -> bool:
        """By first difference; pieces of equal length and hash are passed whole."""
        a, b = [self], [other]
        while a and b:
            x, y = a.pop(), b.pop()
            if x.length == y.length and x.hash == y.hash:
                continue
            if x.left is not None and (x.length >= y.length or y.left is None):
                a += [x.right, x.left]
                b.append(y)
            elif y.left is not None:
                b += [y.right, y.left]
                a.append(x)
            else:
                n = min(x.length, y.length)
                if x.text[:n] != y.text[:n]:
                    return x.text < y.text
                if x.length > n:
                    a.append(Rope(x.text[n:]))
                if y.length > n:
                    b.append(Rope(y.text[n:]))
        return bool(b) and not a


#: A matrix maps (from, to) to (cost, rope); a missing entry is impossible.
Matrix = dict


def better(best: dict, at, cost: int, rope: Rope) -> bool:
    """Enter a candidate; true if it is now the best one."""
    old = best.get(at)
    if old is None or cost < old[0] or (cost == old[0] and rope < old[1]):
        best[at] = (cost, rope)
        return True
    return False


def times(a: Matrix, b: Matrix) -> Matrix:
    out: Matrix = {}
    starts: dict = {}
    for (j, k), (cost, rope) in b.items():
        starts.setdefault(j, []).append((k, cost, rope))
    for (i, j), (cost, rope) in a.items():
        for k, more, end in starts.get(j, ()):
            old = out.get((i, k))
            if old is None or cost + more <= old[0]:
                better(out, (i, k), cost + more, rope + end)
    return out


def insertions() -> Matrix:
    """Any number of inserted user or assistant turns."""
    out: Matrix = {(i, i): (0, Rope()) for i in range(STATES)}
    for i in range(STATES):
        state, cost = i, 0
        for _ in range(2):
            state, cost = (3 if state == 2 else 2), cost + INSERT
            better(out, (i, state), cost, Rope("I" * (cost // INSERT)))
    return out


def letter_matrix(letter: str) -> Matrix:
    """Insertions, then one edit of the turn."""
    kind, fault = divmod(LETTERS.index(letter), len(FAULTS))
    edit: Matrix = {(i, i): (DELETE, Rope("D")) for i in range(STATES)}
    if FAULTS[fault] != "delete":
        extra = int(FAULTS[fault] == "truncated")
        for i in range(STATES):
            for cls, cost, mark in ((kind, 0, "K"), (1, REROLE, "R"), (2, REROLE, "R")):
                if (i, cls) in STEP:
                    better(edit, (i, STEP[i, cls]), cost + extra, Rope(mark))
    return times(insertions(), edit)


def ranked(matrix: Matrix) -> tuple[list, list]:
    """(costs, ranks of the strings) of all entries, row by row; None if impossible."""
    texts = sorted({str(rope) for _, rope in matrix.values()})
    place = {t: k for k, t in enumerate(texts)}
    at = [(i, j) for i in range(STATES) for j in range(STATES)]
    return ([matrix[x][0] if x in matrix else None for x in at],
            [place[str(matrix[x][1])] if x in matrix else None for x in at])


def from_ranks(costs: list, ranks: list) -> Matrix:
    """A matrix whose strings are single letters in the order of the ranks."""
    return {divmod(k, STATES): (c, Rope(chr(65 + ranks[k]))) for k, c in enumerate(costs) if c is not None}


def path(matrices: list[Matrix], start: int, end: int) -> list[int]:
    """The states between the stretches on the best way from ``start`` to ``end``."""
    best, back = {start: (0, Rope())}, []
    for m in matrices:
        new, came = {}, {}
        for (i, j), (cost, rope) in m.items():
            if i in best and better(new, j, best[i][0] + cost, best[i][1] + rope):
                came[j] = i
        best = new
        back.append(came)
    states = [end]
    for came in reversed(back):
        states.append(came[states[-1]])
    return states[::-1]


def last_state(costs: list, ranks: list) -> int:
    """Where the best whole repair ends (before closing insertions); it begins in 0."""
    found = [(costs[j] + INSERT * len(TAIL[j]), ranks[j], j) for j in range(STATES) if costs[j] is not None]
    return min(found)[2]


def illegal(letters: str) -> int:
    """Neighbours whose classes may not stand side by side."""
    kinds = [LETTERS.index(x) // len(FAULTS) for x in letters]
    return sum(pair not in BESIDE for pair in zip(kinds, kinds[1:]))


class Grammar:
    """Rules of a Re-Pair grammar in the order of their making; symbols are the letters'
    places, then the rules.  Rounds of rules that cannot overlap are replaced together."""

    def __init__(self):
        self.rounds: list[dict] = []
        self.matrices: list[Matrix] = [letter_matrix(x) for x in LETTERS]

    def __len__(self) -> int:
        return len(self.matrices) - len(LETTERS)

    def add(self, pairs: list[tuple[int, int]]) -> int:
        """Those of ``pairs`` (best first) that cannot overlap one another become rules."""
        chosen: dict = {}
        heads, ends = set(), set()
        for a, b in pairs:
            if a in ends or b in heads:
                continue
            chosen[a, b] = len(self.matrices)
            self.matrices.append(times(self.matrices[a], self.matrices[b]))
            heads.add(a)
            ends.add(b)
        if chosen:
            self.rounds.append(chosen)
        return len(chosen)

    def compress(self, letters: str) -> list[int]:
        symbols = [LETTERS.index(x) for x in letters]
        for rules in self.rounds:
            out, k = [], 0
            while k < len(symbols):
                rule = rules.get((symbols[k], symbols[k + 1])) if k + 1 < len(symbols) else None
                out.append(symbols[k] if rule is None else rule)
                k += 1 if rule is None else 2
            symbols = out
        return symbols

    def matrix(self, letters: str) -> Matrix:
        """Of a whole stretch: one product per symbol that is left."""
        out = None
        for s in self.compress(letters):
            out = self.matrices[s] if out is None else times(out, self.matrices[s])
        return out
