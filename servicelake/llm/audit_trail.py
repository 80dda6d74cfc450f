"""Cheapest repairs of a run of turns, by dynamic programming over shared edit strings.

A repair is a string of edits: K keeps a row, R gives it the role that is due,
D deletes it, I inserts a row.  What a string makes of the rows, and so its
cost and the state it ends in, is determined by the string.  For each state the
program keeps the cheapest string up to the present row, the least in ASCII
order if several cost the same.

Strings are not copied.  Each is the end of a chain of nodes that shares its
beginning with others (a persistent list); a node knows its ancestors 1, 2, 4,
... steps back and the rolling hash of its string.  Two strings of the same cost
are compared at their first difference, which lifting both ends over ancestors
of unequal hashes finds in logarithmic time.  Where hashes meet, the nodes
themselves are compared, so a collision cannot decide.
"""

from __future__ import annotations

from functools import lru_cache

#: States: nothing yet; after system; after user; after assistant.  A conversation may end in the first and the last.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)

#: Cost of an insertion, a change of role, a deletion, and of a truncated row that stays.
INSERT, REROLE, DELETE, STAYS_TRUNCATED = 2, 2, 3, 1

#: A row as the program sees it: it must go, or its role's initial (s, u, a, any other), in upper case if it is truncated.
MUST_GO = "-"

#: State -> the role that an inserted or changed row gets there, and the state after it.
DUE = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}

#: What ends a conversation from each state: nothing, or one or two insertions.
END_COST = (0, 2 * INSERT, INSERT, 0)

_BASE, _MODULUS = 1_000_003, (1 << 61) - 1


def kept_state(state: int, symbol: str) -> int | None:
    """The state after a row is kept as it is, or None where its role is not due."""
    initial = symbol.lower()
    if initial == "s":
        return SYSTEM if state == START else None
    role, after = DUE[state]
    return after if initial == role[0] else None


class Trail:
    """Strings as chains of nodes; node 0 is the empty string."""

    def __init__(self, hash_of=None):
        self.up: list[tuple[int, ...]] = [()]  # ancestors 1, 2, 4, ... steps back
        self.depth = [0]
        self.letter = [""]
        self.hash = [0]
        self._hash_of = hash_of or (lambda before, letter: (before * _BASE + ord(letter)) % _MODULUS)

    def add(self, node: int, letter: str) -> int:
        """The string of ``node`` and one letter more."""
        ancestors = [node]
        k = 0
        while k < len(self.up[ancestors[k]]):
            ancestors.append(self.up[ancestors[k]][k])
            k += 1
        self.up.append(tuple(ancestors))
        self.depth.append(self.depth[node] + 1)
        self.letter.append(letter)
        self.hash.append(self._hash_of(self.hash[node], letter))
        return len(self.depth) - 1

    def back(self, node: int, steps: int) -> int:
        k = 0
        while steps:
            if steps & 1:
                node = self.up[node][k]
            steps >>= 1
            k += 1
        return node

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def _same(self, a: int, b: int) -> bool:
        """Whether two strings of one length are equal: letter by letter back to the node they share."""
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether the string of ``a`` comes before that of ``b`` (a beginning comes before what continues it)."""
        x, y = a, b
        if self.depth[a] > self.depth[b]:
            x = self.back(a, self.depth[a] - self.depth[b])
        else:
            y = self.back(b, self.depth[b] - self.depth[a])
        if self.hash[x] == self.hash[y]:
            return self.depth[a] < self.depth[b] if self._same(x, y) else self.text(a) < self.text(b)
        for k in reversed(range(len(self.up[x]))):
            if k < len(self.up[x]) and self.hash[self.up[x][k]] != self.hash[self.up[y][k]]:
                x, y = self.up[x][k], self.up[y][k]
        if not self._same(self.up[x][0], self.up[y][0]):  # equal hashes of different strings
            return self.text(a) < self.text(b)
        return self.letter[x] < self.letter[y]


class Repairs:
    """The cheapest strings that repair a run of rows, from one state on."""

    def __init__(self, symbols: str, start: int, trail: Trail | None = None):
        self.trail = trail or Trail()
        self.cost: list[int | None] = [None] * 4
        self.node: list[int | None] = [None] * 4
        self.cost[start], self.node[start] = 0, 0
        for symbol in symbols:
            self._insertions()
            self._row(symbol)

    def _offer(self, cost: list, node: list, state: int, price: int, before: int, letter: str) -> None:
        if cost[state] is None or price < cost[state]:
            cost[state], node[state] = price, self.trail.add(before, letter)
        elif price == cost[state]:
            other = self.trail.add(before, letter)
            if self.trail.less(other, node[state]):
                node[state] = other

    def _insertions(self) -> None:
        """Rows put in here: one from each state, two in a row up to an assistant's; more cost without use."""
        for state in (START, SYSTEM, ASSISTANT, USER):
            if self.cost[state] is not None:
                self._offer(self.cost, self.node, DUE[state][1], self.cost[state] + INSERT, self.node[state], "I")

    def _row(self, symbol: str) -> None:
        cost: list[int | None] = [None] * 4
        node: list[int | None] = [None] * 4
        stays = STAYS_TRUNCATED if symbol.isupper() else 0
        for state in STATES:
            price, before = self.cost[state], self.node[state]
            if price is None:
                continue
            self._offer(cost, node, state, price + DELETE, before, "D")
            if symbol == MUST_GO:
                continue
            kept = kept_state(state, symbol)
            if kept is not None:
                self._offer(cost, node, kept, price + stays, before, "K")
            if kept != DUE[state][1]:
                self._offer(cost, node, DUE[state][1], price + REROLE + stays, before, "R")
        self.cost, self.node = cost, node

    def best(self, to_go: tuple[int, ...] | None) -> tuple[int, int, str]:
        """(cost, end, string) of the cheapest repair; ``to_go`` are the costs of all that follows, None if nothing does."""
        if to_go is None:
            self._insertions()
            to_go = (0, None, None, 0)
        found = None
        for state in STATES:
            if self.cost[state] is None or to_go[state] is None:
                continue
            price = self.cost[state] + to_go[state]
            if found is None or price < found[0] or (price == found[0] and self.trail.less(self.node[state], self.node[found[1]])):
                found = (price, state)
        price, state = found
        return price, state, self.trail.text(self.node[state])


@lru_cache(maxsize=20_000)
def repair(symbols: str) -> tuple[int, str]:
    """(cost, edits) of the repair of a whole conversation; short ones, which recur, are remembered."""
    price, _, text = Repairs(symbols, START).best(None)
    return price, text


def cost_matrix(symbols: str) -> list[int]:
    """The least cost from each state (rows) to each state, -1 where there is no way."""
    return [-1 if c is None else c for start in STATES for c in Repairs(symbols, start).cost]


def costs_to_go(matrix: list[int], after: tuple[int, ...]) -> tuple[int, ...]:
    """The least cost of a piece and all after it, from each state before the piece."""
    return tuple(min(matrix[4 * start + end] + after[end] for end in STATES if matrix[4 * start + end] >= 0) for start in STATES)


def apply(edits: str, start: int, roles: list[str], texts: list[str]) -> tuple[list[str], list[str], int]:
    """(roles, texts, state after) of what edits make of rows; inserted rows have empty texts."""
    new_roles, new_texts, state, at = [], [], start, 0
    for edit in edits:
        if edit == "K":
            role = roles[at]
            state = SYSTEM if role[:1] == "s" else DUE[state][1]
        elif edit != "D":
            role, state = DUE[state]
        if edit != "D":
            new_roles.append(role)
            new_texts.append("" if edit == "I" else texts[at])
        if edit != "I":
            at += 1
    return new_roles, new_texts, state
