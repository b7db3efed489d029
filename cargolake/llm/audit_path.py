"""Cheapest edit sequences by a dynamic program over shared prefixes.

A program keeps, for every state, its cheapest sequence of symbols so far, and
of equally cheap ones the least. Sequences are not copied: each is a node that
points to its prefix, so the states of all steps share their beginnings. A node
has its depth, a rolling hash of the whole sequence, and ancestors at distances
1, 2, 4 and so on. Two sequences are compared at their longest common prefix,
which is searched by jumping over ancestors while their hashes differ; the
prefix is then verified symbol by symbol up to the node both share, and a
collision of hashes falls back to that comparison.

Symbols are small whole numbers: letters of edits, or the ranks of the edits of
parts, so that the parts of a long conversation are joined by the same program.
"""

from __future__ import annotations

MODULUS = (1 << 61) - 1
BASE = 0x1F3D5B79A8C64E2


class Paths:
    """Sequences that share their prefixes. Node 0 is the empty sequence."""

    def __init__(self, modulus: int = MODULUS) -> None:
        self.modulus = modulus
        self.depth, self.hash, self.symbol = [0], [0], [-1]
        self.up: list[tuple[int, ...]] = [()]  # ancestors at 1, 2, 4, ... while there are any

    def extended(self, node: int, *symbols: int) -> int:
        """The sequence of ``node`` and the symbols after it."""
        for symbol in symbols:
            above, step = [node], 0
            while step < len(self.up[above[-1]]):
                above.append(self.up[above[-1]][step])
                step += 1
            self.depth.append(self.depth[node] + 1)
            self.hash.append((self.hash[node] * BASE + symbol + 1) % self.modulus)
            self.symbol.append(symbol)
            self.up.append(tuple(above))
            node = len(self.depth) - 1
        return node

    def lifted(self, node: int, depth: int) -> int:
        """The prefix of ``node`` that has ``depth`` symbols."""
        rest = self.depth[node] - depth
        while rest:
            step = rest.bit_length() - 1
            node = self.up[node][step]
            rest -= 1 << step
        return node

    def symbols(self, node: int) -> list[int]:
        out = []
        while node:
            out.append(self.symbol[node])
            node = self.up[node][0]
        return out[::-1]

    def _same(self, a: int, b: int) -> bool:
        """Whether sequences of equal depth are equal, symbol by symbol up to a node they share."""
        while a != b:
            if self.symbol[a] != self.symbol[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def _plainly(self, a: int, b: int) -> int:
        """The comparison of sequences of equal depth without hashes."""
        found = 0
        while a != b:
            found = self.symbol[a] - self.symbol[b] or found
            a, b = self.up[a][0], self.up[b][0]
        return found

    def compared(self, a: int, b: int) -> int:
        """Negative, zero or positive as sequence ``a`` is less than, equal to or greater than ``b``; a prefix is less."""
        if a == b:
            return 0
        least = min(self.depth[a], self.depth[b])
        x, y = self.lifted(a, least), self.lifted(b, least)
        if self.hash[x] == self.hash[y]:
            return self._plainly(x, y) or self.depth[a] - self.depth[b]
        low, high = x, y
        for step in range(len(self.up[x]) - 1, -1, -1):
            if step < len(self.up[low]) and self.hash[self.up[low][step]] != self.hash[self.up[high][step]]:
                low, high = self.up[low][step], self.up[high][step]
        if self.symbol[low] != self.symbol[high] and self._same(self.up[low][0], self.up[high][0]):
            return self.symbol[low] - self.symbol[high]
        return self._plainly(x, y)


class Best:
    """For every state its least cost and, of the sequences with that cost, the least."""

    def __init__(self, paths: Paths) -> None:
        self.paths = paths
        self.at: dict[int, tuple[int, int]] = {}

    def offer(self, state: int, cost: int, prefix: int, *symbols: int) -> None:
        known = self.at.get(state)
        if known is not None and cost > known[0]:
            return
        node = self.paths.extended(prefix, *symbols)
        if known is None or cost < known[0] or self.paths.compared(node, known[1]) < 0:
            self.at[state] = (cost, node)


def ranked(paths: Paths, nodes: list[int]) -> list[int]:
    """The rank of each sequence among those of the list; equal sequences have equal ranks."""
    order: list[int] = []
    for i, node in enumerate(nodes):  # at most sixteen
        place = 0
        while place < len(order) and paths.compared(nodes[order[place]], node) < 0:
            place += 1
        order.insert(place, i)
    ranks, rank = [0] * len(nodes), -1
    for n, i in enumerate(order):
        if n == 0 or paths.compared(nodes[order[n - 1]], nodes[i]) != 0:
            rank += 1
        ranks[i] = rank
    return ranks
