"""A compressed FM-index over many short sequences, and matching statistics by backward search.

The sequences are joined with a separator, their suffixes sorted by prefix
doubling, and the Burrows-Wheeler transform kept as a wavelet matrix. Each
sequence has a weight, the number of its copies; the weight of an interval of
suffixes is the number of occurrences it stands for.
"""

from __future__ import annotations

import numpy as np

from cargolake.llm.wavelet import WaveletMatrix


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by the ``depth`` symbols from each on, at least."""
    n, width = len(text), 1
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    while width < depth:
        onward = np.zeros(n, np.int64)
        onward[: max(0, n - width)] = rank[width:] + 1
        key = rank * (n + 2) + onward
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        width *= 2
        if rank[order[-1]] == n - 1:
            break
    return order


class FMIndex:
    """Over ``sequences`` of whole numbers from 1 on; ``weights`` count the copies of each."""

    def __init__(self, sequences: list[np.ndarray], weights: np.ndarray, depth: int):
        lengths = np.array([len(s) for s in sequences], np.int64)
        text = np.zeros(int(lengths.sum()) + len(sequences), np.int64)
        owner = np.repeat(np.arange(len(sequences)), lengths + 1)
        inside = np.ones(len(text), bool)
        inside[np.cumsum(lengths + 1) - 1] = False
        text[inside] = np.concatenate(sequences)
        order = suffix_order(text, depth)
        self.n = len(text)
        self.transform = WaveletMatrix.of(text[order - 1].astype(np.uint32))
        symbols = np.arange(int(text.max()) + 1)
        first, _ = self.transform.rank(symbols, np.zeros(len(symbols), np.int64))
        starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(symbols)))[:-1]])
        self.shift = starts - first
        self.known = len(symbols)
        self.weight = np.concatenate([[0], np.cumsum(weights[owner[order]])])

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the patterns with one more symbol before them."""
        at = self.transform.descend(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        at = at + self.shift[np.concatenate([symbol, symbol])]
        return at[: len(symbol)], at[len(symbol) :]

    def repeats(self, queries: list[np.ndarray], need: np.ndarray, window: int) -> list[list[tuple[int, int]]]:
        """For each query the runs (first, last) of window starts whose window occurs ``need`` times or more.

        All queries move together. A query searches leftwards from an end as
        far as the pattern still occurs often enough, which is the matching
        statistic of that end; a long enough match reports its windows. The next
        end is the largest that can still bring a new window.
        """
        found: list[list[tuple[int, int]]] = [[] for _ in queries]
        lengths = np.array([len(q) for q in queries], np.int64)
        offset = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(queries) else np.empty(0, np.int64)
        words = np.concatenate(queries) if queries else np.empty(0, np.int64)
        who = np.flatnonzero(lengths >= window)
        end, at = lengths[who].copy(), lengths[who].copy()
        low, high = np.zeros(len(who), np.int64), np.full(len(who), self.n, np.int64)
        while len(who):
            symbol = words[offset[who] + at - 1]
            ok = symbol < self.known
            new_low, new_high = self.extend(np.where(ok, symbol, 0), low, high)
            ok &= self.weight[new_high] - self.weight[new_low] >= need[who]
            at = np.where(ok, at - 1, at)
            low, high = np.where(ok, new_low, low), np.where(ok, new_high, high)
            ended = ~ok | (at == 0)
            if not ended.any():
                continue
            long = ended & (end - at >= window)
            for q, a, e in zip(who[long], at[long], end[long]):
                found[q].append((int(a), int(e - window)))
            # windows that are left start before ``at`` and end before ``end``
            end = np.where(ended, np.minimum(end - 1, at + window - 1), end)
            at = np.where(ended, end, at)
            low, high = np.where(ended, 0, low), np.where(ended, self.n, high)
            live = end >= window
            if not live.all():
                who, end, at, low, high = who[live], end[live], at[live], low[live], high[live]
        return found
