"""A compressed FM-index over word numbers: wavelet tree, backward search and
matching statistics for many patterns at once (NumPy, used inside tasks)."""

from __future__ import annotations

import numpy as np


class BitVector:
    """Packed bits with a running count per 64-bit word: rank in constant time."""

    def __init__(self, bits: np.ndarray):
        words = -(-(len(bits) + 1) // 64)
        padded = np.zeros(words * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words)
        self.before = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)[:-1]])

    def rank1(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first ``i`` bits."""
        w = i >> 6
        low = self.words[w] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[w] + np.bitwise_count(low)


class WaveletTree:
    """Sequence over 0..size-1, one bit vector per bit of a symbol, highest first."""

    def __init__(self, seq: np.ndarray, size: int):
        self.levels: list[tuple[int, BitVector, int]] = []
        for shift in range(max(1, int(size - 1).bit_length()) - 1, -1, -1):
            bits = ((seq >> shift) & 1).astype(np.uint8)
            zeros = int(len(bits) - bits.sum())
            self.levels.append((shift, BitVector(bits), zeros))
            seq = np.concatenate([seq[bits == 0], seq[bits == 1]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands among the first ``i`` places."""
        lo = np.zeros_like(i)
        for shift, bits, zeros in self.levels:
            one = ((symbol >> shift) & 1).astype(bool)
            l1, i1 = bits.rank1(lo), bits.rank1(i)
            lo = np.where(one, zeros + l1, lo - l1)
            i = np.where(one, zeros + i1, i - i1)
        return i - lo


def sorted_suffixes(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by their first ``depth`` symbols at least, and for each
    start the rank of its first ``depth`` symbols (equal ones share a rank)."""
    n = len(text)
    rank, width, ranks = text.astype(np.int64), 1, {}
    ranks[1] = rank
    while width < depth:
        nxt = np.full(n, -1, np.int64)
        nxt[:n - width] = rank[width:]
        rank = _dense(rank * (n + int(text.max()) + 2) + nxt + 1)
        width *= 2
        ranks[width] = rank
    order = np.argsort(rank, kind="stable")
    half = max(w for w in ranks if w <= depth)
    if half == depth:
        return order, ranks[half]
    second = np.full(n, -1, np.int64)
    second[:n - (depth - half)] = ranks[half][depth - half:]
    return order, _dense(ranks[half] * (n + int(text.max()) + 2) + second + 1)


def _dense(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    number = np.cumsum(np.concatenate([[0], s[1:] != s[:-1]]))
    out = np.empty(len(keys), np.int64)
    out[order] = number
    return out


class FMIndex:
    """Index of passages (sequences of word numbers >= 1), joined by 0.

    ``owner`` gives each passage's number; backward search reports, for every
    place of a pattern, the smallest owner among all places where the next
    ``depth`` words occur.
    """

    def __init__(self, passages: list[np.ndarray], owner: np.ndarray, depth: int):
        self.depth = depth
        sizes = np.fromiter(map(len, passages), np.int64, len(passages)) + 1
        text = np.zeros(int(sizes.sum()), np.int64)
        ends = np.cumsum(sizes)
        for p, e, s in zip(passages, ends.tolist(), sizes.tolist()):
            text[e - s:e - 1] = p
        order, groups = sorted_suffixes(text, depth)
        self.size = int(text.max()) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.size))])
        self.tree = WaveletTree(text[order - 1], self.size)
        # Rows whose first ``depth`` symbols agree stand together.
        g = groups[order]
        edge = np.concatenate([[True], g[1:] != g[:-1]])
        starts = np.flatnonzero(edge)
        of_row = np.cumsum(edge) - 1
        self.low = starts[of_row]
        self.high = np.append(starts[1:], len(text))[of_row]
        owners = np.repeat(owner, sizes)[order]
        self.least = np.minimum.reduceat(owners, starts)[of_row]

    def matches(self, patterns: list[np.ndarray]) -> list[np.ndarray]:
        """For each pattern and each start with ``depth`` words left, the
        smallest owner of those words (patterns are passages of the index, so
        the search never fails)."""
        sizes = np.fromiter(map(len, patterns), np.int64, len(patterns))
        order = np.argsort(-sizes, kind="stable")
        longest = int(sizes.max())
        grid = np.zeros((longest, len(patterns)), np.int64)   # row k: k-th word from the end
        for column, p in enumerate(order):
            grid[:sizes[p], column] = patterns[p][::-1]
        sorted_sizes = sizes[order]
        lo = np.zeros(len(patterns), np.int64)
        hi = np.full(len(patterns), int(self.first[-1]), np.int64)
        found = np.full((longest, len(patterns)), -1, np.int64)
        for k in range(longest):
            live = int(np.searchsorted(-sorted_sizes, -k, side="left"))
            word = grid[k, :live]
            # One pass over the tree for both ends of the intervals.
            both = self.tree.rank(np.concatenate([word, word]),
                                  np.concatenate([lo[:live], hi[:live]]))
            lo[:live] = self.first[word] + both[:live]
            hi[:live] = self.first[word] + both[live:]
            if k + 1 >= self.depth:
                at = lo[:live]
                found[k, :live] = self.least[at]
                # Drop the words beyond ``depth``: widen to the rows that share them.
                lo[:live], hi[:live] = self.low[at], self.high[at]
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(patterns)
        for column, p in enumerate(order):
            out[p] = found[self.depth - 1:sizes[p], column][::-1]
        return out
