"""A bidirectional FM-index over a delimited vocabulary and the search scheme for one
error (NumPy, used inside tasks).

Two Burrows-Wheeler transforms, of the words and of the reversed words, are searched in
step: adding a symbol on one side takes rank counts from one transform and moves the
interval of the other by the number of smaller symbols.  Words stand in sorted order
between delimiters, so the row of a match that holds both delimiters is the word's number.
"""

from __future__ import annotations

import numpy as np

BLOCK = 32          # rows between stored counts
FEW = 64            # rows of an interval that are read one by one


def transform(words: list[np.ndarray]) -> np.ndarray:
    """The transform of ``$w1$w2$...$`` for sorted distinct words over 1..a; equal
    delimiters rank by position.  The symbol before the first delimiter is -1."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    text = np.zeros(int(sizes.sum()) + len(words) + 1, np.int64)
    ends = np.cumsum(sizes + 1)
    inside = np.ones(len(text), bool)
    inside[0] = False
    inside[ends] = False
    text[inside] = np.concatenate(words)
    n = len(text)
    rank = text + len(words)
    rank[~inside] = np.arange(len(words) + 1)
    width, distinct = 1, False
    while not distinct:
        following = np.zeros(n, np.int64)
        following[:n - width] = rank[width:] + 1
        key = rank * (int(rank.max()) + 2) + following
        order = np.argsort(key, kind="stable")
        step = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank = np.empty(n, np.int64)
        rank[order] = step
        width *= 2
        distinct = int(step[-1]) == n - 1
    out = text[order - 1]
    out[order == 0] = -1
    return out


class Transform:
    """Rank counts over one transform: ``symbols`` 0..a; a + 1 stands before the
    text, a + 2 occurs nowhere."""

    def __init__(self, bwt: np.ndarray, letters: int):
        self.n, self.kinds = len(bwt), letters + 3
        bwt = np.where(bwt < 0, letters + 1, bwt)
        counts = np.bincount(bwt, minlength=self.kinds)
        counts[0] += 1                       # the last delimiter stands before nothing
        counts[letters + 1] = 0
        self.first = np.cumsum(counts) - counts
        self.total = counts
        blocks = -(-(self.n + 1) // BLOCK)
        padded = np.full(blocks * BLOCK, self.kinds, np.int64)
        padded[:self.n] = bwt
        self.rows = padded.reshape(blocks, BLOCK).astype(np.min_scalar_type(self.kinds))
        at = np.repeat(np.arange(blocks), BLOCK)
        seen = np.bincount(at * (self.kinds + 1) + padded, minlength=blocks * (self.kinds + 1)) \
            .reshape(blocks, self.kinds + 1)
        below = np.zeros((blocks, self.kinds + 1), np.int64)
        below[:, 1:] = np.cumsum(seen[:, :-1], axis=1)
        self.below = np.zeros((blocks, self.kinds + 1), np.int32)   # smaller symbols in earlier blocks
        self.below[1:] = np.cumsum(below[:-1], axis=0)

    def counts(self, place: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(equal, smaller) symbols among the first ``place`` rows."""
        block, rest = place // BLOCK, place % BLOCK
        smaller = self.below[block, symbol].astype(np.int64)
        equal = self.below[block, symbol + 1] - smaller
        rows = self.rows[block]
        live = np.arange(BLOCK) < rest[:, None]
        wanted = symbol[:, None]
        return (equal + ((rows == wanted) & live).sum(1), smaller + ((rows < wanted) & live).sum(1))

    def symbols(self, low: np.ndarray, size: np.ndarray, letters: int) -> tuple[np.ndarray, np.ndarray]:
        """(interval, letter): the distinct letters within each interval."""
        few = np.flatnonzero(size <= FEW)
        n = size[few]
        place = np.repeat(low[few] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        found = np.unique(np.repeat(few, n) * self.kinds + self.rows.ravel()[place])
        many = np.flatnonzero(size > FEW)
        if len(many):
            every = np.tile(np.arange(1, letters + 1), len(many))
            owner = np.repeat(many, letters)
            a, _ = self.counts(low[owner], every)
            b, _ = self.counts((low + size)[owner], every)
            found = np.concatenate([found, (owner * self.kinds + every)[b > a]])
        owner, symbol = found // self.kinds, found % self.kinds
        letter = (symbol >= 1) & (symbol <= letters)
        return owner[letter], symbol[letter]


class States:
    """Intervals of patterns in both transforms, each owned by a query."""

    def __init__(self, query, near, far, size):
        self.query, self.near, self.far, self.size = query, near, far, size

    def pick(self, rows) -> "States":
        return States(self.query[rows], self.near[rows], self.far[rows], self.size[rows])

    def plus(self, other: "States") -> "States":
        return States(*(np.concatenate(p) for p in zip(
            (self.query, self.near, self.far, self.size),
            (other.query, other.near, other.far, other.size))))

    def grow(self, on: Transform, symbol: np.ndarray, left: bool) -> "States":
        """Add ``symbol`` on the side that ``on`` reads; empty intervals go."""
        low = self.near if left else self.far
        equal, smaller = on.counts(low, symbol)
        equal2, smaller2 = on.counts(low + self.size, symbol)
        own, other = on.first[symbol] + equal, (self.far if left else self.near) + smaller2 - smaller
        keep = equal2 > equal
        out = States(self.query, *((own, other) if left else (other, own)), equal2 - equal)
        return out.pick(keep)


class VariantIndex:
    """Words (sorted, distinct) searched with exactly one inserted, deleted or
    replaced code point, all within the first or all within the second half."""

    def __init__(self, words: list[str]):
        self.words = words
        joined = "".join(words)
        points = np.unique(np.frombuffer(joined.encode("utf-32-le"), "<u4")) if joined else np.zeros(0, "<u4")
        self.points, self.letters = points, len(points)
        ahead = [self._symbols(w) for w in words]
        order = sorted(range(len(words)), key=lambda i: words[i][::-1])
        self.ahead = Transform(transform(ahead), self.letters)
        self.back = Transform(transform([ahead[i][::-1] for i in order]), self.letters)
        self.of_back = np.array(order, np.int64)

    def _symbols(self, word: str) -> np.ndarray:
        raw = np.frombuffer(word.encode("utf-32-le"), "<u4")
        at = np.searchsorted(self.points, raw)
        known = self.points[np.minimum(at, self.letters - 1)] == raw
        return np.where(known, at + 1, self.letters + 2).astype(np.int64)

    def search(self, queries: list[str], second_half: bool, step: int = 4096):
        """(query number, word number): words at one error from a query, the error
        in its second half (the first then matches exactly), or in its first."""
        by_size: dict[int, list[int]] = {}
        for i, q in enumerate(queries):
            if len(q) > 1:
                by_size.setdefault(len(q), []).append(i)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for size, at in sorted(by_size.items()):
            for i in range(0, len(at), step):
                chunk = at[i:i + step]
                grid = np.stack([self._symbols(queries[j]) for j in chunk])
                exact = size // 2
                if second_half:
                    q, w = self._scheme(self.ahead, self.back, grid, exact)
                else:
                    q, w = self._scheme(self.back, self.ahead, grid[:, ::-1], size - exact)
                    w = self.of_back[w]
                found.append((np.array(chunk, np.int64)[q], w))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(c) for c in zip(*found))

    def _scheme(self, near: Transform, far: Transform, grid: np.ndarray, exact: int):
        """The first ``exact`` symbols are matched from their inner end outwards to
        the delimiter, then the rest from there on with one error."""
        m, delimiter = len(grid), np.zeros
        symbol = grid[:, exact - 1]
        state = States(np.arange(m), near.first[symbol], far.first[symbol], near.total[symbol])
        state = state.pick(state.size > 0)
        for k in range(exact - 2, -1, -1):
            state = state.grow(near, grid[state.query, k], True)
        state = state.grow(near, delimiter(len(state.query), np.int64), True)
        rest = grid[:, exact:]
        t = rest.shape[1]
        wrong = state.pick(slice(0, 0))                      # states that hold their error
        for p in range(t + 1):
            owner, letter = far.symbols(state.far, state.size, self.letters)
            if p < t:
                other = letter != rest[state.query[owner], p]
                owner, letter = owner[other], letter[other]
            changed = state.pick(owner).grow(far, letter, False)
            wrong = wrong.plus(changed)                      # a letter too many
            if p < t:
                wrong = wrong.grow(far, rest[wrong.query, p], False)
                lost = state                                 # a letter too few
                if p + 1 < t:
                    lost = state.pick(rest[state.query, p] != rest[state.query, p + 1])
                wrong = wrong.plus(changed).plus(lost)       # another letter
                state = state.grow(far, rest[state.query, p], False)
        wrong = wrong.grow(far, delimiter(len(wrong.query), np.int64), False)
        pair = np.unique(wrong.query * np.int64(near.n) + wrong.near)
        return pair // near.n, pair % near.n
