"""A compressed full-text index of a sequence of small whole numbers, searched backwards.

The Burrows-Wheeler transform lies in a wavelet tree (its levels as bit vectors with counts of set
bits), so that a step of backward search is two ranks on every level. Beside it are the
lengths of the prefixes that neighbours in suffix order share, up to a limit, and the nearest
smaller ones, which lead from an interval to the one of a shorter match.
"""

from __future__ import annotations

import numpy as np


class BitVector:
    """Bits with the number of set bits before each word of 64."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        packed = np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, np.uint8)])
        self._words = packed.view(np.uint64)
        self._before = np.zeros(len(self._words) + 1, np.int32)
        np.cumsum(np.bitwise_count(self._words), out=self._before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self._before[word] + np.bitwise_count(self._words[word] & below)


class WaveletTree:
    """A sequence of numbers below 2^levels; every level is kept as one bit vector."""

    def __init__(self, values: np.ndarray, levels: int):
        self._levels: list[tuple[int, BitVector, int]] = []
        for shift in range(levels - 1, -1, -1):
            bits = (values >> shift) & 1
            self._levels.append((shift, BitVector(bits), int(len(bits) - bits.sum())))
            values = np.concatenate([values[bits == 0], values[bits == 1]])

    def ranks(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Where the symbol's places in [0, low) and [0, high) end on the last level."""
        for shift, bits, zeros in self._levels:
            one = ((symbol >> shift) & 1).astype(bool)
            a, b = bits.rank(low), bits.rank(high)
            low = np.where(one, zeros + a, low - a)
            high = np.where(one, zeros + b, high - b)
        return low, high


def _ranked(key: np.ndarray) -> np.ndarray:
    """The place of each number among the distinct ones."""
    order = np.argsort(key)
    ordered = key[order]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
    return rank


def suffix_order(values: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first ``limit`` values, and lengths of shared prefixes.

    ``limit`` is a power of two. The length at k is that of the suffixes k - 1 and k, at most
    ``limit``, and 0 at the first.
    """
    n = len(values)
    width = max(1, int(values.max(initial=0)).bit_length() + 1)
    together = 1
    while 2 * together * width <= 62 and together < limit:
        together *= 2
    # The first values of a suffix fit into one number; one that has ended comes first.
    key = np.zeros(n, np.int64)
    for k in range(together):
        key <<= width
        key[: max(0, n - k)] |= values[k:] + 1
    ranks, step = [_ranked(key)], together
    while step < limit:
        later = np.zeros(n, np.int64)
        later[: max(0, n - step)] = ranks[-1][step:] + 1
        ranks.append(_ranked(ranks[-1] * (n + 1) + later))
        step *= 2
    rank = ranks[-1]
    order = np.argsort(rank)
    shared = np.zeros(n, np.int32)
    a, b = order[:-1].copy(), order[1:].copy()
    lengths = [together << k for k in range(len(ranks))]
    for length, of in [*zip(lengths[::-1], ranks[::-1]), *[(1, values)] * (together - 1)]:
        inside = (a < n) & (b < n)
        equal = np.zeros(len(a), bool)
        equal[inside] = of[a[inside]] == of[b[inside]]
        shared[1:] += equal.astype(np.int32) * length
        a, b = a + equal * length, b + equal * length
    return order, np.minimum(shared, limit)


def nearest_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the nearest one before it with a smaller value; -1 without."""
    found = np.arange(len(values)) - 1
    going = np.flatnonzero(found >= 0)
    while len(going):
        at = found[going]
        going = going[values[at] >= values[going]]
        found[going] = found[found[going]]
        going = going[found[going] >= 0]
    return found


class FMIndex:
    """Backward search over pieces of text, each of numbers from 1 up, for matches up to ``most``."""

    def __init__(self, pieces: list[np.ndarray], most: int):
        self.most = most
        self.symbols = 1 + max((int(p.max()) for p in pieces if len(p)), default=0)
        # A piece ends in a number of its own, below all others, so that no match runs over an end.
        shift = max(0, len(pieces) - 1)
        parts = [v for k, p in enumerate(pieces) for v in (p + shift, [shift - k])]
        text = np.concatenate(parts).astype(np.int64) if parts else np.zeros(1, np.int64)
        self.size = len(text)
        # Steps back are right for matches up to the length that suffixes are ordered by.
        order, self._shared = suffix_order(text, 1 << max(0, (most - 1).bit_length()))
        before = text[order - 1] - shift
        before[before < 1] = 0  # all ends are one number that is never asked for
        self._tree = WaveletTree(before, max(1, (self.symbols - 1).bit_length()))
        numbers = np.arange(self.symbols)
        start = np.searchsorted(text[order], numbers + shift)
        none = np.zeros(self.symbols, np.int64)
        self._offset = start - self._tree.ranks(numbers, none, none)[0]
        self._left = nearest_smaller(self._shared)
        self._right = self.size - 1 - nearest_smaller(self._shared[::-1])[::-1]
        # Which piece a suffix starts in.
        lengths = [len(p) + 1 for p in pieces] or [1]
        self.piece = np.repeat(np.arange(len(lengths)), lengths)[order]
        self._one_less = self.classes(most - 1)

    def classes(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes with the same first ``length`` numbers: the class of each, where classes begin."""
        opens = self._shared < length
        opens[0] = True
        return np.cumsum(opens) - 1, np.append(np.flatnonzero(opens), self.size)

    def back(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray):
        """The intervals of the matches with ``symbol`` put before them; empty if there are none."""
        known = (symbol > 0) & (symbol < self.symbols)
        asked = np.where(known, symbol, 0)
        a, b = self._tree.ranks(asked, low, high)
        return self._offset[asked] + a, np.where(known, self._offset[asked] + b, -1)

    def shorter(self, low: np.ndarray, high: np.ndarray):
        """The next larger intervals, and the length of the matches they stand for."""
        n = self.size
        inside, last = high < n, np.minimum(high, n - 1)
        left, right = self._shared[low], np.where(inside, self._shared[last], 0)
        length = np.maximum(left, right)
        up_low = np.where(left == length, self._left[low], low)
        up_high = np.where(right == length, np.where(inside, self._right[last], n), high)
        return np.where(length == 0, 0, up_low), np.where(length == 0, n, up_high), length

    def matching_statistics(self, pieces: list[np.ndarray]) -> tuple[list, list]:
        """For each place of each piece: the longest match that starts there, up to ``most``, and
        where it stands in the order of suffixes.

        All pieces are walked from their ends at once. A walk takes a step back, or, where none
        is left, shortens its match at the far end.
        """
        lengths = np.array([len(p) for p in pieces], np.int64)
        starts = np.cumsum(lengths) - lengths
        text = np.concatenate([*pieces, np.zeros(0, np.int64)]).astype(np.int64)
        found, where = np.zeros(len(text), np.int64), np.zeros(len(text), np.int64)
        at = starts + lengths - 1
        low, high = np.zeros(len(pieces), np.int64), np.full(len(pieces), self.size, np.int64)
        length = np.zeros(len(pieces), np.int64)
        classes, opens = self._one_less
        walk = np.flatnonzero(lengths)
        while len(walk):
            full = walk[length[walk] == self.most]
            of = classes[low[full]]
            low[full], high[full], length[full] = opens[of], opens[of + 1], self.most - 1
            a, b = self.back(text[at[walk]], low[walk], high[walk])
            going = a < b
            on, stuck = walk[going], walk[~going]
            low[on], high[on] = a[going], b[going]
            length[on] += 1
            up = stuck[length[stuck] > 0]
            done = np.concatenate([on, stuck[length[stuck] == 0]])
            low[up], high[up], length[up] = self.shorter(low[up], high[up])
            found[at[done]], where[at[done]] = length[done], low[done]
            at[done] -= 1
            walk = walk[at[walk] >= starts[walk]]
        return np.split(found, starts[1:]), np.split(where, starts[1:])
