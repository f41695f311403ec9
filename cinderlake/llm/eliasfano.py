"""Monotone sequences in Elias-Fano form and an n-gram trie of them, on memory-mapped arrays."""

from __future__ import annotations

import mmap
import tempfile

import numpy as np

# The place of the r-th set bit of a byte.
_PLACE = np.array(
    [[[i for i in range(8) if b >> i & 1][r] if r < b.bit_count() else 0 for r in range(8)]
     for b in range(256)],
    np.int64,
)


class Mapped:
    """Arrays written one after the other to a nameless file and mapped from it.

    The file has no name from the start, so nothing is left when the task ends or dies.
    """

    def __init__(self) -> None:
        self._file = tempfile.TemporaryFile()
        self._parts: list[tuple[int, np.dtype, int]] = []
        self._at = 0

    def add(self, array: np.ndarray) -> int:
        data = np.ascontiguousarray(array)
        self._file.write(data.tobytes())
        self._parts.append((self._at, data.dtype, len(data)))
        padding = -data.nbytes % 8
        self._file.write(bytes(padding))
        self._at += data.nbytes + padding
        return len(self._parts) - 1

    def open(self) -> list[np.ndarray]:
        self._file.flush()
        if not self._at:
            return [np.zeros(0, d) for _, d, _ in self._parts]
        view = mmap.mmap(self._file.fileno(), self._at, access=mmap.ACCESS_READ)
        self._file.close()
        return [np.frombuffer(view, d, n, at) for at, d, n in self._parts]


class EliasFano:
    """A non-decreasing sequence: low bits side by side, high bits in unary with popcounts."""

    def __init__(self, low: np.ndarray, high: np.ndarray, ones: np.ndarray, width: int):
        self._low, self._high, self._ones, self._width = low, high, ones, width

    @staticmethod
    def parts(values: np.ndarray, universe: int) -> tuple[list[np.ndarray], int]:
        """The three arrays and the number of low bits, for values below ``universe``."""
        values = np.asarray(values, np.uint64)
        n = max(1, len(values))
        width = min(48, max(0, (universe // n).bit_length() - 1))
        places, pieces = np.arange(width, dtype=np.uint64), []
        for at in range(0, len(values), 1 << 16):  # whole bytes whatever the width
            bits = (values[at : at + (1 << 16), None] >> places) & np.uint64(1)
            pieces.append(np.packbits(bits.astype(np.uint8).ravel(), bitorder="little"))
        low = np.concatenate([*pieces, np.zeros(8, np.uint8)])
        place = (values >> np.uint64(width)).astype(np.int64) + np.arange(len(values))
        size = -(-(int(place[-1]) + 1 if len(place) else 1) // 64) * 64
        flags = np.zeros(size, np.uint8)
        flags[place] = 1
        high = np.packbits(flags, bitorder="little")
        counts = np.bitwise_count(high.view(np.uint64)).astype(np.int64)
        return [low, high, np.concatenate([[0], np.cumsum(counts)])], width

    def __getitem__(self, index: np.ndarray) -> np.ndarray:
        """The values at many places."""
        word = np.searchsorted(self._ones, index, "right") - 1
        rest = index - self._ones[word]
        place = word * 8
        left = np.ones(len(index), bool)
        for _ in range(7):  # go on to the byte that holds the wanted bit
            here = np.bitwise_count(self._high[place]).astype(np.int64)
            left &= rest >= here
            rest = np.where(left, rest - here, rest)
            place = place + left
        high = place * 8 + _PLACE[self._high[place], rest] - index
        if not self._width:
            return high
        bit = index * self._width
        windows = np.ndarray((len(self._low) - 7,), "<u8", self._low, 0, (1,))
        low = (windows[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self._width) - 1)
        return (high << self._width) | low.astype(np.int64)


class NgramTrie:
    """N-grams of word ranks as levels of successors, with a code for each whole n-gram.

    Level k holds, for each path of k words in order, the rank of its last word relative to its
    context: place of the context times number of words plus rank, which never falls and so
    is kept in Elias-Fano form, as are the pointers from a context to its first successor.
    """

    def __init__(self, grams: np.ndarray, codes: np.ndarray, words: int):
        """``grams`` [n, order]: distinct, in lexicographic order; a code for each."""
        mapped, widths = Mapped(), []
        self._words, self.order = max(1, words), grams.shape[1]
        context = np.zeros(len(grams), np.int64)
        count = 1
        for k in range(self.order):
            value = context * self._words + grams[:, k]
            first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))[: len(value)]
            level = value[first]
            parts, width = EliasFano.parts(level, count * self._words)
            pointers = np.searchsorted(level, np.arange(count + 1) * self._words)
            more, pointer_width = EliasFano.parts(pointers, len(level) + 1)
            for array in (*parts, *more):
                mapped.add(array)
            widths += [width, pointer_width]
            context = np.searchsorted(level, value)
            count = len(level)
        mapped.add(codes)
        arrays = mapped.open()
        self._sequences = [
            EliasFano(*arrays[3 * i : 3 * i + 3], w) for i, w in enumerate(widths)
        ]
        self._codes = arrays[-1]
        self._empty = not len(grams)

    def find(self, grams: np.ndarray) -> np.ndarray:
        """The place of each n-gram among those stored, -1 if it is not there."""
        place = np.zeros(len(grams), np.int64)
        if self._empty or not len(grams):
            return place - 1
        there = np.ones(len(grams), bool)
        for k in range(self.order):
            level, pointers = self._sequences[2 * k : 2 * k + 2]
            wanted = place * self._words + grams[:, k]
            # The smallest successor that is not below the wanted one, within its context.
            low, high = pointers[place].copy(), pointers[place + 1].copy()
            end = high.copy()
            going = np.flatnonzero(low < high)
            while len(going):
                middle = (low[going] + high[going]) // 2
                below = level[middle] < wanted[going]
                low[going[below]] = middle[below] + 1
                high[going[~below]] = middle[~below]
                going = going[low[going] < high[going]]
            found = low < end
            found &= level[np.where(found, low, 0)] == wanted
            there &= found
            place = np.where(there, low, 0)
        return np.where(there, place, -1)

    def codes(self, place: np.ndarray) -> np.ndarray:
        return self._codes[place]
