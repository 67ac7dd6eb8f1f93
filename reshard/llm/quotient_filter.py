"""Counting quotient filters of packed word-id n-grams, as sorted arrays and as bytes.

An n-gram of word ids is one number of (words x bits) bits. An invertible mixing spreads these numbers evenly; the high bits
of the result are the quotient, which is stored by its place only, and all the rest is stored as remainder. So a filter
counts without loss, takes little more than the remainders and the counters, and keeps its entries in order: filters of
the same n-grams are merged like sorted lists.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

from reshard.llm.common import mixed

HEADER = struct.Struct("<QBQ")
# Word ids of more bits do not fit: five of them must have at most 126.
MOST_BITS = 25
# Seeds of the steps of the mixing, in turn for the left and the right half.
STEPS = (11, 12, 13, 14)


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


@dataclass(frozen=True)
class Shape:
    """How n-grams of ``words`` ids with ``bits`` each are packed into a left and a right half of up to 63 bits."""

    words: int
    bits: int

    def __post_init__(self) -> None:
        if self.bits > MOST_BITS:
            raise ValueError(f"more than {MOST_BITS} bits per word")

    @property
    def left(self) -> int:
        return (self.words * self.bits + 1) // 2

    @property
    def right(self) -> int:
        return self.words * self.bits // 2

    def packed(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both halves of the n-grams that begin at ``starts``."""
        high, low = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
        for i in range(self.words):
            word, at = ids[starts + i].astype(np.uint64), (self.words - 1 - i) * self.bits
            if at < self.right:
                low |= word << np.uint64(at) & _mask(self.right)
                if at + self.bits > self.right:
                    high |= word >> np.uint64(self.right - at)
            else:
                high |= word << np.uint64(at - self.right)
        return self._turned(high, low, STEPS)

    def words_of(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Word ids of packed n-grams, one row each."""
        high, low = self._turned(high, low, STEPS[::-1])
        out = np.zeros((len(high), self.words), np.int32)
        for i in range(self.words):
            at = (self.words - 1 - i) * self.bits
            if at >= self.right:
                word = high >> np.uint64(at - self.right)
            else:
                word = low >> np.uint64(at)
                if at + self.bits > self.right:
                    word = word | high << np.uint64(self.right - at)
            out[:, i] = word & _mask(self.bits)
        return out

    def _turned(self, high: np.ndarray, low: np.ndarray, steps: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
        """Change each half by a hash of the other one, in turn; the same steps backwards undo it."""
        for seed in steps:
            if seed % 2:
                high = high ^ mixed(low, seed) & _mask(self.left)
            else:
                low = low ^ mixed(high, seed) & _mask(self.right)
        return high, low


def summed(high: np.ndarray, low: np.ndarray, counts: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries in order, with the counts of equal ones added up."""
    if shape.left + shape.right <= 64:
        both = high << np.uint64(shape.right) | low
        order = np.argsort(both, kind="stable")
    else:
        order = np.lexsort((low, high))
    high, low, counts = high[order], low[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])))) if len(high) else order
    return high[first], low[first], np.add.reduceat(counts, first) if len(first) else counts


def counted(high: np.ndarray, low: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries in order, with how often each occurs."""
    if shape.left + shape.right > 64:
        return summed(high, low, np.ones(len(high), np.int64), shape)
    both = np.sort(high << np.uint64(shape.right) | low)
    first = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1]))) if len(both) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(both)))
    return both[first] >> np.uint64(shape.right), both[first] & _mask(shape.right), counts


def _short(values: np.ndarray, bits: int) -> bytes:
    """The low bytes of the values, as many as the bits need."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : -(-bits // 8)].tobytes()


def _long(data: memoryview, count: int, bits: int) -> np.ndarray:
    size = -(-bits // 8)
    wide = np.zeros((count, 8), np.uint8)
    wide[:, :size] = np.frombuffer(data, np.uint8).reshape(count, size)
    return wide.view("<u8").reshape(-1)


def to_bytes(high: np.ndarray, low: np.ndarray, counts: np.ndarray, shape: Shape, known: int) -> bytes:
    """A filter of ordered entries that all agree in the ``known`` highest bits.

    For each quotient, in order, there is a 1 for each of its entries and then a 0. Remainders follow in the same order, then
    counters of one byte; those of 255 and more stand behind them in eight bytes.
    """
    rest = shape.left - known
    quotient_bits = min(rest, max(1, len(high).bit_length()))
    inside = high & _mask(rest)
    quotients = (inside >> np.uint64(rest - quotient_bits)).astype(np.int64)
    runs = np.zeros(len(high) + (1 << quotient_bits), np.uint8)
    runs[quotients + np.arange(len(high))] = 1
    large = counts >= 255
    return b"".join((
        HEADER.pack(len(high), quotient_bits, int(large.sum())), np.packbits(runs).tobytes(),
        _short(inside & _mask(rest - quotient_bits), rest - quotient_bits), _short(low, shape.right),
        np.minimum(counts, 255).astype(np.uint8).tobytes(), counts[large].astype("<i8").tobytes(),
    ))


def from_bytes(data: bytes, shape: Shape, known: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ordered entries of a filter whose highest ``known`` bits are ``prefix``."""
    count, quotient_bits, n_large = HEADER.unpack_from(data)
    rest, at, view = shape.left - known, HEADER.size, memoryview(data)

    def take(size: int) -> memoryview:
        nonlocal at
        at += size
        return view[at - size : at]

    slots = count + (1 << quotient_bits)
    runs = np.unpackbits(np.frombuffer(take(-(-slots // 8)), np.uint8), count=slots)
    quotients = (np.flatnonzero(runs) - np.arange(count)).astype(np.uint64)
    left_bits = rest - quotient_bits
    remainders = _long(take(count * -(-left_bits // 8)), count, left_bits) if left_bits else np.zeros(count, np.uint64)
    low = _long(take(count * -(-shape.right // 8)), count, shape.right)
    counts = np.frombuffer(take(count), np.uint8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(take(8 * n_large), "<i8")
    high = np.uint64(prefix) << np.uint64(rest) | quotients << np.uint64(left_bits) | remainders
    return high, low, counts


def merged(filters: list[bytes], shape: Shape, known: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries of several filters with the same highest bits, in order, with their counts added up."""
    parts = [from_bytes(data, shape, known, prefix) for data in filters]
    return summed(*(np.concatenate(side) for side in zip(*parts)), shape)
