"""Elias-Fano sequences and a two-level n-gram trie on top of them, in numpy.

A sequence of n non-decreasing numbers below U is stored as the low bits of
each, packed, and a bitmap of the high parts in unary: about
``2 + log2(U / n)`` bits a number, with random access and successor search.
All arrays are views of one byte image, so an image can be read from a file
with ``numpy.memmap`` or from a column of bytes without being copied.
"""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


def _bits(values: np.ndarray, width: int) -> np.ndarray:
    """The lowest ``width`` bits of each value, one after another, as bytes."""
    out = []
    for part in range(0, len(values), 65_536):
        some = values[part : part + 65_536].astype(np.uint64)
        bits = (some[:, None] >> np.arange(width, dtype=np.uint64)) & _ONE
        out.append(np.packbits(bits.astype(np.uint8).ravel(), bitorder="little"))
    return np.concatenate(out) if out else np.zeros(0, np.uint8)


class EliasFano:
    """A non-decreasing sequence. Make one with ``build``, or ``view`` its image."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray):
        self.n, self.width, self.low, self.high = n, width, low, high
        ones = np.bitwise_count(high).astype(np.int64)
        self.ones = np.concatenate([[0], np.cumsum(ones)])  # set bits before each word
        self.zeros = np.arange(len(self.ones)) * 64 - self.ones

    @staticmethod
    def image(values: np.ndarray, universe_bits: int) -> bytes:
        """Bytes of the sequence; each of ``values`` is below ``2 ** universe_bits``."""
        n = len(values)
        width = max(0, universe_bits - max(n, 1).bit_length())
        values = values.astype(np.uint64)
        high = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        words = (int(high[-1]) if n else 0) // 64 + 2
        bitmap = np.zeros(words * 64, dtype=np.uint8)
        bitmap[high] = 1
        # A block of 65,536 values ends on a byte, as 65,536 is a multiple of 8.
        low = _bits(values, width) if width else np.zeros(0, np.uint8)
        low = np.concatenate([low, np.zeros(16 - len(low) % 8, np.uint8)])
        head = np.array([n, width, len(low), words * 8], dtype=np.int64)
        return head.tobytes() + low.tobytes() + np.packbits(bitmap, bitorder="little").tobytes()

    @staticmethod
    def view(image: np.ndarray, at: int) -> tuple["EliasFano", int]:
        """The sequence whose image starts at byte ``at``, and where the image ends."""
        n, width, low, high = (int(v) for v in image[at : at + 32].view(np.int64))
        at += 32
        bits = image[at + low : at + low + high].view(np.uint64)
        return EliasFano(n, width, image[at : at + low], bits), at + low + high

    def lows(self, places: np.ndarray) -> np.ndarray:
        """Low bits of the numbers at ``places``."""
        if not self.width:
            return np.zeros(len(places), np.uint64)
        first = places.astype(np.int64) * self.width
        byte = first >> 3
        # Up to nine bytes hold the bits: eight of them as one word, and one more.
        word = np.zeros(len(places), np.uint64)
        for k in range(8):
            word |= self.low[byte + k].astype(np.uint64) << np.uint64(8 * k)
        shift = (first & 7).astype(np.uint64)
        word >>= shift
        more = self.low[byte + 8].astype(np.uint64)
        word |= np.where(shift > 0, more << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return word & np.uint64((1 << self.width) - 1)

    def _select(self, before: np.ndarray, ranks: np.ndarray, bit: int) -> np.ndarray:
        """Place in the bitmap of the bits ``bit`` of the given ranks."""
        word = np.searchsorted(before, ranks, side="right") - 1
        word = np.minimum(word, len(self.high) - 1)
        left = ranks - before[word]
        value = self.high[word] if bit else ~self.high[word]
        place = np.zeros(len(ranks), dtype=np.int64)
        for step in (32, 16, 8, 4, 2, 1):
            mask = np.uint64((1 << step) - 1)
            count = np.bitwise_count(value & mask).astype(np.int64)
            over = left >= count
            left = np.where(over, left - count, left)
            value = np.where(over, value >> np.uint64(step), value & mask)
            place += np.where(over, step, 0)
        return word * 64 + place

    def get(self, places: np.ndarray) -> np.ndarray:
        """The numbers at ``places``."""
        high = self._select(self.ones, places, 1) - places
        return (high.astype(np.uint64) << np.uint64(self.width)) | self.lows(places)

    def successor(self, values: np.ndarray, begin=None, end=None) -> np.ndarray:
        """Place of the first number not below each value, within ``begin`` to ``end``."""
        values = values.astype(np.uint64)
        high = (values >> np.uint64(self.width)).astype(np.int64)
        zeros = int(self.zeros[-1])
        # Numbers with the same high part stand between two zeros of the bitmap.
        start = lambda h: np.where(
            h <= 0, 0, self._select(self.zeros, np.clip(h - 1, 0, zeros - 1), 0) - np.maximum(h - 1, 0)
        )
        low_end = np.where(high > zeros, self.n, np.minimum(start(high), self.n))
        high_end = np.where(high + 1 > zeros, self.n, np.minimum(start(high + 1), self.n))
        if begin is not None:
            low_end, high_end = np.maximum(low_end, begin), np.minimum(high_end, end)
            high_end = np.maximum(high_end, low_end)
        wanted = values & np.uint64((1 << self.width) - 1)
        left, right = low_end.astype(np.int64), high_end.astype(np.int64)
        while (left < right).any():
            middle = (left + right) >> 1
            open_ = left < right
            below = np.zeros(len(left), dtype=bool)
            below[open_] = self.lows(middle[open_]) < wanted[open_]
            left = np.where(open_ & below, middle + 1, left)
            right = np.where(open_ & ~below, middle, right)
        return left

    def find(self, values: np.ndarray, begin=None, end=None) -> np.ndarray:
        """Place of each value, -1 where it is not in the sequence (or the range)."""
        if not self.n or not len(values):
            return np.full(len(values), -1, dtype=np.int64)
        place = self.successor(values, begin, end)
        limit = self.n if end is None else end
        inside = np.flatnonzero(place < limit)
        found = np.full(len(values), -1, dtype=np.int64)
        same = self.get(place[inside]) == values[inside].astype(np.uint64)
        found[inside[same]] = place[inside[same]]
        return found


#: Quantised probabilities: code c stands for 10 ** -(c * STEP), rounded down.
STEP = 7 / 254


class Trie:
    """Contexts, and behind each its successors with quantised probabilities.

    Level one holds the contexts' hashes. Monotone pointers lead from a
    context to its range of level two, where a successor is its number in the
    vocabulary plus the context's number times the vocabulary's size: numbers
    that rise through the whole level, yet are searched within one context.
    """

    def __init__(self, image: np.ndarray):
        at = 0
        self.contexts, at = EliasFano.view(image, at)
        self.vocabulary, at = EliasFano.view(image, at)
        self.pointers, at = EliasFano.view(image, at)
        self.successors, at = EliasFano.view(image, at)
        size = int(image[at : at + 8].view(np.int64)[0])
        self.codes = image[at + 8 : at + 8 + 2 * size].view(np.uint16)

    @staticmethod
    def image(context: np.ndarray, word: np.ndarray, share: np.ndarray) -> np.ndarray:
        """Image of the trie of distinct pairs and each pair's share of its context."""
        contexts, own = np.unique(context, return_inverse=True)
        vocabulary, number = np.unique(word, return_inverse=True)
        place = own.astype(np.int64) * len(vocabulary) + number
        order = np.argsort(place, kind="stable")
        ends = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=len(contexts)))])
        code = np.minimum(1023, 1 + np.ceil(-np.log10(share[order]) / STEP - 1e-9)).astype(np.uint16)
        bits = max(1, int(len(contexts) * max(1, len(vocabulary))).bit_length())
        pad = np.zeros(-2 * len(code) % 8, np.uint8)
        raw = b"".join(
            [
                EliasFano.image(contexts, 64),
                EliasFano.image(vocabulary, 64),
                EliasFano.image(ends, max(1, len(code).bit_length())),
                EliasFano.image(place[order], bits),
                np.array([len(code)], dtype=np.int64).tobytes(),
                code.tobytes(),
                pad.tobytes(),
            ]
        )
        return np.frombuffer(raw, dtype=np.uint8)

    def lookup(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Code of each pair, 0 where the pair is unknown."""
        codes = np.zeros(len(context), dtype=np.uint16)
        own, number = self.contexts.find(context), self.vocabulary.find(word)
        known = np.flatnonzero((own >= 0) & (number >= 0))
        own, number = own[known], number[known]
        begin = self.pointers.get(own).astype(np.int64)
        end = self.pointers.get(own + 1).astype(np.int64)
        place = self.successors.find(own * self.vocabulary.n + number, begin, end)
        hit = place >= 0
        codes[known[hit]] = self.codes[place[hit]]
        return codes


def code_shares() -> np.ndarray:
    """What each code stands for; code 0 is an unknown pair."""
    shares = 10.0 ** (-(np.arange(1024) - 1) * STEP)
    shares[0] = 0
    return shares
