"""A read-only n-gram trie: monotone sequences in Elias-Fano code, probabilities as one byte each.

Level 0 holds the words that a shard's n-grams begin with, level k the last words of its n-grams of k + 1 words. Words are
numbers, ascending within their context. To make a level one ascending sequence, every word has the last value of the context
before it added. Pointers, a monotone sequence too, say where each context's words begin. A level also has a coded
probability and a coded weight for falling back for each of its n-grams. A trie is one blob, mapped into memory from a
file of its own, and look-ups read the code as it stands there.

An n-gram is looked for in its context only: the pointers give its range, the value before the range is taken as its
base, and the code's upper part leads to the few values in the range that share the upper bits looked for.
"""

from __future__ import annotations

import json
import tempfile
from dataclasses import dataclass

import numpy as np

# One-byte codes: 0 is nothing, 1 .. 255 run evenly in the logarithm from 1 down to 10 ** -DECADES.
DECADES = 9.0
PACKED_AT_ONCE = 1 << 15
ASKED_AT_ONCE = 1 << 18
LARGEST = (1 << 62) - 1

U = np.uint64
BYTES_1 = U(0x0101010101010101)
PAIRS, FOURS, EIGHTS = U(0x5555555555555555), U(0x3333333333333333), U(0x0F0F0F0F0F0F0F0F)
# Place of the (i + 1)-th one in a byte.
ONE_IN_BYTE = np.array([[([b for b in range(8) if byte >> b & 1] + [8] * 8)[i] for byte in range(256)] for i in range(8)], np.int64)


def quantised(p: np.ndarray) -> np.ndarray:
    code = 1 + np.rint(-np.log10(np.maximum(p, 1e-300)) * (254 / DECADES))
    return np.where(p > 0, np.minimum(code, 255), 0).astype(np.uint8)


PROBABILITY = np.concatenate([[0.0], 10.0 ** (-np.arange(255) * (DECADES / 254))])


def one_in_word(words: np.ndarray, i: np.ndarray) -> np.ndarray:
    """The place of the (i + 1)-th one in each 64-bit word, which must have as many."""
    sums = words - ((words >> U(1)) & PAIRS)
    sums = (sums & FOURS) + ((sums >> U(2)) & FOURS)
    sums = ((sums + (sums >> U(4))) & EIGHTS) * BYTES_1
    byte, before = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    for k in range(7):
        upto = ((sums >> U(8 * k)) & U(255)).astype(np.int64)
        passed = upto <= i
        byte += passed
        before = np.where(passed, upto, before)
    return 8 * byte + ONE_IN_BYTE[i - before, ((words >> (8 * byte).astype(U)) & U(255)).astype(np.int64)]


@dataclass
class EliasFano:
    """Ascending numbers, possibly repeated: ``low`` bits packed side by side, the rest in unary, in 64-bit words."""

    n: int
    low: int
    lows: np.ndarray
    highs: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        largest = int(values[-1]) if n else 0
        if largest > LARGEST:
            raise OverflowError("a sequence of the trie outgrows 62 bits")
        low = max(0, ((largest + 1) // max(n, 1)).bit_length() - 1)
        mask, places = U((1 << low) - 1), np.arange(low, dtype=U)
        packed = [np.zeros(0, np.uint8)]
        for at in range(0, n if low else 0, PACKED_AT_ONCE):
            some = (values[at : at + PACKED_AT_ONCE].astype(U) & mask)[:, None] >> places
            packed.append(np.packbits((some & U(1)).astype(np.uint8).ravel(), bitorder="little"))
        lows = np.concatenate([*packed, np.zeros(16, np.uint8)])
        ones = (values.astype(U) >> U(low)).astype(np.int64) + np.arange(n)
        unary = np.zeros(-(-(int(ones[-1]) + 2 if n else 1) // 64) * 64, np.uint8)
        unary[ones] = 1
        return cls(n, low, np.pad(lows, (0, -len(lows) % 8)), np.packbits(unary, bitorder="little"))


class Sequence:
    """An Elias-Fano sequence, read in place: beside the code there is a count of ones before every 64-bit word."""

    def __init__(self, code: EliasFano):
        self.n, self.low, self.lows = code.n, code.low, code.lows
        self.words = code.highs.view(U)
        self.ones = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.zeros = 64 * np.arange(len(self.ones)) - self.ones
        self.mask = U((1 << code.low) - 1)

    def _upper(self, i: np.ndarray) -> np.ndarray:
        """Upper bits of the i-th numbers: the zeros before the i-th one."""
        at = np.searchsorted(self.ones, i, "right") - 1
        return 64 * at + one_in_word(self.words[at], i - self.ones[at]) - i

    def _lower(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), U)
        bit = i * self.low
        out, shift = np.zeros(len(i), U), (bit & 7).astype(U)
        for k in range(8):
            out |= self.lows[(bit >> 3) + k].astype(U) << U(8 * k)
        out >>= shift
        if self.low > 57:
            ninth = self.lows[(bit >> 3) + 8].astype(U)
            out |= np.where(shift > 0, ninth << (U(64) - np.maximum(shift, U(1))), U(0))
        return out & self.mask

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        return (self._upper(i).astype(U) << U(self.low) | self._lower(i)).astype(np.int64)

    def _first(self, upper: np.ndarray) -> np.ndarray:
        """The place of the first number whose upper bits are at least ``upper``: the ones before the ``upper``-th zero."""
        out = np.full(len(upper), self.n, np.int64)
        out[upper == 0] = 0
        some = np.flatnonzero((upper > 0) & (upper <= self.zeros[-1]))
        i = upper[some] - 1
        at = np.searchsorted(self.zeros, i, "right") - 1
        out[some] = 64 * at + one_in_word(~self.words[at], i - self.zeros[at]) - i
        return np.minimum(out, self.n)

    def find(self, value: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The place of each value in its range, or -1."""
        out = np.full(len(value), -1, np.int64)
        for cut in range(0, len(value), ASKED_AT_ONCE):
            part = slice(cut, cut + ASKED_AT_ONCE)
            upper, rest = value[part] >> self.low, value[part].astype(U) & self.mask
            at, last = np.maximum(start[part], self._first(upper)), np.minimum(end[part], self._first(upper + 1))
            # Bisection by the lower bits of what share the upper ones, mostly one or two.
            while len(going := np.flatnonzero(last - at > 1)):
                middle = (at[going] + last[going]) // 2
                less = self._lower(middle) <= rest[going]
                at[going[less]] = middle[less]
                last[going[~less]] = middle[~less]
            some = np.flatnonzero(last > at)
            some = some[self._lower(at[some]) == rest[some]]
            out[cut + some] = at[some]
        return out

    def at(self, i: np.ndarray) -> np.ndarray:
        """Numbers at places, block by block."""
        parts = [self[i[cut : cut + ASKED_AT_ONCE]] for cut in range(0, len(i), ASKED_AT_ONCE)]
        return np.concatenate([np.zeros(0, np.int64), *parts])


@dataclass
class Level:
    """What a level is made of: ``words`` ascending in each context, ``begins``: one more than contexts; probabilities and weights."""

    words: np.ndarray
    begins: np.ndarray
    chance: np.ndarray
    weight: np.ndarray

    def values(self) -> np.ndarray:
        """The words with the last value of the context before them added."""
        sizes = np.diff(self.begins)
        last = np.where(sizes > 0, self.words[np.maximum(self.begins[1:], 1) - 1] if len(self.words) else 0, 0)
        if last.sum(dtype=np.float64) > LARGEST:
            raise OverflowError("a level of the trie outgrows 62 bits")
        return self.words + np.repeat(np.cumsum(last) - last, sizes)


class Trie:
    """Levels of a blob: words, pointers, one byte of probability and of weight for each n-gram."""

    PARTS = 6

    def __init__(self, blob: bytes):
        # The file has no name and goes with its last user, also if the task dies.
        with tempfile.TemporaryFile() as file:
            file.write(blob)
            file.flush()
            data = np.memmap(file, np.uint8, "r", shape=(len(blob),))
        head = int.from_bytes(data[:8].tobytes(), "little")
        parts, at = json.loads(data[8 : 8 + head].tobytes()), 8 + head
        views = []
        for size in parts["sizes"]:
            views.append(data[at : at + size])
            at += -(-size // 8) * 8
        self.levels = []
        for k, (n, low, pointers, pointer_low) in enumerate(parts["levels"]):
            lows, highs, pointer_lows, pointer_highs, chance, weight = views[self.PARTS * k : self.PARTS * (k + 1)]
            words = Sequence(EliasFano(n, low, lows, highs))
            self.levels.append((words, Sequence(EliasFano(pointers, pointer_low, pointer_lows, pointer_highs)), chance, weight))

    @staticmethod
    def blob(levels: list[Level]) -> bytes:
        views, numbers = [], []
        for level in levels:
            words, begins = EliasFano.of(level.values()), EliasFano.of(level.begins)
            numbers.append((words.n, words.low, begins.n, begins.low))
            views += [words.lows, words.highs, begins.lows, begins.highs, quantised(level.chance), quantised(level.weight)]
        head = json.dumps({"levels": numbers, "sizes": [v.nbytes for v in views]}).encode()
        head += b" " * (-len(head) % 8)
        return len(head).to_bytes(8, "little") + head + b"".join(v.tobytes() + bytes(-v.nbytes % 8) for v in views)

    def find(self, level: int, context: np.ndarray, parent: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Places on ``level`` of words after contexts; -1 for what is not there.

        ``context``: places on the level above (of level 0: zeros), or -1; ``parent``: for each word its context among those.
        """
        words, begins, _, _ = self.levels[level]
        if not words.n:
            return np.full(len(word), -1, np.int64)
        known = np.maximum(context, 0)
        start = np.where(context >= 0, begins.at(known), 0)
        end = np.where(context >= 0, begins.at(known + 1), 0)
        base = np.where(start > 0, words.at(np.maximum(start - 1, 0)), 0)
        return words.find(word + base[parent], start[parent], end[parent])

    def chance(self, level: int, place: np.ndarray) -> np.ndarray:
        return self._code(self.levels[level][2], place, 0)

    def weight(self, level: int, place: np.ndarray) -> np.ndarray:
        """Code of the fall-back weight; a context that is not there falls back wholly (code 1)."""
        return self._code(self.levels[level][3], place, 1)

    @staticmethod
    def _code(codes: np.ndarray, place: np.ndarray, none: int) -> np.ndarray:
        if not len(codes):
            return np.full(len(place), none, np.uint8)
        return np.where(place >= 0, codes[np.maximum(place, 0)], none).astype(np.uint8)
