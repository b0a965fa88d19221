"""Monotone sequences in Elias-Fano code, and an n-gram trie of them in one flat buffer."""

from __future__ import annotations

import numpy as np

from millrace.llm.blocks import ship

ship(__name__)

# Logarithms to the base ten are kept in steps of 1/STEP, from HIGH downwards, in 16 bits.
STEP = 1024
HIGH = 12
# Not a logarithm: the pair of words was not seen.
OPEN = (1 << 16) - 1


def quantised(value: np.ndarray) -> np.ndarray:
    return np.clip(np.rint((HIGH - np.log10(value)) * STEP), 0, OPEN - 1).astype(np.uint16)


def logarithm(code: np.ndarray) -> np.ndarray:
    return HIGH - code / STEP


class Sequence:
    """Non-decreasing numbers below ``universe``: low bits packed, high bits in unary.

    The arrays are views; ``arrays`` gives what ``Sequence.of`` takes back.
    """

    def __init__(self, size: int, universe: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.size, self.universe = size, universe
        self.bits = max(0, (universe // max(size, 1)).bit_length() - 1)
        self.low, self.high, self.ones = low, high, ones

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> Sequence:
        size, universe = len(values), max(int(universe), 1)
        bits = max(0, (universe // max(size, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        low = np.zeros(size * bits // 64 + 2, np.uint64)
        if bits and size:
            part = values & np.uint64((1 << bits) - 1)
            at = np.arange(size) * bits
            word, shift = at >> 6, (at & 63).astype(np.uint64)
            np.bitwise_or.at(low, word, part << shift)
            over = np.flatnonzero(shift + np.uint64(bits) > 64)
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        place = (values >> np.uint64(bits)).astype(np.int64) + np.arange(size)
        flags = np.zeros(-(-((universe >> bits) + size + 2) // 64) * 64, np.uint8)
        flags[place] = 1
        high = np.packbits(flags, bitorder="little").view(np.uint64)
        ones = np.concatenate(([0], np.cumsum(np.bitwise_count(high), dtype=np.int64)))
        return cls(size, universe, low, high, ones)

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.size, self.universe], np.int64), self.low, self.high, self.ones]

    @classmethod
    def of(cls, head, low, high, ones) -> Sequence:
        return cls(int(head[0]), int(head[1]), low.view(np.uint64), high.view(np.uint64), ones)

    def _select(self, rank: np.ndarray, zero: bool) -> np.ndarray:
        """Place of the bit that has ``rank`` bits of its kind before it."""
        before = np.arange(len(self.ones)) * 64 - self.ones if zero else self.ones
        word = np.searchsorted(before, rank, side="right") - 1
        left = rank - before[word]
        x = ~self.high[word] if zero else self.high[word]
        place = word * 64
        for width in (32, 16, 8, 4, 2, 1):
            count = np.bitwise_count(x & np.uint64((1 << width) - 1)).astype(np.int64)
            beyond = left >= count
            left -= np.where(beyond, count, 0)
            x = np.where(beyond, x >> np.uint64(width), x)
            place += np.where(beyond, width, 0)
        return place

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.int64)
        at = i * self.bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        part = self.low[word] >> shift
        # a shift by 64 is undefined, so the upper part is moved in two steps
        part |= (self.low[word + 1] << (np.uint64(63) - shift)) << np.uint64(1)
        return (part & np.uint64((1 << self.bits) - 1)).astype(np.int64)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        return ((self._select(i, False) - i) << self.bits) | self._low(i)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Index of each ``x``, found as its successor: the first element that is not smaller; -1 if it is another."""
        out = np.full(len(x), -1, np.int64)
        asked = np.flatnonzero((x >= 0) & (x < self.universe))
        if not self.size or not len(asked):
            return out
        x = x[asked]
        bucket = x >> self.bits
        end = self._select(bucket, True) - bucket
        begin = np.where(bucket > 0, self._select(np.maximum(bucket - 1, 0), True) - bucket + 1, 0)
        wanted, last = x & ((1 << self.bits) - 1), end.copy()
        while (open_ := begin < end).any():
            middle = (begin + end) >> 1
            less = self._low(np.minimum(middle, self.size - 1)) < wanted
            begin = np.where(open_ & less, middle + 1, begin)
            end = np.where(open_ & ~less, middle, end)
        hit = (begin < last) & (self._low(np.minimum(begin, self.size - 1)) == wanted)
        out[asked[hit]] = begin[hit]
        return out


def grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each distinct key, in order, the place of one that is equal; and each key's number among them."""
    order = np.argsort(key)
    found = key[order]
    new = np.append(True, found[1:] != found[:-1])[: len(key)]
    of = np.empty(len(key), np.int64)
    of[order] = np.cumsum(new) - 1
    return order[new], of


class Trie:
    """Trigrams grouped by their middle word: successors, contexts before it, and successors in contexts.

    A middle word's successors are its bigrams, each with its smoothed probability and the weight that it has
    as a context itself.  In a context, the word before the middle one, a successor is named by its place among
    those of the middle word alone, so its number is below how many there are.  Levels are
    Elias-Fano sequences with pointers per middle word; a code for each entry stands beside them.
    """

    SEQUENCES = ("words", "middles", "successors", "successor_at", "contexts", "context_at", "trigrams", "trigram_at")
    CODES = ("successor_code", "successor_weight", "trigram_code")

    @classmethod
    def build(cls, first, middle, last, count, own, total, prior2: float, prior3: float) -> bytes:
        """The levels of the distinct trigrams (``first``, ``middle``, ``last``), each ``count`` times there.

        ``own`` is the last word's own probability, ``total`` how often the middle word is a context.  All
        trigrams of a pair of middle and last words must be here.  A trigram's code is of its probability
        divided by the weight of its context, which the pair of its first two words holds.
        """
        words = np.unique(np.concatenate([np.unique(x) for x in (first, middle, last)]))
        w = max(len(words), 1)
        first, middle, last = (np.searchsorted(words, x) for x in (first, middle, last))
        middles = np.unique(middle)
        middle = np.searchsorted(middles, middle)
        m = len(middles)
        pair, of = grouped(middle * w + last)
        successors = (middle * w + last)[pair]
        context, of_context = grouped(middle * w + first)
        contexts = (middle * w + first)[context]
        # counts are whole numbers far below 2**53, so these sums are exact
        together = np.bincount(of, count, len(pair))
        p2 = (together + prior2 * own[pair]) / (total[pair] + prior2)
        edges = np.arange(m + 1) * w
        successor_at, context_at = np.searchsorted(successors, edges), np.searchsorted(contexts, edges)
        wide = np.diff(successor_at)
        trigram_at = np.concatenate(([0], np.cumsum(np.diff(context_at) * wide)))
        place = trigram_at[middle] + (of_context - context_at[middle]) * wide[middle] + of - successor_at[middle]
        order = np.argsort(place)
        sequences = {
            "words": (words, int(words[-1]) + 1 if len(words) else 1),
            "middles": (middles, w),
            "successors": (successors, m * w),
            "successor_at": (successor_at, len(successors) + 1),
            "contexts": (contexts, m * w),
            "context_at": (context_at, len(contexts) + 1),
            "trigrams": (place[order], int(trigram_at[-1])),
            "trigram_at": (trigram_at, int(trigram_at[-1]) + 1),
        }
        arrays = [a for name in cls.SEQUENCES for a in Sequence.encode(*sequences[name]).arrays()]
        arrays += [quantised(x) for x in (p2, prior3 / (together + prior3), (p2[of] + count / prior3)[order])]
        # every array begins at a multiple of eight bytes
        sizes = np.array([len(arrays), *(a.nbytes for a in arrays)], np.int64)
        return b"".join([sizes.tobytes(), *(a.tobytes() + bytes(-a.nbytes % 8) for a in arrays)])

    def __init__(self, buffer):
        """``buffer``: what ``build`` returned, in memory or as an ``np.memmap`` of a file; nothing is copied or parsed."""
        n = int(np.frombuffer(buffer, np.int64, 1)[0])
        sizes = np.frombuffer(buffer, np.int64, n, 8)
        at, views = 8 * (n + 1), []
        for i, size in enumerate(sizes.tolist()):
            kind = np.uint16 if i >= 4 * len(self.SEQUENCES) else np.int64
            views.append(np.frombuffer(buffer, kind, size // np.dtype(kind).itemsize, at))
            at += size + -size % 8
        for i, name in enumerate(self.SEQUENCES):
            setattr(self, name, Sequence.of(*views[4 * i : 4 * i + 4]))
        for name, view in zip(self.CODES, views[4 * len(self.SEQUENCES) :], strict=True):
            setattr(self, name, view)

    def codes(self, first: np.ndarray, middle: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every trigram the code of its probability over its context's weight, and that of its last pair's weight.

        Both are OPEN where the last pair was not seen; a trigram that was not has the pair's probability.
        """
        w = self.middles.universe
        code, weight = (np.full(len(first), OPEN, np.uint16) for _ in range(2))
        # words are looked up once each, and so are a middle word's pointers
        (a, of1), (b, of2), (c, of3) = grouped(first), grouped(middle), grouped(last)
        r1, m, r3 = self.words.find(first[a]), self.middles.find(self.words.find(middle[b])), self.words.find(last[c])
        here = np.maximum(m, 0)
        if not self.middles.size:
            return code, weight
        starts, wide = self.successor_at[here], self.successor_at[here + 1] - self.successor_at[here]
        contexts, base = self.context_at[here], self.trigram_at[here]
        known = np.flatnonzero((m[of2] >= 0) & (r3[of3] >= 0))
        j = self.successors.find(m[of2[known]] * w + r3[of3[known]])
        known, j = known[j >= 0], j[j >= 0]
        code[known], weight[known] = self.successor_code[j], self.successor_weight[j]
        named = r1[of1[known]] >= 0
        known, j = known[named], j[named]
        k = self.contexts.find(m[of2[known]] * w + r1[of1[known]])
        known, j, k = known[k >= 0], j[k >= 0], k[k >= 0]
        mid = of2[known]
        t = self.trigrams.find(base[mid] + (k - contexts[mid]) * wide[mid] + j - starts[mid])
        code[known[t >= 0]] = self.trigram_code[t[t >= 0]]
        return code, weight
