"""Word blocks: the numpy view of a group of documents that the Python tasks share."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

BLOCK_BYTES = 1 << 20

# Odd multipliers of the two hash lanes.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def ship(module: str) -> None:
    """Send a module's functions to the executors by value, so that they need no copy of it."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def block_count(docs: DataFrame, block_bytes: int) -> int:
    """How many blocks of about ``block_bytes`` the texts fill."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-total // block_bytes))


def block_of(n_blocks: int) -> Column:
    """A row's block, from its content alone: a lost task finds the same one again."""
    return F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).cast("int")


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def sliding(pick, values: np.ndarray, width: int) -> np.ndarray:
    """``pick`` (a minimum or maximum) of every ``width`` consecutive values."""
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = pick(out[: len(out) - step], out[step:])
        done += step
    return out


class WordBlock:
    """Words of several texts, numbered within the block and hashed across blocks."""

    def __init__(self, texts, lower: bool = False):
        words: list[bytes] = []
        counts = []
        for text in texts:
            # bytes.split() cuts at exactly 0x20 and 0x09-0x0D, bytes.lower() maps exactly A-Z
            found = text.encode("utf-8", "surrogatepass") if text else b""
            found = found.lower().split() if lower else found.split()
            words += found
            counts.append(len(found))
        self.words = words
        self.counts = np.array(counts, np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.counts)))
        numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
        self.ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        digests = b"".join(map(xxhash.xxh3_128_digest, numbers))
        self.digests = np.frombuffer(digests, np.uint64).reshape(-1, 2)
        self._lanes: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _lane(self, lane: int):
        if lane not in self._lanes:
            base = BASES[lane]
            n = len(self.ids) + 1
            up, down = (np.full(n, b % 2**64, np.uint64) for b in (base, pow(base, -1, 2**64)))
            up[0] = down[0] = 1
            up, down = np.cumprod(up), np.cumprod(down)
            terms = self.digests[self.ids, lane] * down[:-1]
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms)))
            self._lanes[lane] = up, sums
        return self._lanes[lane]

    def spans(self, start: np.ndarray, length, lane: int = 0) -> np.ndarray:
        """Hash of the ``length`` words from each ``start``; equal words, equal hash."""
        up, sums = self._lane(lane)
        raw = (sums[start + length] - sums[start]) * up[start]
        return mixed(raw + np.asarray(length, np.uint64) * np.uint64(0xA0761D6478BD642F))

    def window_starts(self, width: int) -> np.ndarray:
        """Where ``width`` consecutive words of one text begin."""
        room = np.maximum(self.counts - width + 1, 0)
        ends = np.cumsum(room)
        shift = np.repeat(self.starts[:-1] - (ends - room), room)
        return np.arange(room.sum()) + shift


def merged(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Union of the half-open intervals, sorted."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(start, end, strict=True)):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def pieces(batch, column: str = "text", size: int = BLOCK_BYTES):
    """Slices of an Arrow batch whose ``column`` has about ``size`` bytes, one row at least."""
    array = batch.column(column)
    if not len(array):
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(array), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(array):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
