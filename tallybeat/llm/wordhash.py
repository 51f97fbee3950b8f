"""Hashes of all words of a batch of texts, from the Arrow buffers, without Python strings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is handled alone.
SLICE = 1 << 20
MIX1, MIX2, MIX3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)

_draw = np.random.default_rng(1)
#: A random number for each byte, for texts as they are and with A-Z taken as a-z.
PLAIN = _draw.integers(0, 1 << 64, 256, np.uint64, endpoint=False)
LOWER = PLAIN.copy()
LOWER[65:91] = PLAIN[97:123]
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
#: Everything in ASCII but letters and digits, for words without their punctuation.
MARKS = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * MIX3
    return x ^ (x >> np.uint64(29))


class Ranges:
    """Hashes of any range of a sequence of numbers, from sums of powers."""

    BASE = 0x9E3779B97F4A7C15
    power = np.ones(1, np.uint64)
    inverse = np.ones(1, np.uint64)

    def __init__(self, values: np.ndarray):
        if len(Ranges.power) <= len(values):
            size = 2 * len(values) + 2
            for name, base in (("power", self.BASE), ("inverse", pow(self.BASE, -1, 1 << 64))):
                all_ = np.full(size, np.uint64(base))
                all_[0] = 1
                setattr(Ranges, name, np.multiply.accumulate(all_))
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * Ranges.power[: len(values)], out=self.sums[1:])

    def hashed(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = mixed((self.sums[end] - self.sums[begin]) * Ranges.inverse[begin])
        return mixed(value * MIX1 + (end - begin).astype(np.uint64))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the texts, and the bounds of each text in them."""
    texts = texts.cast(pa.large_binary())
    bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return data, bounds


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``SLICE`` bytes; a longer text is a range of its own."""
    bounds = buffers(texts)[1] if len(texts) else np.zeros(1, np.int64)
    begin = 0
    while begin < len(texts):
        end = int(np.searchsorted(bounds, bounds[begin] + SLICE, "right")) - 1
        end = min(max(end, begin + 1), len(texts))
        yield begin, end
        begin = end


def word_ranges(texts: pa.Array, lower: bool, blank: np.ndarray) -> tuple[Ranges, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of byte ranges, where words begin and end, and how many each text has."""
    data, bounds = buffers(texts)
    data, bounds = data[bounds[0] : bounds[-1]], bounds - bounds[0]
    letter = ~blank[data]
    opens = letter.copy()
    opens[1:] &= ~letter[:-1]
    closes = letter.copy()
    closes[:-1] &= ~letter[1:]
    edges = bounds[:-1][np.diff(bounds) > 0]
    opens[edges] = letter[edges]
    closes[edges[1:] - 1] = letter[edges[1:] - 1]
    begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Ranges((LOWER if lower else PLAIN)[data]), begin, end, np.diff(np.searchsorted(begin, bounds))


def word_hashes(texts: pa.Array, lower: bool = False, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word in order, and how many words each text has."""
    ranges, begin, end, sizes = word_ranges(texts, lower, blank)
    return ranges.hashed(begin, end), sizes
