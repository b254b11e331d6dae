"""Words of whole batches of texts as numpy arrays, without a Python step per word.

A word is a run of characters other than space and U+0009 to U+000D, as ``bytes.split()`` finds it. Its key is a
64-bit polynomial hash of its bytes. All functions take the Arrow text column itself, so nothing is copied.
"""

from __future__ import annotations

from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
SPACES = b" \t\n\x0b\x0c\r"

IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True


class Words(NamedTuple):
    data: np.ndarray  # the bytes of all texts
    offsets: np.ndarray  # text i is data[offsets[i]:offsets[i + 1]]
    starts: np.ndarray  # of each word in data
    ends: np.ndarray
    keys: np.ndarray  # unsigned 64-bit
    first: np.ndarray  # words of text i are first[i]:first[i + 1]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        """The text number of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def text_bytes(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    content = np.frombuffer(data, np.uint8) if data is not None and len(texts) else np.zeros(0, np.uint8)
    return (content[bounds[0] : bounds[-1]], bounds - bounds[0]) if len(texts) else (content[:0], np.zeros(1, np.int64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@cache
def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    forward, back = np.full(count, _BASE, np.uint64), np.full(count, _INVERSE, np.uint64)
    forward[:1] = back[:1] = 1
    return np.cumprod(forward), np.cumprod(back)


def span_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Keys of spans that are in order and do not overlap."""
    return prefix_keys(data, starts, ends, [ends])[0]


def prefix_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, cuts: list[np.ndarray]) -> list[np.ndarray]:
    """Keys of the spans' beginnings, up to each of the cuts, in slices that end between spans."""
    keys = [np.zeros(len(starts), np.uint64) for _ in cuts]
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, base + SLICE, side="right")))
        size = int(ends[j - 1]) - base
        forward, back = _powers(SLICE + 1) if size <= SLICE else _powers.__wrapped__(size + 1)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum((data[base : base + size].astype(np.uint64) + np.uint64(1)) * forward[:size], out=sums[1:])
        low = starts[i:j] - base
        for key, cut in zip(keys, cuts, strict=True):
            key[i:j] = mix((sums[cut[i:j] - base] - sums[low]) * back[low])
        i = j
    return keys


def find_words(texts: pa.StringArray, lower: bool = False) -> Words:
    data, offsets = text_bytes(texts)
    if lower:
        data = data + (((data >= 65) & (data <= 90)) * np.uint8(32))
    solid = ~IS_SPACE[data]
    before = np.zeros(len(data), bool)
    before[1:] = solid[:-1]
    inner = offsets[(offsets < len(data))]
    before[inner] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = solid[1:]
    last = offsets[(offsets > 0)] - 1
    after[last] = False
    ends = np.flatnonzero(solid & ~after) + 1
    first = np.searchsorted(starts, offsets)
    return Words(data, offsets, starts, ends, span_keys(data, starts, ends), first)


_FACTOR = 0xC2B2AE3D27D4EB4F


def window_keys(keys: np.ndarray, size: int) -> np.ndarray:
    """A key for each run of ``size`` words, by its first word; the last ``size - 1`` words start none.

    Runs of 1, 2, 4, ... words are doubled and joined to ``size``, so long runs cost a few passes only."""
    if len(keys) < size:
        return np.zeros(0, np.uint64)
    power, have, out, done = keys, 1, None, 0
    while True:
        factor = np.uint64(pow(_FACTOR, have, 1 << 64))
        if size & have:
            count = len(keys) - done - have + 1
            out = power[:count] if out is None else out[:count] * factor + power[done : done + count]
            done += have
        if done == size:
            return mix(out)
        count = len(keys) - 2 * have + 1
        power, have = power[:count] * factor + power[have : have + count], 2 * have


def inside(words: Words, size: int) -> np.ndarray:
    """True where the window of ``size`` words that starts at a word stays in its text; as long as window_keys."""
    count = max(0, len(words.keys) - size + 1)
    ends = np.repeat(words.first[1:], words.counts)[:count]
    return np.arange(count) + size <= ends


def code_points(data: np.ndarray) -> np.ndarray:
    """True at the first byte of each code point."""
    return (data & 0xC0) != 0x80


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The sum of the flags (or numbers) of each text."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]
