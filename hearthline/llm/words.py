"""Words of whole texts as numpy arrays: where they are and their 64-bit hashes.

A word is a maximal run of bytes other than space and \\x09-\\x0D. Hashes are multilinear: a random
value for each byte times a random value for its place, summed modulo 2**64, then mixed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = (9, 10, 11, 12, 13, 32)
IS_SPACE = np.isin(np.arange(256), SPACES)
BLOCK_BYTES = 1 << 20
GOLDEN = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    """The first n values of a fixed random stream."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * np.uint64(GOLDEN))


@dataclass(frozen=True)
class Words:
    doc: np.ndarray  # row of the batch
    start: np.ndarray  # byte offsets in data
    end: np.ndarray
    first: np.ndarray  # for each row its first word; one more entry than rows
    data: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the rows' offsets in them; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    where = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[where[0]:where[-1]], where - where[0]


def find_words(column: pa.Array) -> Words:
    data, offsets = text_bytes(column)
    solid = ~IS_SPACE[data]
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    begins[cuts] = solid[cuts]
    cuts = cuts[cuts > 0] - 1
    ends[cuts] = solid[cuts]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets)
    return Words(np.repeat(np.arange(len(column)), np.diff(first)), start, end, first, data)


def hash_words(words: Words, seed: int = 1, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word; with lower, A-Z count as a-z."""
    out = np.zeros(len(words.start), np.uint64)
    if not len(out):
        return out
    table = stream(2 * seed, 256)
    table[IS_SPACE] = 0  # what follows a word adds nothing to its sum
    if lower:
        table[65:91] = table[97:123]
    size = words.end - words.start
    place = stream(2 * seed + 1, int(size.max()))
    at = 0
    while at < len(out):
        stop = max(at + 1, int(np.searchsorted(words.end, words.start[at] + BLOCK_BYTES, "right")))
        start = words.start[at:stop] - words.start[at]
        raw = words.data[words.start[at]:words.end[stop - 1]]
        inside = np.arange(len(raw)) - np.repeat(start, np.diff(start, append=len(raw)))
        np.minimum(inside, len(place) - 1, out=inside)
        out[at:stop] = np.add.reduceat(table[raw] * place[inside], start)
        at = stop
    return mix(out + size.astype(np.uint64) * np.uint64(GOLDEN))


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """The hash of each run of ``length`` consecutive hashes, whatever row they belong to."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, length):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += hashes[k:k + n]
    return mix(out)


def signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))
