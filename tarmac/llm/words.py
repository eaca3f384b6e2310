"""Words of whole texts as arrays: cut and hashed with numpy, straight from Arrow buffers.

No object is made per word, so what a task holds is a few arrays of one slice of text.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

from tarmac.llm.common import mix

#: A-Z lower-cased, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words of more bytes than this are hashed one by one.
LONG_WORD = 256
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
_ODD = np.uint64(0xD6E8FEB86659FD93)


def byte_classes(separators: bytes, breaks: bytes = b"") -> np.ndarray:
    """Class of each byte: 0 part of a word, 1 between words, 2 between pieces."""
    out = np.zeros(256, np.uint8)
    out[list(separators)] = 1
    out[list(breaks)] = 2
    return out


class Words(NamedTuple):
    """Words of a slice in order: row, 64-bit hash, piece (equal: same row, no break between),
    and where each lies in ``data`` (the lower-cased bytes of all rows)."""

    row: np.ndarray
    hash: np.ndarray
    piece: np.ndarray
    start: np.ndarray
    size: np.ndarray
    data: np.ndarray

    def text(self, i: int) -> bytes:
        return self.data[self.start[i]:self.start[i] + self.size[i]].tobytes()


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row bounds) of a string array without NULLs."""
    wide = pa.types.is_large_string(texts.type)
    if not wide and not pa.types.is_string(texts.type):
        texts, wide = texts.cast(pa.large_string()), True
    _, offsets, data = texts.buffers()
    if data is None or len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def cut_words(texts: pa.Array, classes: np.ndarray, seeds: np.ndarray | None = None) -> Words:
    """The words of every text; ``seeds`` (one per row) make equal words of different kinds differ."""
    raw, bounds = flat(texts)
    data = LOWER[raw]
    kind = classes[data]
    inside = kind == 0
    first = np.zeros(len(data) + 1, bool)  # where a row begins
    first[bounds] = True
    before = np.append(False, inside[:-1]) if len(data) else inside
    start = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.append(inside[1:], False) if len(data) else inside
    size = np.flatnonzero(inside & (~after | first[1:])) + 1 - start
    row = np.searchsorted(bounds, start, "right") - 1
    piece = np.cumsum(kind == 2, dtype=np.int64)[start] + row
    seed = np.zeros(len(texts), np.uint64) if seeds is None else seeds
    return Words(row, _hashes(data, start, size, seed[row]), piece, start, size, data)


def _hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """64-bit hash of each span, eight bytes at a time; the size and the seed count too."""
    h = mix(seed + size.astype(np.uint64) * _ODD)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    live = np.flatnonzero(size <= LONG_WORD)
    at, left = start[live], size[live]
    while len(live):
        h[live] = mix((h[live] ^ (eight[at] & _MASK[np.minimum(left, 8)])) * _ODD)
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(size > LONG_WORD):
        import xxhash

        h[i] = xxhash.xxh3_64_intdigest(data[start[i]:start[i] + size[i]].tobytes(), int(h[i]))
    return h


def counted(values: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, sorted, with their counts (or sums of weights)."""
    if weights is None:
        return np.unique(values, return_counts=True)
    order = np.argsort(values)
    values, weights = values[order], weights[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)
    return values[first], np.add.reduceat(weights, first) if len(first) else weights


class Counter64:
    """Counts of 64-bit values over many slices; what is held is bounded: above ``limit``
    distinct values they are handed out and forgotten (sums are made later)."""

    def __init__(self, limit: int = 1 << 20):
        self.limit, self.parts, self.held = limit, [], 0

    def add(self, values: np.ndarray) -> None:
        self.parts.append(counted(values))
        self.held += len(self.parts[-1][0])

    def full(self) -> bool:
        if self.held > 2 * self.limit:
            self.parts = [self._merged()]
            self.held = len(self.parts[0][0])
        return self.held > self.limit

    def _merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return counted(np.concatenate([p[0] for p in self.parts]), np.concatenate([p[1] for p in self.parts]))

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        """What is held, (values, counts); nothing is held afterwards."""
        out = self._merged()
        self.parts, self.held = [], 0
        return out
