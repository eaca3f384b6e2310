"""Prefix polynomial hashes of integer sequences: span equality and longest common extensions."""

from __future__ import annotations

import numpy as np

#: The prime 2^31 - 1 (its remainders need no division) and two bases; together a span hash
#: has about 62 bits.
PRIME = (1 << 31) - 1
BASES = (911_382_323, 972_663_749)
_P, _31 = np.uint64(PRIME), np.uint64(31)

_POWERS: dict[tuple[int, int], np.ndarray] = {}


def remainder(x: np.ndarray) -> np.ndarray:
    """x modulo 2^31 - 1, for x below 2^64."""
    x = (x & _P) + (x >> _31)
    x = (x & _P) + (x >> _31)
    return np.minimum(x, x - _P)  # below the prime the difference wraps round to a large value


def powers(which: int, n: int, inverse: bool = False) -> np.ndarray:
    """base^0 .. base^(n-1) modulo the prime (or the inverse powers), grown by doubling and kept."""
    base = pow(BASES[which], -1, PRIME) if inverse else BASES[which]
    have = _POWERS.get((which, inverse), np.ones(1, np.uint64))
    while len(have) < n:
        step = np.uint64(pow(base, len(have), PRIME))
        have = np.concatenate([have, remainder(have * step)])
        _POWERS[which, inverse] = have
    return have[:n]


class PrefixHashes:
    """Modular prefix arrays of one sequence of values below 2^32.

    ``prefix[w][i]`` is the sum of (x[j] + 1) * base^j for j < i. The hash of a span is the
    difference of two entries times an inverse power, so that equal spans have equal hashes
    wherever they stand. Values of different sequences compare.
    """

    def __init__(self, values: np.ndarray, moduli: int = 2):
        x = values.astype(np.uint64) + np.uint64(1)
        self.n, self.prefix = len(x), []
        small = values.dtype == np.uint8 and len(x) < 1 << 24  # sums of products stay below 2^64
        for w in range(moduli):
            out = np.zeros(len(x) + 1, np.uint64)
            terms = x * powers(w, len(x))
            np.cumsum(terms if small else remainder(terms), out=out[1:])
            self.prefix.append(remainder(out))

    def part(self, which: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = self.prefix[which]
        return remainder(remainder(h[ends] + _P - h[starts]) * powers(which, self.n + 1, inverse=True)[starts])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """62-bit hashes of the spans [start, end)."""
        out = self.part(0, starts, ends)
        return out << np.uint64(31) | self.part(1, starts, ends) if len(self.prefix) > 1 else out

    def whole(self) -> int:
        return int(self.spans(np.zeros(1, np.int64), np.full(1, self.n))[0])


_WRAPPING = 0x9E3779B97F4A7C15
_WRAPPED: dict[bool, np.ndarray] = {}


def wrapping_powers(n: int, inverse: bool = False) -> np.ndarray:
    """Powers of an odd base (or of its inverse) modulo 2^64, grown by doubling and kept."""
    base = pow(_WRAPPING, -1, 1 << 64) if inverse else _WRAPPING
    have = _WRAPPED.get(inverse, np.ones(1, np.uint64))
    while len(have) < n:
        have = np.concatenate([have, have * np.uint64(pow(base, len(have), 1 << 64))])
        _WRAPPED[inverse] = have
    return have[:n]


def span_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all spans of ``size`` values from one prefix array modulo 2^64, where overflow
    does the division. Built texts can collide: for choices that later steps check."""
    n = len(values)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * wrapping_powers(n), out=prefix[1:])
    return (prefix[size:] - prefix[:n + 1 - size]) * wrapping_powers(n + 1 - size, inverse=True)


def common_extension(a: PrefixHashes, at: np.ndarray, b: PrefixHashes, bt: np.ndarray, limit: int | None = None) -> np.ndarray:
    """Length of the longest common extension of a[at:] and b[bt:] for many pairs at once,
    by binary search over span equality."""
    low = np.zeros(len(at), np.int64)
    high = np.minimum(a.n - at, b.n - bt)
    if limit is not None:
        high = np.minimum(high, limit)
    while (low < high).any():
        mid = (low + high + 1) >> 1
        same = a.spans(at, at + mid) == b.spans(bt, bt + mid)
        low, high = np.where(same, mid, low), np.where(same, high, np.maximum(mid - 1, low))
    return low
