"""Hashes of many pieces of a text at once, with numpy."""

from __future__ import annotations

import hashlib

import numpy as np

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_M = (1 << 64) - 1
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    made = _tables.get(which)
    if made is None or len(made[0]) < n:
        size = max(n, 1 << 16)
        tables = []
        for base in (_BASES[which], pow(_BASES[which], -1, 1 << 64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            tables.append(np.multiply.accumulate(p))
        _tables[which] = made = tuple(tables)
    return made


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """64-bit hashes of values[starts:ends]; equal contents hash alike wherever they stand.

    A polynomial modulo 2**64, for which strings of equal hash are known: a first guess only, where equal
    hashes are looked into or joined with another hash.
    """
    power, inverse = _powers(which, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * power[: len(values)], out=sums[1:])
    at = (sums[ends] - sums[starts]) * inverse[starts]
    return mix64(at + (ends - starts).astype(np.uint64) * np.uint64(_BASES[2]))


SHORT = 64
_PLACED = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 64, (SHORT, 256), np.uint64, endpoint=False).reshape(-1)


def short_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[starts:ends], bytes, none empty.

    A sum of random numbers, one for each (place, byte), which no family of strings collides in whatever
    the numbers are; a string over ``SHORT`` bytes is hashed by blake2b.
    """
    size = ends - starts
    if not len(size):
        return np.zeros(0, np.uint64)
    held = np.minimum(size, SHORT)
    first = np.cumsum(held) - held
    place = np.arange(held.sum()) - np.repeat(first, held)
    char = data[place + np.repeat(starts, held)]
    out = mix64(np.add.reduceat(_PLACED[place * 256 + char], first) + size.astype(np.uint64) * np.uint64(_BASES[2]))
    for i in np.flatnonzero(size > SHORT).tolist():
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    return out
