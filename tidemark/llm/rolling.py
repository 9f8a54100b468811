"""Vectorised rolling hashes over bytes: prefix sums of place-weighted random byte values, modulo 2^64."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUES = np.random.default_rng(20_240_229).integers(1, 1 << 63, 256, dtype=np.uint64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        with np.errstate(over="ignore"):
            for i, b in enumerate((_BASE, _INVERSE)):
                _POWERS[i] = np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(size - 1, b, np.uint64))))
    return _POWERS


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def prefix(data: np.ndarray) -> np.ndarray:
    """n + 1 prefix sums."""
    out = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_VALUES[data] * _powers(len(data) + 1)[0][: len(data)], out=out[1:])
    return out


def spans(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end], the same wherever equal bytes stand."""
    with np.errstate(over="ignore"):
        return mix((sums[ends] - sums[starts]) * _powers(len(sums))[1][starts])
