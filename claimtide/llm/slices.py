"""Digests of many byte slices at once."""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(7)
_BASE = int(_RNG.integers(1 << 62)) * 2 + 1
_SCATTER = _RNG.integers(1, 1 << 63, 256).astype(np.uint64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, x in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            _POWERS[k] = np.cumprod(np.append(np.ones(1, np.uint64), np.full(n - 1, x, np.uint64)))
    return _POWERS


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slice_digests(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit digest of every ``raw[start:end]``: differences of the running
    sums of one polynomial, shifted back to the slice's start."""
    power, inverse = _powers(len(raw) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_SCATTER[raw] * power[: len(raw)])])
    length = (ends - starts).astype(np.uint64)
    return mixed((total[ends] - total[starts]) * inverse[starts] + length * np.uint64(0x9E3779B97F4A7C15))
