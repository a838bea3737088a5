"""Polynomial hashes of byte strings, modulo 2 ** 64, for whole arrays at once."""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
_TABLES: dict[str, np.ndarray] = {}


def powers(n: int, base: int = BASE, name: str = "up") -> np.ndarray:
    """base ** 0 to base ** (n - 1)."""
    held = _TABLES.get(name)
    if held is None or len(held) < n:
        size = max(n, 1 << 16)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        held = _TABLES[name] = np.cumprod(steps, dtype=np.uint64)
    return held[:n]


def prefixes(data: np.ndarray) -> np.ndarray:
    """P[i]: sum of (data[j] + 1) * BASE ** j over j < i."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data)), out=out[1:])
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def windows(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of each window of width bytes; none if there are fewer bytes."""
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    p = prefixes(data)
    return mixed((p[width:] - p[:-width]) * powers(n, INVERSE, "down"))
