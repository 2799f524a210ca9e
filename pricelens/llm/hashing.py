"""Hashes of words and word runs, computed on whole blocks of text at once.

A block is a list of texts; its bytes are joined by one blank, so that no word
crosses a text.  Every byte is replaced by a random 64-bit number, a run's
polynomial over these is read off prefix sums modulo 2^64, and a bijective
mixer spreads the bits.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (two multiply and shift rounds)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> U(30))
        x = x * U(0xBF58476D1CE4E5B9)
        x = x ^ (x >> U(27))
        x = x * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def byte_table(seed: int = 1, lower: bool = False) -> np.ndarray:
    """A random number for each byte; A-Z share those of a-z when ``lower``."""
    with np.errstate(over="ignore"):
        table = mix(np.arange(256, dtype=U) * U(BASE) + U(seed) * U(0xD1B54A32D192ED03) + U(7))
    if lower:
        table[65:91] = table[97:123]
    return table


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least ``n`` of each."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n + (n >> 3), 1 << 18)  # blocks differ a little in length
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            p = np.full(size, base, dtype=U)
            p[0] = 1
            with np.errstate(over="ignore"):
                _powers[name] = np.cumprod(p, dtype=U)
    return _powers["up"], _powers["down"]


@lru_cache(maxsize=8)
def _table(seed: int, lower: bool) -> np.ndarray:
    return byte_table(seed, lower)


def prefix(data: np.ndarray, seed: int = 1, lower: bool = False) -> np.ndarray:
    """Prefix sums of the polynomial, one longer than the data."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=U)
    with np.errstate(over="ignore"):
        np.cumsum(_table(seed, lower)[data] * up[: len(data)], out=out[1:])
    return out


def spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of every run [start, end)."""
    _, down = powers(len(sums))
    with np.errstate(over="ignore"):
        return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(U) * U(0xA24BAED4963EE407))


WORD = np.ones(256, dtype=bool)
WORD[[32, 9, 10, 11, 12, 13]] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def join(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts with a blank after each, and where each text starts (one more at the end)."""
    data = np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)
    at = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=at[1:])
    return data, at


def words(data: np.ndarray, kind: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes of a kind."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = kind[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def combine(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` neighbours, in order."""
    size = max(0, len(hashes) - n + 1)
    out = np.zeros(size, dtype=U)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = mix(out * U(BASE) + hashes[k: k + size])
    return out
