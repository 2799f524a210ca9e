"""Minimal perfect hashes of small sets of byte strings.

Keys are hashed to two 64-bit numbers.  The first puts a key into a bucket of a
few; buckets are placed largest first, each with the smallest displacement that
sends all its keys to free slots; a bucket of one key names its slot outright.
n keys take the slots 0 to n - 1.  The keys are stored by slot, so that a string
outside the set is told apart for certain.
"""

from __future__ import annotations

import pickle
from array import array
from dataclasses import dataclass

import numpy as np
import xxhash

MASK = (1 << 64) - 1
PER_BUCKET = 2
#: Displacements that are tried at once.
TRIES = 64


def two_hashes(key: bytes, seed: int = 0) -> tuple[int, int]:
    both = xxhash.xxh3_128_intdigest(key, seed)
    return both & MASK, both >> 64


def _slots(h: np.ndarray, first: int, n: int) -> np.ndarray:
    """Slots of second hashes under TRIES displacements from ``first`` on, one row each."""
    with np.errstate(over="ignore"):
        moves = np.arange(first, first + TRIES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (h[None, :] ^ moves[:, None]) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(n)).astype(np.int64)


def _slot(h: int, move: int, n: int) -> int:
    x = (h ^ (move * 0x9E3779B97F4A7C15 & MASK)) * 0xBF58476D1CE4E5B9 & MASK
    return (x ^ x >> 31) % n


@dataclass(frozen=True)
class PerfectHash:
    seed: int
    moves: array  # displacement of a bucket, or -1 - slot of its only key
    ends: array  # where the key of a slot ends in ``keys``; one more in front
    keys: bytes

    def __len__(self) -> int:
        return len(self.ends) - 1

    def key(self, slot: int) -> bytes:
        return self.keys[self.ends[slot]: self.ends[slot + 1]]

    def slot(self, key: bytes) -> int:
        """The key's slot, or -1 for a string outside the set."""
        n = len(self)
        if not n:
            return -1
        a, b = two_hashes(key, self.seed)
        move = self.moves[a % len(self.moves)]
        at = -1 - move if move < 0 else _slot(b, move, n)
        return at if self.key(at) == key else -1

    def packed(self) -> bytes:
        return pickle.dumps((self.seed, self.moves, self.ends, self.keys), protocol=5)


def unpacked(blob: bytes) -> PerfectHash:
    return PerfectHash(*pickle.loads(blob))


def build(keys: list[bytes], most_moves: int = 1 << 16) -> PerfectHash:
    """A perfect hash of distinct keys; the seed grows until one is found."""
    seed = 0
    while (found := _placed(keys, seed, most_moves)) is None:
        seed += 1
    moves, by_slot = found
    ends = array("q", [0, *np.cumsum([len(k) for k in by_slot], dtype=np.int64).tolist()])
    return PerfectHash(seed, array("q", moves), ends, b"".join(by_slot))


def _placed(keys: list[bytes], seed: int, most_moves: int) -> tuple[list[int], list[bytes]] | None:
    n = len(keys)
    hashes = [two_hashes(k, seed) for k in keys]
    buckets: list[list[int]] = [[] for _ in range(n // PER_BUCKET + 1)]
    for i, (a, _) in enumerate(hashes):
        buckets[a % len(buckets)].append(i)
    second = np.array([b for _, b in hashes], dtype=np.uint64)
    taken, owner, moves = np.zeros(n, dtype=bool), [-1] * n, [0] * len(buckets)
    order = sorted(range(len(buckets)), key=lambda j: -len(buckets[j]))
    single = [j for j in order if len(buckets[j]) == 1]
    for j in order:
        members = buckets[j]
        if len(members) < 2:
            continue
        own = second[members]
        for first in range(0, most_moves, TRIES):
            tried = _slots(own, first, n)
            apart = np.sort(tried, axis=1)
            fits = np.flatnonzero(~taken[tried].any(axis=1) & (apart[:, 1:] != apart[:, :-1]).all(axis=1))
            if len(fits):
                break
        else:
            return None
        at = tried[fits[0]]
        taken[at] = True
        moves[j] = first + int(fits[0])
        for i, s in zip(members, at.tolist()):
            owner[s] = i
    for j, s in zip(single, np.flatnonzero(~taken).tolist()):
        moves[j] = -1 - s
        owner[s] = buckets[j][0]
    return moves, [keys[i] for i in owner]
