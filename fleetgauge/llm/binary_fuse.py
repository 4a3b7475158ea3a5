"""Static binary-fuse filters: 8 bits of a key's hash, spread over three slots of near segments.

A filter is built once for a set of 64-bit keys and never changed. It holds about 1.13 bytes a
key, finds every key of the set, and one in 256 of others.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

from fleetgauge.llm.codepoints import mixed

#: Seeds tried; each fails with a small chance.
SEEDS = 100


@dataclass(frozen=True)
class BinaryFuse:
    """Slots of a filter, in ``segments`` + 2 segments of ``width`` slots."""

    seed: int
    width: int
    segments: int
    table: np.ndarray

    def contains(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key may be in the set; false is certain."""
        if not len(self.table):
            return np.zeros(len(keys), bool)
        places, prints = _places(keys, self.seed, self.width, self.segments)
        held = self.table[places]
        return held[:, 0] ^ held[:, 1] ^ held[:, 2] == prints


def _places(keys: np.ndarray, seed: int, width: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Three slots of each key, in consecutive segments, and its 8 bits."""
    h = mixed(keys.view(np.uint64) + mixed(np.array([seed], np.uint64)))
    first = ((h >> np.uint64(32)) * np.uint64(width * segments)) >> np.uint64(32)
    inside = np.uint64(width - 1)
    second = (first + np.uint64(width)) ^ (h >> np.uint64(18) & inside)
    third = (first + np.uint64(2 * width)) ^ (h & inside)
    prints = (mixed(h) & np.uint64(255)).astype(np.uint8)
    return np.stack([first, second, third], axis=1).astype(np.int64), prints


def build_filter(keys: np.ndarray) -> BinaryFuse:
    """The filter of a set of 64-bit keys; repeated keys count once."""
    keys = np.unique(keys)
    n = len(keys)
    if not n:
        return BinaryFuse(0, 1, 1, np.zeros(0, np.uint8))
    width = 1 << min(18, int(math.log(n) / math.log(3.33) + 2.25))
    share = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    segments = max(1, -(-int(n * share) // width) - 2)
    for seed in range(SEEDS):
        places, prints = _places(keys, seed, width, segments)
        peeled = _peel(places, (segments + 2) * width)
        if peeled is not None:
            table = np.zeros((segments + 2) * width, np.uint8)
            # keys of one round share no slot that any of them fills
            for which, slot in reversed(peeled):
                held = table[places[which]]
                table[slot] = prints[which] ^ held[:, 0] ^ held[:, 1] ^ held[:, 2]
            return BinaryFuse(seed, width, segments, table)
        if seed % 10 == 9:
            segments += 1 + segments // 8
    raise RuntimeError("no seed gives a filter")


def _peel(places: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Rounds of keys, each with a slot that no key of this or a later round uses; None if stuck."""
    n = len(places)
    count = np.bincount(places.ravel(), minlength=size)
    members = np.zeros(size, np.int64)
    np.bitwise_xor.at(members, places.ravel(), np.repeat(np.arange(n), 3))
    rounds, left = [], n
    alone = np.flatnonzero(count == 1)
    while len(alone):
        which, first = np.unique(members[alone], return_index=True)
        rounds.append((which, alone[first]))
        left -= len(which)
        touched = places[which].ravel()
        np.subtract.at(count, touched, 1)
        np.bitwise_xor.at(members, touched, np.repeat(which, 3))
        touched = np.unique(touched)
        alone = touched[count[touched] == 1]
    return rounds if left == 0 else None
