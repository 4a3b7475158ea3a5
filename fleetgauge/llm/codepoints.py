"""Texts as numpy arrays of code points: letters, words and subwords without a loop over them."""

from __future__ import annotations

from functools import cache

import numpy as np

SPACE = np.uint32(32)
BASE = np.uint64(0x9E3779B97F4A7C15)


@cache
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def letters_of(text: str) -> np.ndarray:
    """Lower-cased letters, with one space before, after and between runs of them."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(_is_letter()[points], points, SPACE)
    points = np.concatenate([[SPACE], points, [SPACE]]).astype(np.uint32)
    blank = points == SPACE
    return points[~(blank & np.concatenate([[False], blank[:-1]]))]


def mixed(values: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit hash of 64-bit numbers."""
    x = values.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def subword_hashes(points: np.ndarray, sizes: tuple[int, ...]) -> np.ndarray:
    """Hashes of the runs of each size within words, with the space at a word's end or start."""
    out, blank = [], points == SPACE
    for n in sizes:
        m = len(points) - n + 1
        if m <= 0:
            continue
        code, inner = np.zeros(m, np.uint64), np.zeros(m, bool)
        for k in range(n):
            code = code * BASE + points[k:k + m]
            if 0 < k < n - 1:
                inner |= blank[k:k + m]
        if n <= 2:
            inner |= blank[:m] & blank[n - 1:n - 1 + m]
        out.append(mixed(code + np.uint64(n))[~inner])
    return np.concatenate(out) if out else np.array([], np.uint64)


def word_hashes(points: np.ndarray, beginning: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each word and of its first ``beginning`` letters: differences of prefix sums."""
    blank = np.flatnonzero(points == SPACE)
    if len(blank) < 2:
        return np.array([], np.uint64), np.array([], np.uint64)
    starts, ends = blank[:-1] + 1, blank[1:]
    # the place in its word gives the power, so that equal words have equal sums
    place = np.arange(len(points)) - np.repeat(blank, np.diff(np.r_[blank, len(points)]))
    powers = np.cumprod(np.r_[np.uint64(1), np.full(place.max() + 1, BASE)], dtype=np.uint64)
    sums = np.r_[np.uint64(0), np.cumsum(mixed(points.astype(np.uint64)) * powers[place],
                                         dtype=np.uint64)]
    short = np.minimum(starts + beginning, ends)
    return mixed(sums[ends] - sums[starts]), mixed(sums[short] - sums[starts])
