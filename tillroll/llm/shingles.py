"""Hashes of words and of word shingles, for a whole chunk of texts at once."""

from __future__ import annotations

import numpy as np

SIZE = 5
CHUNK = 2 << 20  # bytes of text that are hashed at once

U = np.uint64
_RNG = np.random.default_rng(20240611)
BASE = U(0x9E3779B97F4A7C15)
_BACK = U(pow(int(BASE), -1, 1 << 64))
_PLACE = _RNG.integers(1, 1 << 63, SIZE, dtype=np.uint64) * U(2) + U(1)
_SHORT = 0xD6E8FEB86659FD93

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers = {U(1): np.ones(1, U)}


def power(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, CHUNK + 1), base, U)
        steps[0] = 1
        known = np.multiply.accumulate(steps)
        if n <= CHUNK + 1:
            _powers[base] = known
    return known[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, in order, with A-Z in lower case; the number of words of each text."""
    data = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    space = _SPACE[data]
    before = np.empty_like(space)
    before[0], before[1:] = True, space[:-1]
    starts = np.flatnonzero(before & ~space)
    ends = np.flatnonzero(space & ~before)
    # A word's polynomial is a difference of prefix sums, moved to power 0.
    total = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * power(BASE, len(data)), out=total[1:])
    words = mixed((total[ends] - total[starts]) * power(_BACK, len(data))[starts])
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return words, np.diff(np.searchsorted(starts, bounds))


def shingle_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every shingle in order, with repeats, and the number of shingles of each text.

    A text of one to four words has one shingle, all of its words; a text without words has none.
    """
    words, counts = word_hashes(texts)
    sizes = np.where(counts >= SIZE, counts - SIZE + 1, np.minimum(counts, 1))
    offsets = np.cumsum(counts) - counts
    out_starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), U)
    if len(words) >= SIZE:
        sums = np.zeros(len(words) - SIZE + 1, U)
        for k in range(SIZE):
            sums += words[k : k + len(sums)] * _PLACE[k]
        long = np.flatnonzero(counts >= SIZE)
        within = np.arange(int(sizes[long].sum())) - np.repeat(
            np.cumsum(sizes[long]) - sizes[long], sizes[long]
        )
        out[np.repeat(out_starts[long], sizes[long]) + within] = sums[
            np.repeat(offsets[long], sizes[long]) + within
        ]
    for n in range(1, SIZE):
        short = np.flatnonzero(counts == n)
        whole = np.full(len(short), U(n * _SHORT % (1 << 64)), U)
        for k in range(n):
            whole += words[offsets[short] + k] * _PLACE[k]
        out[out_starts[short]] = whole
    return mixed(out), sizes


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, sizes = shingle_hashes(texts)
    ends = np.cumsum(sizes)
    return [np.unique(hashes[end - size : end]) for end, size in zip(ends, sizes, strict=True)]


def seeds(n: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Constants of ``n`` hash functions ``(x ^ c) * m``."""
    rng = np.random.default_rng(salt)
    flips = rng.integers(0, 1 << 63, n, dtype=np.uint64) * U(2) + rng.integers(0, 2, n, dtype=np.uint64)
    return flips, rng.integers(0, 1 << 63, n, dtype=np.uint64) * U(2) + U(1)
