"""Word hashes of many texts at once, with numpy."""

from __future__ import annotations

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finishing step, so that all bits of a hash depend on all bits of ``h``."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHashes:
    """64-bit hashes of the words of texts; words are runs without ASCII white space, A-Z lower-cased.

    A word's hash is a polynomial of its bytes, got from running sums over the whole block, so its
    cost is a few array operations per byte whatever the words.
    """

    def __init__(self):
        self.powers, self.inverses = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            size = n + n // 8
            steps = lambda b: np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]), dtype=np.uint64)
            self.powers, self.inverses = steps(BASE), steps(INVERSE)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words in order, and the number of words of each text."""
        data = np.frombuffer(b"\n".join(texts).lower() + b"\n", np.uint8)
        self._grow(len(data) + 1)
        space = SPACE[data]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if not space[0]:
            edge = np.concatenate(([0], edge))
        starts, ends = edge[0::2], edge[1::2]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.add(data, np.uint64(1), out=sums[1:])
        sums[1:] *= self.powers[:len(data)]
        np.cumsum(sums[1:], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * self.inverses[starts])
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        bounds = np.searchsorted(starts, np.concatenate(([0], np.cumsum(lengths))))
        return hashes, np.diff(bounds)
