"""A minimal perfect hash over 64-bit keys, with fingerprints, in numpy.

Levels of bit sets: a key that is alone at its place on a level has its slot
there (the rank of its bit); the others go on to the next level.
"""

from __future__ import annotations

import numpy as np

_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A bijection of 64-bit values for each seed, with well spread bits."""
    x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 1000) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """``slots`` maps each of the n built keys to its own number below n.

    A key that was not built may get any number or -1; the fingerprint kept at
    the slot tells (all but one in 2**32 of) them apart.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels, self._ranks, self.size = levels, [], 0
        for bits in levels:
            ranks = np.cumsum(bits, dtype=np.int64) - bits + self.size
            self._ranks.append(ranks)
            self.size += int(bits.sum())

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """``keys``: distinct 64-bit integers."""
        left, levels = keys.astype(np.uint64), []
        while len(left):
            size = 2 * len(left) + 1
            at = (mix(left, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.astype(np.uint64)
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self._ranks)):
            at = (mix(keys[open_], level) % np.uint64(len(bits))).astype(np.int64)
            found = bits[at]
            out[open_[found]] = ranks[at[found]]
            open_ = open_[~found]
            if not len(open_):
                break
        return out

    def to_arrays(self) -> dict[str, np.ndarray]:
        sizes = np.array([len(b) for b in self.levels], np.int64)
        bits = [np.packbits(b) for b in self.levels]
        return {"sizes": sizes, "bits": np.concatenate(bits) if bits else np.zeros(0, np.uint8)}

    @classmethod
    def from_arrays(cls, arrays) -> PerfectHash:
        levels, at = [], 0
        for size in arrays["sizes"].tolist():
            n = (size + 7) // 8
            levels.append(np.unpackbits(arrays["bits"][at : at + n], count=size).astype(bool))
            at += n
        return cls(levels)
