"""A minimal perfect hash over distinct 64-bit keys, in levels of bit arrays.

Each level hashes the keys that are left into an array of `GAMMA` bits a key; keys that are alone at
their place keep it, the others go on to the next level. A key's slot is the number of set bits before
its own over all levels, so n keys get the slots 0 to n - 1 at about three bits a key and some numbers
for the counts. Keys outside the set get some slot or none: callers compare fingerprints.
"""

from __future__ import annotations

import struct

import numpy as np

GAMMA = 2.0
_MOST_LEVELS = 40


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mix of unsigned keys by multiplications and shifts."""
    x = keys ^ np.uint64((seed * 0xD1B54A32D192ED03 + 0x8CB92BA72F3D8DD7) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xAEF17502108EF2D9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xF1357AEA2E62A9C5)
    return x ^ (x >> np.uint64(32))


class PerfectHash:
    def __init__(self, n: int, levels: list[np.ndarray], rest: np.ndarray):
        self.n = n
        self._levels = levels  # words of 64 bits
        self._rest = rest  # keys that no level could part, sorted
        self._before, total = [], 0
        for words in levels:
            counts = np.bitwise_count(words).astype(np.int64)
            self._before.append(total + np.concatenate(([0], np.cumsum(counts)[:-1])))
            total += int(counts.sum())
        self._placed = total

    @staticmethod
    def build(keys: np.ndarray) -> PerfectHash:
        """keys: distinct."""
        levels, left = [], keys
        while len(left) and len(levels) < _MOST_LEVELS:
            n_words = max(1, int(len(left) * GAMMA) // 64 + 1)
            place = mixed(left, len(levels)) % np.uint64(64 * n_words)
            alone = np.bincount(place.astype(np.int64), minlength=64 * n_words) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8").astype(np.uint64))
            left = left[~alone[place.astype(np.int64)]]
        return PerfectHash(len(keys), levels, np.sort(left))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for some keys outside the set."""
        found = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for i, words in enumerate(self._levels):
            if not len(open_):
                break
            place = mixed(keys[open_], i) % np.uint64(64 * len(words))
            word, bit = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            hit = (words[word] >> bit) & np.uint64(1) == 1
            below = words[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            found[open_[hit]] = self._before[i][word[hit]] + np.bitwise_count(below)
            open_ = open_[~hit]
        if len(open_) and len(self._rest):
            at = np.searchsorted(self._rest, keys[open_]).clip(max=len(self._rest) - 1)
            hit = self._rest[at] == keys[open_]
            found[open_[hit]] = self._placed + at[hit]
        return found

    def to_bytes(self) -> bytes:
        sizes = [len(x) for x in self._levels] + [len(self._rest)]
        head = struct.pack("<qI", self.n, len(sizes)) + np.array(sizes, "<u8").tobytes()
        return head + b"".join(x.astype("<u8").tobytes() for x in [*self._levels, self._rest])

    @staticmethod
    def from_bytes(data: bytes) -> PerfectHash:
        n, n_sizes = struct.unpack_from("<qI", data)
        sizes = np.frombuffer(data, "<u8", n_sizes, 12).astype(np.int64)
        words = np.frombuffer(data, "<u8", int(sizes.sum()), 12 + 8 * n_sizes).astype(np.uint64)
        parts = np.split(words, np.cumsum(sizes)[:-1])
        return PerfectHash(n, parts[:-1], parts[-1])
