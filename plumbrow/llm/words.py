"""Words of many texts at once: where they are, and 128-bit hashes of them, without a step a word."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import xxhash

from plumbrow.llm.common import SPACES
from plumbrow.llm.mph import mixed

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_TIMES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # odd
_LONG = 1 << 12
_PIECE = 1 << 20


def _powers(times: int) -> np.ndarray:
    out = np.full(_LONG, times, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS = tuple(_powers(t) for t in _TIMES)


class Words:
    """The words of some texts, one text after the other.

    chars: their bytes without spaces; sizes: of each word; ends: the first word after each text.
    """

    def __init__(self, texts: Sequence[bytes]):
        data = np.frombuffer(b" ".join(texts), np.uint8)
        is_space = _IS_SPACE[data]
        edges = np.flatnonzero(np.diff(is_space, prepend=True, append=True))
        starts, stops = edges[::2], edges[1::2]
        self.sizes = stops - starts
        self.chars = data[~is_space]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.searchsorted(starts, np.cumsum(lengths + 1) - 1)

    def __len__(self) -> int:
        return len(self.sizes)

    def hashes(self, n: int = 2) -> list[np.ndarray]:
        """One or two independent 64-bit hashes of each word."""
        out = [np.empty(len(self), np.uint64) for _ in range(n)]
        for first, last, a, z in self._pieces():
            sizes, chars = self.sizes[first:last], self.chars[a:z]
            begins = np.cumsum(sizes) - sizes
            place = np.arange(len(chars)) - np.repeat(begins, sizes)
            long = np.flatnonzero(sizes > _LONG)
            if len(long):
                place %= _LONG  # told apart below
            values = chars.astype(np.uint64) + np.uint64(1)
            for k in range(n):
                sums = np.add.reduceat(values * _POWERS[k][place], begins)
                out[k][first:last] = mixed(sums, k + 1) ^ mixed(sizes.astype(np.uint64), k + 3)
                for i in long:
                    word = chars[begins[i] : begins[i] + sizes[i]].tobytes()
                    out[k][first + i] = xxhash.xxh3_64_intdigest(word, seed=k)
        return out

    def _pieces(self) -> Iterator[tuple[int, int, int, int]]:
        """Stretches of words of about _PIECE bytes: first and last word, first and last byte."""
        ends = np.cumsum(self.sizes)
        first = at = 0
        while first < len(ends):
            last = max(first + 1, int(np.searchsorted(ends, at + _PIECE, "right")))
            yield first, last, at, int(ends[last - 1])
            first, at = last, int(ends[last - 1])

    def joined(self, kept: np.ndarray) -> list[bytes]:
        """Of each text, the words to keep, joined by one space."""
        chars = self.chars[np.repeat(kept, self.sizes)]
        sizes = self.sizes[kept]
        out = np.full(len(chars) + len(sizes), 0x20, np.uint8)
        out[np.arange(len(chars)) + np.repeat(np.arange(len(sizes)), sizes)] = chars
        before = np.concatenate(([0], np.cumsum(kept)))[np.concatenate(([0], self.ends))]
        bytes_before = np.concatenate(([0], np.cumsum(sizes + 1)))[before]
        data = out.tobytes()
        return [data[a : z - 1] if z > a else b"" for a, z in zip(bytes_before.tolist(), bytes_before[1:].tolist())]
