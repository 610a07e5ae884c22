"""Hashes of the words of whole Arrow batches, computed column-wise."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes whose hash is summed at once; words stay whole.
BLOCK = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit words."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int, base: np.uint64 = _ODD) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


def _signs(lower: bool) -> np.ndarray:
    signs = np.arange(256, dtype=np.uint64)
    if lower:
        signs[65:91] += np.uint64(32)
    with np.errstate(over="ignore"):
        return mixed((signs + np.uint64(1)) * _ODD)


@dataclass
class Words:
    """The words of a batch of texts: a hash each, and where each text's words begin."""

    hashes: np.ndarray
    first: np.ndarray  # one more than there are texts

    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def fitting(self, size: int) -> np.ndarray:
        """Positions from which `size` words lie in one text."""
        left = np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self.hashes))
        return np.flatnonzero(left >= size)

    def runs(self, size: int) -> np.ndarray:
        """Hashes of `size` successive words from every position; those that pass the batch's end are missing."""
        n = len(self.hashes) - size + 1
        out = np.full(max(0, n), size, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(size if n > 0 else 0):
                out = mixed(out * _ODD + self.hashes[i:n + i])
        return out

    def sums(self) -> np.ndarray:
        """Weighted sums up to each position, from which `between` takes the hash of any stretch of words."""
        with np.errstate(over="ignore"):
            return np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.hashes * _tables(len(self.hashes))[0][:len(self.hashes)], dtype=np.uint64)])


def between(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the words from `start` up to `end`, wherever they stand."""
    with np.errstate(over="ignore"):
        return mixed((sums[end] - sums[start]) * _tables(len(sums))[1][start] + (end - start).astype(np.uint64) * _ODD)


def words_of(column: pa.Array, lower: bool = False) -> Words:
    """Words `[^\\x20\\x09-\\x0D]+` of each text, if `lower` with A-Z in lower case; a null text has none."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return Words(np.zeros(0, np.uint64), np.zeros(1, np.int64))
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    inside = ~_BLANK[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return Words(np.zeros(0, np.uint64), first)
    signs, out = np.where(_BLANK, np.uint64(0), _signs(lower)), np.zeros(len(starts), np.uint64)
    upto = np.append(starts[1:], len(data))
    cuts = np.searchsorted(starts, np.arange(0, len(data) + BLOCK, BLOCK))
    with np.errstate(over="ignore"):
        for low, high in zip(cuts[:-1], cuts[1:]):
            if low == high:
                continue
            own = starts[low:high] - starts[low]
            ends = upto[low:high] - starts[low]
            up, down = _tables(int(ends[-1]))
            sums = np.concatenate([np.zeros(1, np.uint64), signs[data[starts[low]:upto[high - 1]]]])
            sums[1:] *= up[:len(sums) - 1]
            np.cumsum(sums, out=sums)
            out[low:high] = (sums[ends] - sums[own]) * down[own]
        return Words(mixed(out), first)


_KEPT: list[np.ndarray] = []


def _tables(n: int) -> list[np.ndarray]:
    """Powers and inverse powers, kept for blocks of the usual size."""
    if n > 2 * BLOCK:
        return [powers(n), powers(n, _BACK)]
    if not _KEPT:
        _KEPT.extend((powers(2 * BLOCK), powers(2 * BLOCK, _BACK)))
    return _KEPT
