"""Words of a batch of texts as numpy codes, for the Arrow operators of this package.

A word is a run of characters other than the ASCII blanks 0x09-0x0D and 0x20. Batches are cut by
bytes, so one task holds a few MB of text and what is derived from it, however long its partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that are worked on at once.
SLICE_BYTES = 2 << 20

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def byte_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) in runs of about `limit` bytes, at least one row each; nulls as ''."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    row = 0
    while row < len(texts):
        base = ends[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, base + limit, "right")))
        # take() copies the slice, so that offsets start at 0 and the buffers are its own
        yield row, texts.slice(row, stop - row).take(pa.array(np.arange(stop - row)))
        row = stop
    # a worker stays for later tasks: what this batch needed goes back to the system
    pa.default_memory_pool().release_unused()


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a text array without nulls, as made by `byte_slices`."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4)
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets.astype(np.int64), whole


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of `values` between consecutive offsets; empty runs give 0."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


@dataclass
class Words:
    """codes[offsets[i]:offsets[i+1]] are row i's words as positions in `dictionary`."""

    codes: np.ndarray
    offsets: np.ndarray
    dictionary: pa.Array

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    @property
    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        values = self.dictionary.to_pylist()
        known = np.fromiter((xxhash.xxh64_intdigest(w) for w in values), np.uint64, len(values))
        return known[self.codes] if len(values) else np.zeros(0, np.uint64)

    def windows(self, n: int) -> np.ndarray:
        """Positions of the words that start an n-word window within their row."""
        ends = np.repeat(self.offsets[1:], self.counts)
        at = np.arange(len(self.codes))
        return at[at + n <= ends]


def split_words(texts: pa.Array) -> Words:
    """Words of texts without nulls."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    offsets = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = offsets - offsets[0]
    filled = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0  # blanks at an end give ''
    if not filled.all():
        kept = np.zeros(len(filled) + 1, np.int64)
        np.cumsum(filled, out=kept[1:])
        offsets = kept[offsets]
        flat = flat.filter(pa.array(filled))
    coded = flat.dictionary_encode()
    return Words(coded.indices.to_numpy().astype(np.int64), offsets, coded.dictionary)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values, after which every bit depends on all."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def window_hashes(h: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of the n words from each start; the order of words counts."""
    out = np.zeros(len(starts), np.uint64)
    for k in range(n):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[starts + k])
    return out


#: Odd, so that it has an inverse among 64-bit numbers.
_RADIX = 0x9E3779B97F4A7C15


class RollingHash:
    """Hashes of windows of any length over one sequence, each from two prefix sums.

    A window's value is the polynomial of its elements in a fixed radix, whatever its place.
    """

    def __init__(self, h: np.ndarray):
        n = len(h)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(h * self._powers(_RADIX, n), out=self.prefix[1:])
        self.back = self._powers(pow(_RADIX, -1, 1 << 64), n)

    @staticmethod
    def _powers(radix: int, n: int) -> np.ndarray:
        out = np.full(n, radix, np.uint64)
        out[:1] = 1
        return np.multiply.accumulate(out)

    def windows(self, starts: np.ndarray, n: int) -> np.ndarray:
        """The hash of the n elements from each start."""
        return mixed((self.prefix[starts + n] - self.prefix[starts]) * self.back[starts])


def repeated(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs more than once."""
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(twice, keys)
    return twice[np.minimum(at, len(twice) - 1)] == keys
