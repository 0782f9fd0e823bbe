"""Words, hashes and windows of many texts at once, as flat arrays over the bytes of an Arrow column.

A column of texts is one run of UTF-8 bytes with offsets. Word bounds, word hashes and hashes of word windows are
computed for all texts of a piece together, without a Python loop over words. Pieces are cut at documents, so a piece
holds at least one whole document and at most `limit` bytes beyond it.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1_000_000
_MASK = (1 << 64) - 1
_WORD_BASE = 0xD1342543DE82EF95
_GROUP = 8
# Masks of the first 0 .. 8 bytes of a little-endian 64-bit number.
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(_GROUP + 1)], np.uint64)

_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        known = _POWERS[base] = np.cumprod(steps)
    return known[:n]


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def byte_class(*inside: tuple[int, int]) -> np.ndarray:
    """Table of the bytes that belong to a word, from ranges (first, last)."""
    table = np.zeros(256, bool)
    for first, last in inside:
        table[first : last + 1] = True
    return table


NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
LETTERS_AND_DIGITS = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; NULL counts as empty."""
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    found = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return found[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(
    batches: Iterable[pa.RecordBatch], text: str, limit: int = PIECE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row slices of the batches with the bytes and offsets of their texts."""
    for batch in batches:
        data, offsets = raw(batch.column(text))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            low, high = offsets[start], offsets[stop]
            yield batch.slice(start, stop - start), data[low:high], offsets[start : stop + 1] - low
            start = stop
        data = offsets = None
        release()


@functools.cache
def _trim():
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):  # another C library
        return None


def release() -> None:
    """Gives freed memory back to the system: idle Python workers stay around beside the busy ones."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values; one-to-one."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(32)
    return h


def distinct_sorted(values: np.ndarray) -> np.ndarray:
    """The distinct values in ascending order. `numpy.unique` hashes them first, which takes many times as long."""
    values = np.sort(values)
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return values[new]


class Words:
    """Word bounds of a piece: `starts` and `ends` in bytes, `first[d] .. first[d + 1]` the words of document d."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> None:
        self.data, self.offsets = data, offsets
        mask = inside[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.zeros(len(data), bool)
        before[1:] = mask[:-1]
        before &= ~edge[:-1]
        self.starts = np.flatnonzero(mask & ~before)
        after = np.zeros(len(data), bool)
        after[:-1] = mask[1:]
        after &= ~edge[1:]
        self.ends = np.flatnonzero(mask & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)

    @classmethod
    def between(cls, data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Words:
        """Words of given bounds."""
        own = cls.__new__(cls)
        own.data, own.offsets, own.starts, own.ends = data, offsets, starts, ends
        own.first = np.searchsorted(starts, offsets)
        own.counts = np.diff(own.first)
        return own

    def __len__(self) -> int:
        return len(self.starts)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes.

        Groups of eight bytes are mixed with their place in the word, which is not linear, and added up. Words of up to eight
        bytes and of one length never share a hash.
        """
        sizes = self.ends - self.starts
        length = sizes.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
        if not len(sizes):
            return length
        padded = np.concatenate([self.data, np.zeros(_GROUP, np.uint8)])
        at_byte = np.ndarray(len(self.data) + 1, "<u8", padded.data, strides=(1,))
        h = mix(at_byte[self.starts] & _FIRST_BYTES[np.minimum(sizes, _GROUP)])
        long = np.flatnonzero(sizes > _GROUP)
        if len(long):
            more = (sizes[long] - 1) // _GROUP
            first = np.cumsum(more) - more
            place = np.arange(int(more.sum())) - np.repeat(first, more) + 1
            start = np.repeat(self.starts[long], more) + _GROUP * place
            left = np.minimum(np.repeat(self.ends[long], more) - start, _GROUP)
            groups = mix((at_byte[start] & _FIRST_BYTES[left]) ^ mix(place.astype(np.uint64) * np.uint64(_WORD_BASE)))
            h[long] += np.add.reduceat(groups, first)
        return mix(h + length)


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each run of `width` words; runs may cross documents, see `windows_inside`."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * _powers(_WORD_BASE, len(h)), out=total[1:])
    found = (total[width:] - total[:n]) * _powers(_inverse(_WORD_BASE), n)
    return mix(found + np.uint64(width * 0xE7037ED1A0B428DB & _MASK))


def windows_inside(first: np.ndarray, n: int, width: int) -> np.ndarray:
    """Which of the n - width + 1 runs lie inside one document."""
    inside = np.ones(max(n - width + 1, 0), bool)
    for end in first[1:-1]:
        inside[max(end - width + 1, 0) : end] = False
    return inside


def covered(starts: np.ndarray, widths: np.ndarray | int, n: int) -> np.ndarray:
    """Words of 0 .. n - 1 that lie in one of the runs."""
    steps = np.bincount(starts, minlength=n + 1)[: n + 1].astype(np.int64)
    steps -= np.bincount(np.asarray(starts) + widths, minlength=n + 1)[: n + 1]
    return np.cumsum(steps)[:n] > 0


def runs(mask: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs (start, stop) of True words, cut at documents."""
    n = len(mask)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[first] = True
    before = np.zeros(n, bool)
    before[1:] = mask[:-1]
    after = np.zeros(n, bool)
    after[:-1] = mask[1:]
    return np.flatnonzero(mask & (~before | edge[:-1])), np.flatnonzero(mask & (~after | edge[1:])) + 1


def lists(values: pa.Array, sizes: np.ndarray) -> pa.Array:
    """A list column from flat values and the length of each list."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
