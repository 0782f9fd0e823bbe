"""Sorted sets of 64-bit keys as short binary values, dealt into ranges of the key space.

Rows of single keys cost a shuffle far more than the keys themselves. A batch of documents sends one value for each range
instead: its distinct keys in order, as differences of the fewest bytes that hold them. Because a batch sends each key
once, a key that every document has costs one entry for each batch. An answer about the keys is one bit for each, in the
same order, since a batch finds its own keys again.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_BYTES = 8_000_000


def number_of_batches(docs: DataFrame, text: str) -> int:
    """Batches of about BATCH_BYTES of text, at least two for each core."""
    total = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`").cast("string")))).first()[0] or 0
    return max(math.ceil(total / BATCH_BYTES), 2 * docs.sparkSession.sparkContext.defaultParallelism)


def range_bounds(keys: np.ndarray, ranges: int, bits: int) -> np.ndarray:
    """Where each of the `ranges` equal parts of the key space begins in sorted keys of `bits` bits."""
    part = ((keys >> np.uint64(bits - 32)) * np.uint64(ranges)) >> np.uint64(32)
    return np.searchsorted(part, np.arange(ranges + 1, dtype=np.uint64))


def pack_numbers(values: np.ndarray) -> bytes:
    """Non-negative numbers in as few bytes each as the largest one needs; the first byte says how many."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return bytes([width]) + values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack_numbers(data: bytes) -> np.ndarray:
    width = data[0]
    body = np.frombuffer(data, np.uint8, offset=1).reshape(-1, width)
    whole = np.zeros((len(body), 8), np.uint8)
    whole[:, :width] = body
    return whole.reshape(-1).view("<u8").astype(np.uint64)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted keys: the first one, then the differences."""
    if not len(keys):
        return b""
    return int(keys[0]).to_bytes(8, "little") + pack_numbers(np.diff(keys))


def unpack_sorted(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    steps = unpack_numbers(data[8:])
    return np.cumsum(np.concatenate([np.frombuffer(data[:8], "<u8"), steps]), dtype=np.uint64)


def pack_bits(mask: np.ndarray) -> bytes:
    return np.packbits(mask).tobytes()


def unpack_bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def order_of(keys: np.ndarray, bits: int = 64) -> np.ndarray:
    """Positions of the keys (of `bits` bits) in ascending order, equal keys in theirs.

    Sorting values is much faster than sorting positions. So the leading bits of a key are sorted with its position in the
    place of the others; where keys differ in these others only, positions are sorted after all.
    """
    spare = max(len(keys) - 1, 1).bit_length()
    shift = np.uint64(64 - bits)
    low = np.uint64((1 << spare) - 1)
    ranked = np.sort(((keys << shift) & ~low) | np.arange(len(keys), dtype=np.uint64))
    order = (ranked & low).astype(np.int64)
    found = keys[order]
    if ((found[1:] != found[:-1]) & ((ranked[1:] ^ ranked[:-1]) <= low)).any():
        return np.argsort(keys, kind="stable")
    return order


class Groups:
    """Equal keys brought together: `keys` distinct and sorted, `order` the positions by key, `begins` of each group."""

    def __init__(self, keys: np.ndarray, bits: int = 64) -> None:
        self.order = order_of(keys, bits)
        ranked = keys[self.order]
        new = np.ones(len(keys), bool)
        new[1:] = ranked[1:] != ranked[:-1]
        self.begins = np.flatnonzero(new)
        self.keys = ranked[self.begins]
        self._new = new

    def reduce(self, operation: np.ufunc, values: np.ndarray) -> np.ndarray:
        return operation.reduceat(values[self.order], self.begins) if len(self.begins) else values[:0]

    def sizes(self) -> np.ndarray:
        return np.diff(np.append(self.begins, len(self.order)))

    def spread(self, values: np.ndarray) -> np.ndarray:
        """A value of each group, at the positions of its keys."""
        out = np.empty(len(self.order), values.dtype)
        out[self.order] = values[np.cumsum(self._new) - 1]
        return out
