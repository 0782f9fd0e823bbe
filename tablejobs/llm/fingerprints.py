"""Document fingerprints by locally consistent parsing.

A text is parsed in levels until one phrase is left. On each level, runs of equal symbols become one symbol; deterministic
coin tossing compares each symbol with the one before it until the labels are below six; symbols whose label is larger than
both neighbours' begin a phrase, as does the first one of a text; the last one begins none. A phrase's name is a hash of its
symbols, and the names are the symbols of the next level. Where a phrase begins depends on a few symbols around it only, so
equal substrings get the same names inside, wherever they lie.

The fingerprint of a text holds, for each level, the SKETCH smallest of its distinct names, as hexadecimal text with a dash
between levels. Two fingerprints are compared level by level: twice the common names over all names (1 for equal sets, 0 for
disjoint ones). From the finest level up, a level of n names (SKETCH at most) counts n ** 2 parts against SKETCH ** 2 parts of
what the finer levels say: large phrases decide where a text has many of them; where it has few, most of these reach over an
edge of what is shared, and small ones decide. The rule is the same for all lengths.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import zip_longest

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablejobs.llm import flat, packed

SKETCH = 64
_NAME_BYTES = 5
_PIECE_BYTES = 500_000

_LOWEST = np.array([(x & -x).bit_length() - 1 if x else 0 for x in range(256)], np.uint8)
_PLACES = flat.mix(np.arange(1, 1 << 12, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _toss(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Twice the lowest bit that differs from the symbol before, plus this bit; at the first symbol of a text, bit 0."""
    different = np.empty_like(symbols)
    different[1:] = symbols[1:] ^ symbols[:-1]
    different[first] = 1
    if symbols.dtype == np.uint8:
        low = _LOWEST[different]
    else:
        low = np.bitwise_count((different & (~different + np.uint64(1))) - np.uint64(1))
    bit = ((symbols >> low) & symbols.dtype.type(1)).astype(np.uint8)
    return (low << np.uint8(1)) + bit


def _phrases(symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of texts that begin at `first`, and where the texts begin among them."""
    begins = np.zeros(len(symbols), bool)
    begins[first] = True
    new = begins.copy()
    new[1:] |= symbols[1:] != symbols[:-1]
    head = np.flatnonzero(new)
    length = np.diff(np.append(head, len(symbols))).astype(np.uint64)
    symbols, begins = symbols[head], begins[head]
    start = np.flatnonzero(begins)
    label = _toss(symbols, start)
    for _ in range(2 if symbols.dtype == np.uint8 else 3):
        label = _toss(label, start)
    top = np.zeros(len(label), bool)
    top[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    top[start[1:] - 1] = False
    top[start] = True
    mark = np.flatnonzero(top)
    place = np.arange(len(label)) - np.repeat(mark, np.diff(np.append(mark, len(label))))
    value = flat.mix(symbols.astype(np.uint64) + length * np.uint64(0xC2B2AE3D27D4EB4F))
    names = flat.mix(np.add.reduceat(flat.mix(value ^ _PLACES[np.minimum(place, len(_PLACES) - 1)]), mark))
    return names, np.flatnonzero(begins[mark])


def sketches(texts: list[bytes]) -> list[list[np.ndarray]]:
    """The sorted names in the fingerprint of each text, by level; no level for an empty text."""
    out: list[list[np.ndarray]] = [[] for _ in texts]
    left = np.array([i for i, t in enumerate(texts) if t], np.int64)
    symbols = np.frombuffer(b"".join(texts), np.uint8)
    first = np.cumsum([0, *(len(texts[i]) for i in left.tolist())])[:-1]
    while len(left):
        symbols, first = _phrases(symbols, first)
        sizes = np.diff(np.append(first, len(symbols)))
        doc = np.repeat(np.arange(len(left), dtype=np.uint64), sizes)
        names = flat.distinct_sorted((doc << np.uint64(8 * _NAME_BYTES)) | (symbols >> np.uint64(64 - 8 * _NAME_BYTES)))
        bounds = np.searchsorted(names, np.arange(len(left) + 1, dtype=np.uint64) << np.uint64(8 * _NAME_BYTES)).tolist()
        names &= np.uint64((1 << 8 * _NAME_BYTES) - 1)
        for n, i in enumerate(left.tolist()):
            out[i].append(names[bounds[n] : min(bounds[n + 1], bounds[n] + SKETCH)])
        more = sizes > 1
        symbols = symbols[np.repeat(more, sizes)]
        left, sizes = left[more], sizes[more]
        first = np.cumsum(sizes) - sizes
    return out


def spelled(sketch: list[np.ndarray]) -> str:
    return "-".join(n.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - _NAME_BYTES :].tobytes().hex() for n in sketch)


def read(fingerprint: str) -> list[list[int]]:
    """The names of each level."""
    width = 2 * _NAME_BYTES
    levels = fingerprint.split("-") if fingerprint else []
    return [[int(names[i : i + width], 16) for i in range(0, len(names), width)] for names in levels]


def likeness(a: str, b: str) -> float:
    """How alike the texts of two fingerprints are, from 0 to 1; two empty texts are alike."""
    return _alike(read(a), read(b))


def _alike(a: list[list[int]], b: list[list[int]]) -> float:
    if a == b:
        return 1.0
    found = None
    for x, y in zip_longest(a, b, fillvalue=()):
        union = sorted({*x, *y})[:SKETCH]
        both = len({*union}.intersection(x).intersection(y))
        alike, n = 2 * both / (len(union) + both), len(union)
        found = alike if found is None else (n**2 * alike + SKETCH**2 * found) / (n**2 + SKETCH**2)
    return found


def fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """`docs` with the fingerprint of `text`; NULL and empty texts have the empty one, equal texts an equal one."""
    others = [c for c in docs.columns if c != name]

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, _ in flat.pieces(batches, text, _PIECE_BYTES):
            found = [spelled(s) for s in sketches([(t or "").encode() for t in batch.column(text).to_pylist()])]
            yield pa.RecordBatch.from_arrays([*map(batch.column, others), pa.array(found, pa.string())], [*others, name])

    plain = docs.select(*[F.col(f"`{c}`") for c in others])
    return plain.mapInArrow(step, plain.withColumn(name, F.lit("").cast("string")).schema)


_DRIFT = "id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited_neighbours(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next) of every document.

    The next document is that of the next smaller id; after the smallest comes the largest. `edited` is the text with its
    last n_chars // 3 code points replaced by the first as many (or all) of the next text. NULL counts as empty. Rows of
    equal ids follow each other in the order of their texts; a NULL id is the smallest. A single document is its own next.

    Ids are cut into parts of like size; a part is read in order as a stream. The first document of a part is sent to
    the part before it as well, so no part waits for another one. Texts are shuffled once, compressed.
    """
    parts = packed.number_of_batches(docs, text)
    frame = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    cuts = [i / parts for i in range(1, parts)]
    found = frame.agg(F.percentile_approx("id", F.array(*map(F.lit, cuts or [0.5])), F.lit(max(10_000, 4 * parts)))).first()[0]
    bounds = np.unique(np.array(found or [], np.int64))
    # The smallest id that is larger than any of the part before: parts go down, bounds[0] closes the last one.
    number = lambda ids: len(bounds) - np.searchsorted(bounds, ids, "left")

    def parted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id")
            place = number(ids.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([ids, pa.array(place)], ["id", "part"])

    # One row for each part: where it begins and whether only NULL ids are in it.
    narrow = frame.select("id").mapInArrow(parted, "id long, part int")
    tops = sorted((r["part"], r["top"]) for r in narrow.groupBy("part").agg(F.max("id").alias("top")).collect())
    before: dict[int | None, list[int]] = {}
    for n, (_, top) in enumerate(tops):
        before.setdefault(top, []).append(tops[n - 1][0])

    def dealt(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch, _, _ in flat.pieces(batches, "text", 4_000_000):
            ids = batch.column("id")
            place = number(ids.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)).tolist()
            rows: list[tuple] = []
            for doc, part, body in zip(ids.to_pylist(), place, batch.column("text").to_pylist()):
                small = squeeze((body or "").encode())
                rows.append((part, False, doc, small))
                rows += [(p, True, doc, small) for p in before.get(doc, ())]
            kinds = [pa.int32(), pa.bool_(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["part", "carried", "id", "text"])

    def compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grow = zstandard.ZstdDecompressor().decompress
        held: list[tuple[int | None, str]] = []
        part, size, closed = None, 0, False
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("part", "carried", "id", "text")]
            for here, carried, doc, small in zip(*columns):
                if here != part:
                    part, held, size, closed = here, [], 0, False
                if closed:
                    continue
                body = grow(small).decode()
                held.append((doc, body))
                size += len(body)
                closed = carried
                if len(held) > 1 and (carried or size > _PIECE_BYTES):
                    yield _compared(held)
                    held, size = held[-1:], len(body)

    sent = frame.mapInArrow(dealt, "part int, carried boolean, id long, text binary")
    ordered = sent.repartition(parts, "part").sortWithinPartitions("part", "carried", F.col("id").desc_nulls_last(), "text")
    return ordered.mapInArrow(compared, _DRIFT).withColumnRenamed("id", id)


def _compared(held: list[tuple[int | None, str]]) -> pa.RecordBatch:
    """The row of each document but the last, which is the next of the one before it."""
    texts = [t for _, t in held]
    edited = [a[: len(a) - len(a) // 3] + b[: len(a) // 3] for a, b in zip(texts, texts[1:])]
    own, new = sketches([t.encode() for t in texts]), sketches([t.encode() for t in edited])
    own_names, new_names = ([[n.tolist() for n in s] for s in kind] for kind in (own, new))
    columns = [
        pa.array([d for d, _ in held[:-1]], pa.int64()),
        pa.array([len(t) for t in texts[:-1]], pa.int64()),
        pa.array(edited, pa.string()),
        pa.array([spelled(s) for s in own[:-1]], pa.string()),
        pa.array([spelled(s) for s in new], pa.string()),
        pa.array([_alike(a, b) for a, b in zip(own_names, new_names)], pa.float64()),
        pa.array([_alike(a, b) for a, b in zip(own_names, own_names[1:])], pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
