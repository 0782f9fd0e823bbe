"""Benchmark decontamination: windows of normalised benchmark words, looked up in every window of every document.

The windows of the benchmark are dealt into shards of at most about SHARD_ROWS rows, however large the benchmark is, so
each broadcast has a known bound. One shard is one pass of the documents through a broadcast hash set; passes are chained
inside the same stage and each adds its hits, so no document is shuffled. A hit of the hash set is verified word by word.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablejobs.llm import flat

WINDOW = 10
# Benchmark windows in one broadcast; about 100 bytes each.
SHARD_ROWS = 200_000
_FILTER_BITS = 22
SPAN = "array<struct<start:bigint,stop:bigint>>"


def _lowered(data: np.ndarray) -> np.ndarray:
    return flat.LOWER[data]


def benchmark_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", width: int = WINDOW) -> DataFrame:
    """Distinct (item, n_words, window) of the benchmark; an item of fewer words than `width` is one window.

    The window is its words in lower case with one space between them. Items without words have no window; a NULL id
    counts as the empty string.
    """

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in flat.pieces(batches, "text"):
            data = _lowered(data)
            words = flat.Words(data, offsets, flat.LETTERS_AND_DIGITS)
            ids = batch.column("item").to_pylist()
            out: dict[str, list] = {"item": [], "n_words": [], "window": []}
            for d, item in enumerate(ids):
                low, high = words.first[d], words.first[d + 1]
                found = [data[words.starts[i] : words.ends[i]].tobytes().decode() for i in range(low, high)]
                n = min(width, len(found))
                for i in range(len(found) - n + 1 if n else 0):
                    out["item"].append(item)
                    out["n_words"].append(n)
                    out["window"].append(" ".join(found[i : i + n]))
            yield pa.RecordBatch.from_pydict(out, pa.schema([("item", pa.string()), ("n_words", pa.int32()), ("window", pa.string())]))

    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))
    return items.mapInArrow(step, "item string, n_words int, window string").distinct()


class _Shard:
    """Hash set of some windows: by number of words, sorted hashes, a bit filter, and the windows behind a hash."""

    def __init__(self, rows: list) -> None:
        windows: dict[str, list[int]] = {}
        self.items = sorted({r["item"] for r in rows})
        number = {item: i for i, item in enumerate(self.items)}
        widths: dict[int, list[str]] = {}
        for r in rows:
            if r["window"] not in windows:
                widths.setdefault(r["n_words"], []).append(r["window"])
            windows.setdefault(r["window"], []).append(number[r["item"]])
        self.owners = {w.encode(): np.unique(v) for w, v in windows.items()}
        self.tables: dict[int, tuple[np.ndarray, list[list[bytes]]]] = {}
        self.filters: dict[int, np.ndarray] = {}  # made by each worker
        for width, texts in widths.items():
            data, offsets = flat.raw(pa.array(texts, pa.string()))
            words = flat.Words(data, offsets, flat.LETTERS_AND_DIGITS)
            hashes = flat.window_hashes(words.hashes(), width)[words.first[:-1]]
            behind: dict[int, list[bytes]] = {}
            for h, t in zip(hashes.tolist(), texts):
                behind.setdefault(h, []).append(t.encode())
            order = sorted(behind)
            self.tables[width] = (np.array(order, np.uint64), [behind[h] for h in order])

    def hits(self, words: flat.Words, hashes: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first word, number of words, items) of each verified occurrence."""
        for width, (known, behind) in self.tables.items():
            if len(hashes) < width:
                continue
            h = flat.window_hashes(hashes, width)
            shift = np.uint64(64 - _FILTER_BITS)
            if width not in self.filters:
                self.filters[width] = np.zeros(1 << _FILTER_BITS, bool)
                self.filters[width][known >> shift] = True
            at = np.flatnonzero(self.filters[width][h >> shift] & flat.windows_inside(words.first, len(hashes), width))
            place = np.minimum(np.searchsorted(known, h[at]), len(known) - 1)
            same = known[place] == h[at]
            for i, k in zip(at[same].tolist(), place[same].tolist()):
                spelled = b" ".join(
                    words.data[a:b].tobytes() for a, b in zip(words.starts[i : i + width], words.ends[i : i + width])
                )
                if spelled in behind[k]:
                    yield i, width, self.owners[spelled]


def _pass(shared):
    """One pass of the documents through one shard; `__seen` and `__items` carry the hits of earlier passes."""

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = shared.value
        for batch, data, offsets in flat.pieces(batches, "__text"):
            words = flat.Words(_lowered(data), offsets, flat.LETTERS_AND_DIGITS)
            n, docs = len(words), len(offsets) - 1
            found = list(shard.hits(words, words.hashes()))
            starts = np.array([x[0] for x in found], np.int64)
            mask = flat.covered(starts, np.array([x[1] for x in found], np.int64), n)
            items: list[set[str]] = [set(x or ()) for x in batch.column("__items").to_pylist()]
            for (_, _, owners), d in zip(found, np.searchsorted(words.first, starts, "right") - 1):
                items[d].update(shard.items[k] for k in owners.tolist())
            for d, spans in enumerate(batch.column("spans").to_pylist()):
                for span in spans or ():
                    mask[words.first[d] + span["start"] : words.first[d] + span["stop"]] = True
            low, high = flat.runs(mask, words.first)
            where = np.searchsorted(words.first, low, "right") - 1
            base = words.first[where]
            spans = pa.StructArray.from_arrays([pa.array(low - base), pa.array(high - base)], ["start", "stop"])
            own = {
                "n_words": pa.array(words.counts.astype(np.int64)),
                "spans": flat.lists(spans, np.bincount(where, minlength=docs)),
                "__items": pa.array([sorted(x) for x in items], pa.list_(pa.string())),
            }
            names = [c for c in batch.schema.names if c not in own]
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), *own.values()], [*names, *own])

    return step


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WINDOW,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Every row of `docs` with `n_words`, `spans` (word ranges inside benchmark windows) and `items` (sorted ids).

    Words are runs of ASCII letters and digits and of all characters beyond ASCII, in lower case. NULL and empty texts
    have no words and no hits; an empty benchmark hits nothing. A column of the input with the name of an output
    column is replaced. Repeated documents and repeated items count each for itself and once.
    """
    windows = benchmark_windows(benchmark, item_id, item_text, width)
    shards = max(1, math.ceil(windows.count() / shard_rows))
    kept = [c for c in docs.columns if c not in ("n_words", "spans", "items")]
    frame = docs.select(
        *[F.col(f"`{c}`") for c in kept],
        F.col(f"`{text}`").alias("__text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast(SPAN).alias("spans"),
        F.array().cast("array<string>").alias("__items"),
    )
    order = [c for c in frame.columns if c not in ("n_words", "spans", "__items")] + ["n_words", "spans", "__items"]
    frame = frame.select(*[F.col(f"`{c}`") for c in order])
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in frame.schema.fields])
    number = F.pmod(F.xxhash64("item", "window"), F.lit(shards))
    for s in range(shards):
        rows = windows.filter(number == s).collect()
        shared = docs.sparkSession.sparkContext.broadcast(_Shard(rows))
        frame = frame.mapInArrow(_pass(shared), schema)
    return frame.select(*[F.col(f"`{c}`") for c in kept], "n_words", "spans", F.col("__items").alias("items"))


def remove_spans(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """`docs` with the words of `spans` cut out of `text`, each with the characters up to the next word.

    Texts without spans stay as they are, NULL included.
    """
    names = docs.columns

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in flat.pieces(batches, text):
            words = flat.Words(_lowered(data), offsets, flat.LETTERS_AND_DIGITS)
            texts = batch.column(text).to_pylist()
            for d, found in enumerate(batch.column(spans).to_pylist()):
                if not found or texts[d] is None:
                    continue
                whole, out, at = texts[d].encode(), [], 0
                starts = words.starts[words.first[d] : words.first[d + 1]] - offsets[d]
                for span in found:
                    out.append(whole[at : starts[span["start"]]])
                    at = starts[span["stop"]] if span["stop"] < len(starts) else len(whole)
                texts[d] = b"".join([*out, whole[at:]]).decode()
            columns = [pa.array(texts, batch.column(text).type) if c == text else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(step, docs.schema)
