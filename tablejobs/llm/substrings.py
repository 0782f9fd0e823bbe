"""Exact substring removal by fixed-block anchors.

A repeat of `window` words in an earlier document holds, wherever it lies, one whole block of `window // 2` words of that
document's non-overlapping blocks. So the blocks of all documents are the index, every rolling window of `window // 2`
words of every document probes it, and only repeats around a hit are extended to whole windows:

1. Each batch of documents sends its distinct rolling hashes, with a mark on those that are blocks. For each hash that is
   a block and occurs in two documents or more, an answer of one bit comes back.
2. Around the hits, each batch sends the hashes of its whole windows with the smallest document id that has them. The
   answer is one bit again: an earlier document elsewhere has this window. Inside the batch the smallest id is known.
3. Words under a repeated window go; overlapping windows add up to maximal repeats.

Documents are dealt to batches once; the three steps read that same shuffle. Hashes are dealt by ranges of their values,
and a batch sends each hash once: a passage in every document costs one entry for each batch, and no pairs are formed.
Step 1 compares 48 bits, where a false hit costs work only. Step 2 compares 64 bits between windows that share a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablejobs.llm import flat, packed

WINDOW = 50
_PROBE_BITS = 48
_NO_ID = np.int64((1 << 63) - 1)


class _Batch:
    """Hashes of the documents of one batch: half windows (probes) and whole windows, by word position."""

    def __init__(self, table: pa.Table, window: int, ranges: int) -> None:
        self.window, self.half, self.ranges = window, window // 2, ranges
        self.pieces = []
        probes, blocks, ids = [], [], []
        for rows, data, offsets in flat.pieces(table.to_batches(), "__text"):
            words = flat.Words(data, offsets, flat.NOT_SPACE)
            hashes = words.hashes()
            doc = words.doc()
            own = rows.column("__id").fill_null(int(_NO_ID)).to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.flatnonzero(flat.windows_inside(words.first, len(hashes), self.half))
            probes.append(flat.window_hashes(hashes, self.half)[at] >> np.uint64(64 - _PROBE_BITS))
            blocks.append((at - words.first[doc[at]]) % self.half == 0)
            ids.append(own[doc[at]])
            self.pieces.append((rows, data, offsets, words, hashes, doc, own, at))
        self.blocks, self.ids = _joined(blocks, bool), _joined(ids, np.int64)
        self.probes = packed.Groups(_joined(probes, np.uint64))
        self.bounds = packed.range_bounds(self.probes.keys, ranges, _PROBE_BITS)

    def asked(self) -> Iterator[tuple[int, bytes, bytes]]:
        """Distinct probes of each range, with the bits: is a block, is in two documents."""
        block = self.probes.reduce(np.logical_or, self.blocks)
        several = self.probes.reduce(np.minimum, self.ids) != self.probes.reduce(np.maximum, self.ids)
        for r in range(self.ranges):
            part = slice(self.bounds[r], self.bounds[r + 1])
            if part.start < part.stop:
                yield r, packed.pack_sorted(self.probes.keys[part]), packed.pack_bits(np.stack([block[part], several[part]]))

    def candidates(self, answers: dict[int, bytes]) -> None:
        """Finds the whole windows around the hits: `windows`, their smallest ids, and positions by piece."""
        hit = np.zeros(len(self.probes.keys), bool)
        for r, bits in answers.items():
            part = slice(self.bounds[r], self.bounds[r + 1])
            hit[part] = packed.unpack_bits(bits, part.stop - part.start)
        hit = self.probes.spread(hit)
        self.places, keys, ids, seen = [], [], [], 0
        for _, _, _, words, hashes, doc, own, at in self.pieces:
            found = at[hit[seen : seen + len(at)]]
            seen += len(at)
            n = max(len(hashes) - self.window + 1, 0)
            low = np.maximum(found - (self.window - self.half), 0)
            near = flat.covered(low, found + 1 - low, len(hashes))[:n]
            place = np.flatnonzero(near & flat.windows_inside(words.first, len(hashes), self.window))
            self.places.append(place)
            keys.append(flat.window_hashes(hashes, self.window)[place])
            ids.append(own[doc[place]])
        self.window_ids = _joined(ids, np.int64)
        self.windows = packed.Groups(_joined(keys, np.uint64))
        self.window_bounds = packed.range_bounds(self.windows.keys, self.ranges, 64)
        self.smallest = self.windows.reduce(np.minimum, self.window_ids)

    def window_ranges(self) -> Iterator[tuple[int, bytes, bytes, bytes]]:
        for r in range(self.ranges):
            part = slice(self.window_bounds[r], self.window_bounds[r + 1])
            if part.start < part.stop:
                ids, number = np.unique(self.smallest[part], return_inverse=True)
                yield r, packed.pack_sorted(self.windows.keys[part]), ids.astype("<i8").tobytes(), packed.pack_numbers(number)

    def removed(self, answers: dict[int, bytes]) -> list[np.ndarray]:
        """Words to remove, by piece."""
        earlier = np.zeros(len(self.windows.keys), bool)
        for r, bits in answers.items():
            part = slice(self.window_bounds[r], self.window_bounds[r + 1])
            earlier[part] = packed.unpack_bits(bits, part.stop - part.start)
        gone = self.windows.spread(earlier) | (self.windows.spread(self.smallest) < self.window_ids)
        out, seen = [], 0
        for place, (_, _, _, words, *_) in zip(self.places, self.pieces):
            out.append(flat.covered(place[gone[seen : seen + len(place)]], self.window, len(words)))
            seen += len(place)
        return out


def _joined(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _shared_blocks(table: pa.Table) -> pa.Table:
    """For each batch and its probes of this range: is it a block of some document, and in two or more."""
    rows = table.to_pylist()
    keys = [packed.unpack_sorted(r["keys"]) for r in rows]
    marks = [packed.unpack_bits(r["marks"], 2 * len(k)).reshape(2, -1) for r, k in zip(rows, keys)]
    groups = packed.Groups(np.concatenate(keys))
    block = groups.reduce(np.logical_or, np.concatenate([m[0] for m in marks]))
    several = groups.reduce(np.logical_or, np.concatenate([m[1] for m in marks])) | (groups.sizes() > 1)
    shared = np.split(groups.spread(block & several), np.cumsum([len(k) for k in keys])[:-1])
    out = [{"batch": r["batch"], "range": r["range"], "hits": packed.pack_bits(s)} for r, s in zip(rows, shared)]
    return pa.Table.from_pylist(out, pa.schema([("batch", pa.int32()), ("range", pa.int32()), ("hits", pa.binary())]))


def _earlier_windows(table: pa.Table) -> pa.Table:
    """For each batch and its windows of this range: a smaller id elsewhere has it. `hits` is handed back."""
    rows = table.to_pylist()
    sent = [r for r in rows if r["keys"]]
    keys = [packed.unpack_sorted(r["keys"]) for r in sent]
    ids = [np.frombuffer(r["ids"], "<i8")[packed.unpack_numbers(r["numbers"]).astype(np.int64)] for r in sent]
    bits: dict[int, bytes] = {}
    if sent:
        groups, own = packed.Groups(np.concatenate(keys)), np.concatenate(ids)
        earlier = groups.spread(groups.reduce(np.minimum, own)) < own
        for r, part in zip(sent, np.split(earlier, np.cumsum([len(k) for k in keys])[:-1])):
            bits[r["batch"]] = packed.pack_bits(part)
    out: dict[tuple[int, int], dict] = {}
    for r in rows:
        row = out.setdefault((r["batch"], r["range"]), {"batch": r["batch"], "range": r["range"], "hits": None, "earlier": None})
        row["hits"] = r["hits"] if r["hits"] is not None else row["hits"]
        row["earlier"] = bits.get(r["batch"])
    kind = pa.schema([("batch", pa.int32()), ("range", pa.int32()), ("hits", pa.binary()), ("earlier", pa.binary())])
    return pa.Table.from_pylist(list(out.values()), kind)


def _answers(table: pa.Table, name: str) -> dict[int, bytes]:
    return {r["range"]: r[name] for r in table.select(["range", name]).to_pylist() if r[name] is not None}


def remove_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW, keep_text: bool = True
) -> DataFrame:
    """Every row of `docs` with `n_words`, `n_removed` and `kept`: its words, without the repeated ones, joined by a space.

    A word goes if it lies in a window of `window` words (an even number) that also starts in a document of a smaller
    id; windows are those of the input. Words are runs of characters other than ASCII white space. NULL and empty texts
    have no words and keep the empty text; a NULL id counts as larger than every other; rows of equal id are not earlier
    than each other. Columns of the input with the name of an output column are replaced. Without `keep_text` the text
    column is left out of the result.
    """
    if window < 2 or window % 2:
        raise ValueError("window must be an even number of words")
    total = packed.number_of_batches(docs, text)
    extra = [c for c in docs.columns if c not in (text, "n_words", "n_removed", "kept")]
    dealt = docs.select(
        *[F.col(f"`{c}`") for c in extra],
        F.col(f"`{text}`").cast("string").alias("__text"),
        F.col(f"`{id}`").cast("long").alias("__id"),
        F.pmod(F.xxhash64(f"`{id}`"), F.lit(total)).cast("int").alias("__batch"),
    ).repartition(total, "__batch")

    def ask(key: tuple, table: pa.Table) -> pa.Table:
        batch = key[0].as_py()
        rows = [{"range": r, "batch": batch, "keys": k, "marks": m} for r, k, m in _Batch(table, window, total).asked()]
        return pa.Table.from_pylist(rows, pa.schema([("range", pa.int32()), ("batch", pa.int32()), ("keys", pa.binary()), ("marks", pa.binary())]))

    def extend(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        batch, here = key[0].as_py(), _Batch(table, window, total)
        found = _answers(answers, "hits")
        here.candidates(found)
        rows = [{"range": r, "batch": batch, "hits": bits} for r, bits in found.items()]
        rows += [{"range": r, "batch": batch, "keys": k, "ids": i, "numbers": n} for r, k, i, n in here.window_ranges()]
        names = [("range", pa.int32()), ("batch", pa.int32()), *[(n, pa.binary()) for n in ("hits", "keys", "ids", "numbers")]]
        return pa.Table.from_pylist(rows, pa.schema(names))

    whole = [text] if keep_text else []
    kept_type = T.StructType(
        [T.StructField(f.name, f.dataType, True) for f in docs.select(*[F.col(f"`{c}`") for c in extra + whole]).schema.fields]
        + [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())]
    )

    def cut(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        here = _Batch(table, window, total)
        here.candidates(_answers(answers, "hits"))
        parts = []
        for (rows, data, offsets, words, *_), gone in zip(here.pieces, here.removed(_answers(answers, "earlier"))):
            n_removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[words.first])
            columns = [rows.column(c) for c in [*extra, *["__text" for _ in whole]]] + [
                pa.array(words.counts.astype(np.int64)),
                pa.array(n_removed.astype(np.int64)),
                joined_words(words, ~gone),
            ]
            parts.append(pa.RecordBatch.from_arrays(columns, [*extra, *whole, "n_words", "n_removed", "kept"]))
        return pa.Table.from_batches(parts)

    asked = dealt.groupBy("__batch").applyInArrow(ask, "range int, batch int, keys binary, marks binary")
    hits = asked.repartition(total, "range").groupBy("range").applyInArrow(_shared_blocks, "batch int, range int, hits binary")
    extended = (
        dealt.groupBy("__batch")
        .cogroup(hits.groupBy("batch"))
        .applyInArrow(extend, "range int, batch int, hits binary, keys binary, ids binary, numbers binary")
    )
    answers = (
        extended.repartition(total, "range").groupBy("range").applyInArrow(_earlier_windows, "batch int, range int, hits binary, earlier binary")
    )
    return dealt.groupBy("__batch").cogroup(answers.groupBy("batch")).applyInArrow(cut, kept_type)


def joined_words(words: flat.Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each document, joined by one space."""
    data = words.data.copy()
    mask = flat.NOT_SPACE[data]
    low, high = flat.runs(~keep, words.first)
    for a, b in zip(words.starts[low], words.ends[high - 1]):
        mask[a:b] = False
    # The byte after a word that another one follows is white space of the same document.
    chosen = np.flatnonzero(keep)
    doc = words.doc()[chosen]
    inner = chosen[:-1][doc[:-1] == doc[1:]] if len(chosen) else chosen
    data[words.ends[inner]] = 0x20
    mask[words.ends[inner]] = True
    ends = np.concatenate([[0], np.cumsum(mask)])[words.offsets]
    return pa.StringArray.from_buffers(
        len(ends) - 1, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data[mask].tobytes())
    )
