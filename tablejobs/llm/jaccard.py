"""Jaccard self-join of shingle sets by PartEnum signatures, and the groups that its links form.

Sets are put into bands of sizes; two sets with a similarity of at least `percent` lie in the same band or in neighbouring
ones. An instance of the join takes two neighbouring bands. There, linked sets differ in at most k shingles. The domain
of shingles (their hashes) is cut into n = k + 1 + t parts, the same for all sets of an instance, so at least t + 1 parts
of two linked sets are equal. A signature is the content of one part. That gives two rules without loss:

* empty parts have no signature. A set with more than t empty parts adds the signatures of its prefix (the first shingles
  by hash, of which two linked sets share at least one). So do all such sets, which are few.
* a set whose empty parts and shared signatures are t at most together has no link in this instance, and its signatures
  go. Passages that many documents share do not bring them together.

Equal sets are one node. A batch sends its signatures packed by ranges. Each group of sets that share a signature has a
leader, the set that shares most with others, such as the source of many near copies. A set is first compared with LEADERS
leaders, those that it has the most groups with. Where linked sets become one component, no more comparisons are made. What
is left open, sets of one group in different components, is
compared in blocks: sets with one leader are dealt to blocks of about BLOCK sets, blocks that meet in an open group are
compared as a whole, and of the links between two components one is kept. Pairs of sets are no rows anywhere.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablejobs.llm import flat, packed
from tablejobs.llm.links import components, kept

SHINGLE = 5
PERCENT = 80
# Leaders that a set is compared with. The result does not depend on it.
LEADERS = 2
# Sets in a block of the comparisons that are open after the leaders'. The result does not depend on it.
BLOCK = 512
_STEP = 64
# Cells of the space of shingles in which they are counted to put rare ones first: 16 MB. The result does not depend on it.
CELL_BITS = 24
_SLICE_BITS = CELL_BITS - 6
# Pairs of sets with a common shingle that are looked at together. The result does not depend on it.
PAIRS = 1 << 20
# Features counted at once in these comparisons: about 75 MB. The result does not depend on it.
STRIP = 1 << 15
_LARGEST = 1 << 31


class Bands:
    """Bands of set sizes for `percent`, and of each instance the differences k, the spare parts t and all parts n."""

    def __init__(self, percent: int) -> None:
        if not 0 < percent <= 100:
            raise ValueError("percent must be from 1 to 100")
        self.percent = percent
        lows, low = [], 1
        while low < _LARGEST:
            lows.append(low)
            low = low * 100 // percent + 1
        self.lows = np.array([*lows, low], np.int64)
        highs = self.lows[1:] - 1
        k = [2 * h * (100 - percent) // (100 + percent) for h in highs.tolist()]
        t = [self._spare(d, self.lows[max(i - 1, 0)]) for i, d in enumerate(k)]
        self.t = np.array(t, np.int64)
        self.n = np.array(k, np.int64) + 1 + self.t

    @staticmethod
    def _spare(k: int, size: int) -> int:
        """Enough parts for what sets of the smallest size leave empty: the mean and four deviations."""
        if not k:
            return 0
        for t in range(0, k + 2, max(1, k // 64)):
            n = k + 1 + t
            empty = n * math.exp(-size / n)
            if t >= empty + 4 * math.sqrt(empty):
                return t
        return max(1, k // 4)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.lows, sizes, "right") - 1

    def prefix(self, sizes: np.ndarray) -> np.ndarray:
        return sizes - (sizes * self.percent + 99) // 100 + 1


class Sets:
    """Shingle sets of a piece: hashes sorted by document and value, the set's size and 64-bit key."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, width: int) -> None:
        words = flat.Words(flat.LOWER[data], offsets, flat.NOT_SPACE)
        hashes = words.hashes()
        inside = np.flatnonzero(flat.windows_inside(words.first, len(hashes), width))
        shingles = [flat.window_hashes(hashes, width)[inside]]
        doc = [words.doc()[inside]]
        for n in range(1, width):  # a document of fewer words is one shingle
            short = np.flatnonzero(words.counts == n)
            if len(short):
                shingles.append(flat.window_hashes(hashes, n)[words.first[short]])
                doc.append(short)
        h, d = np.concatenate(shingles), np.concatenate(doc)
        order = packed.order_of(h)
        small = np.uint16 if len(words.counts) < 1 << 16 else np.uint32
        order = order[np.argsort(d[order].astype(small), kind="stable")]
        h, d = h[order], d[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        self.h, self.doc = h[new], d[new]
        self.sizes = np.bincount(self.doc, minlength=len(words.counts))
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])
        self.key = np.zeros(len(self.sizes), np.uint64)
        full = self.sizes > 0
        if full.any():
            total = np.add.reduceat(flat.mix(self.h ^ np.uint64(0x5851F42D4C957F2D)), self.first[:-1][full])
            self.key[full] = flat.mix(total ^ (self.sizes[full].astype(np.uint64) << np.uint64(40)))

    def of(self, d: int) -> np.ndarray:
        return self.h[self.first[d] : self.first[d + 1]]


def _signatures(sets: Sets, chosen: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of the chosen documents: value, document, which instance (0 own band, 1 the next); and the spare
    parts left to each document in both instances."""
    picked = np.zeros(len(sets.sizes), bool)
    picked[chosen] = True
    use = picked[sets.doc]
    h, doc = sets.h[use], sets.doc[use]
    place = np.arange(len(sets.h))[use] - sets.first[doc]
    band = bands.of(np.maximum(sets.sizes, 1))
    slack = np.zeros((2, len(sets.sizes)), np.int64)
    values, owners, sides = [], [], []
    for side in (0, 1):
        instance = band + side
        n = bands.n[instance]
        part = ((h >> np.uint64(32)) * n[doc].astype(np.uint64)) >> np.uint64(32)
        new = np.ones(len(h), bool)
        new[1:] = (part[1:] != part[:-1]) | (doc[1:] != doc[:-1])
        begin = np.flatnonzero(new)
        seed = instance.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        content = np.add.reduceat(flat.mix(h ^ np.uint64(0xA5A3564E27F8862D)), begin) if len(begin) else h
        values.append(flat.mix(content ^ flat.mix(seed[doc[begin]] + part[begin])))
        owners.append(doc[begin])
        slack[side] = bands.t[instance] - (n - np.bincount(doc[begin], minlength=len(n)))
        first = (place < bands.prefix(sets.sizes)[doc]) & (slack[side][doc] < 0)
        values.append(flat.mix(flat.mix(h[first] ^ np.uint64(0x3C6EF372FE94F82B)) ^ seed[doc[first]]))
        owners.append(doc[first])
        sides += [np.full(len(begin), side), np.full(int(first.sum()), side)]
    return np.concatenate(values), np.concatenate(owners), np.concatenate(sides), slack


def shingle_sets(docs: DataFrame, id: str, text: str, width: int) -> DataFrame:
    """(id, n_shingles, key) of every document; the key stands for the set, NULL if it is empty."""

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in flat.pieces(batches, "__text"):
            sets = Sets(data, offsets, width)
            columns = [
                batch.column("__id"),
                pa.array(sets.sizes.astype(np.int64)),
                pa.array(sets.key.view(np.int64), mask=sets.sizes == 0),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["__id", "n_shingles", "key"])

    frame = docs.select(F.col(f"`{id}`").cast("long").alias("__id"), F.col(f"`{text}`").cast("string").alias("__text"))
    return frame.mapInArrow(step, "__id long, n_shingles long, key long")


def _groups(docs: DataFrame, text: str, width: int, bands: Bands, ranges: int) -> DataFrame:
    """(sig, key, weight) of all sets that share enough signatures; the weight tells how much a set shares with others."""

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list = []
        for _, data, offsets in flat.pieces(batches, "__text"):
            sets = Sets(data, offsets, width)
            full = np.flatnonzero(sets.sizes)
            _, where = np.unique(sets.key[full], return_index=True)
            waiting.append((sets.key, *_signatures(sets, full[where], bands)))
            if sum(len(x[1]) for x in waiting) > 2_000_000:
                yield _sent(waiting, ranges)
                waiting = []
        if waiting:
            yield _sent(waiting, ranges)

    frame = docs.select(F.col(f"`{text}`").cast("string").alias("__text"))
    sent = frame.mapInArrow(send, "range int, sigs binary, numbers binary, keys binary, slack binary")
    shared = sent.repartition(ranges, "range").groupBy("range").applyInArrow(_shared, _SHARED)
    rows = kept(shared, "signatures")
    counts = rows.groupBy("key", "side").agg(
        F.count(F.lit(1)).alias("n"), F.max("slack").alias("slack"), F.sum("size").alias("weight")
    )
    enough = counts.filter("n > slack").select("key", "side", "weight")
    return rows.join(enough, ["key", "side"]).select("sig", "key", "weight")


_SHARED = "sig long, key long, side boolean, slack int, size int"


def _sent(waiting: list, ranges: int) -> pa.RecordBatch:
    keys, sigs, numbers, slacks, seen = [], [], [], [], 0
    for key, values, owners, sides, slack in waiting:
        keys.append(key)
        sigs.append(values)
        numbers.append((owners + seen) * 2 + sides)
        slacks.append(slack)
        seen += len(key)
    key, sig, number, slack = np.concatenate(keys), np.concatenate(sigs), np.concatenate(numbers), np.concatenate(slacks, axis=1)
    sig >>= np.uint64(16)
    order = np.argsort(sig)
    sig, number = sig[order], number[order]
    bounds = packed.range_bounds(sig, ranges, 48)
    out: dict[str, list] = {"range": [], "sigs": [], "numbers": [], "keys": [], "slack": []}
    for r in range(ranges):
        part = slice(bounds[r], bounds[r + 1])
        if part.start == part.stop:
            continue
        docs, place = np.unique(number[part] // 2, return_inverse=True)
        out["range"].append(r)
        out["sigs"].append(packed.pack_sorted(sig[part]))
        out["numbers"].append(packed.pack_numbers(place * 2 + number[part] % 2))
        out["keys"].append(key[docs].astype("<u8").tobytes())
        out["slack"].append(np.clip(slack[:, docs], -1, 126).astype(np.int8).tobytes())
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], list(out))


def _shared(table: pa.Table) -> pa.Table:
    """The entries of a range whose signature belongs to two sets or more."""
    rows = table.to_pylist()
    sigs = [packed.unpack_sorted(row["sigs"]) for row in rows]
    groups = packed.Groups(np.concatenate(sigs), 48)
    more = np.split(groups.spread(groups.sizes() > 1), np.cumsum([len(x) for x in sigs])[:-1])
    groups = None
    # Most signatures occur once; what goes with them is not unpacked.
    kept_sigs, keys, sides, slacks = [], [], [], []
    for row, own_sigs, wanted in zip(rows, sigs, more):
        number = packed.unpack_numbers(row["numbers"])[wanted].astype(np.int64)
        own, side = number // 2, number % 2
        kept_sigs.append(own_sigs[wanted])
        keys.append(np.frombuffer(row["keys"], "<u8")[own])
        slacks.append(np.frombuffer(row["slack"], np.int8).reshape(2, -1)[side, own])
        sides.append(side.astype(bool))
    sig, key, side, slack = map(np.concatenate, (kept_sigs, keys, sides, slacks))
    rows = sigs = more = None
    groups = packed.Groups(sig, 48)
    several = groups.spread(groups.reduce(np.minimum, key) != groups.reduce(np.maximum, key))
    sig, key, side, slack = sig[several], key[several], side[several], slack[several]
    order = np.lexsort((key, sig))
    sig, key, side, slack = sig[order], key[order], side[order], slack[order]
    new = np.ones(len(sig), bool)
    new[1:] = (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])
    sig, key, side, slack = sig[new], key[new], side[new], slack[new]
    groups = packed.Groups(sig)
    size = groups.spread(groups.sizes().astype(np.int32))
    flat.release()
    columns = [sig.view(np.int64), key.view(np.int64), side, slack.astype(np.int32), size]
    return pa.Table.from_arrays([pa.array(c) for c in columns], ["sig", "key", "side", "slack", "size"])


_FILTER_WORDS = 1 << 20


def _places(keys: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Word and bit of each key in a bit filter of fixed size, by two hashes."""
    out = []
    for seed in (0x165667B19E3779F9, 0x27D4EB2F165667C5):
        h = flat.mix(keys ^ np.uint64(seed))
        out.append(((h >> np.uint64(44)).astype(np.int64), (h & np.uint64(63))))
    return out


def _filter_of(keys: DataFrame) -> np.ndarray:
    """A bit filter of 8 MB that holds all keys, however many there are; it may let others through."""

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(_FILTER_WORDS, np.uint64)
        for batch in batches:
            for word, bit in _places(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)):
                np.bitwise_or.at(bits, word, np.uint64(1) << bit)
        word = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bits[word].view(np.int64))], ["word", "bits"])

    found = keys.mapInArrow(step, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(_FILTER_WORDS, np.uint64)
    bits[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return bits


def _sets_of(docs: DataFrame, keys: DataFrame, text: str, width: int) -> DataFrame:
    """(key, hashes) of the sets with these keys, one row each: the sorted hashes, packed."""
    shared = docs.sparkSession.sparkContext.broadcast(_filter_of(keys))

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for _, data, offsets in flat.pieces(batches, "__text"):
            sets = Sets(data, offsets, width)
            wanted = sets.sizes > 0
            for word, bit in _places(sets.key):
                wanted &= (bits[word] >> bit) & np.uint64(1) == 1
            at = np.flatnonzero(wanted)
            found, where = np.unique(sets.key[at], return_index=True)
            hashes = [packed.pack_sorted(sets.of(d)) for d in at[where]]
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(hashes, pa.binary())], ["key", "hashes"])

    frame = docs.select(F.col(f"`{text}`").cast("string").alias("__text"))
    found = frame.mapInArrow(step, "key long, hashes binary")
    return found.join(keys, "key", "left_semi").groupBy("key").agg(F.first("hashes").alias("hashes"))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of keys whose sets are similar enough, counted on the whole sets."""

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = []
            known: tuple = (None, None)
            for x, y in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist()):
                if x is not known[0] and x != known[0]:
                    known = (x, packed.unpack_sorted(x))
                a, b = known[1], packed.unpack_sorted(y)
                both = len(a) + len(b) - len(flat.distinct_sorted(np.concatenate([a, b])))
                same.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(same, pa.bool_()))

    left = sets.select(F.col("key").alias("a"), F.col("hashes").alias("left"))
    right = sets.select(F.col("key").alias("b"), F.col("hashes").alias("right"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right").mapInArrow(step, "a long, b long")


def _rarity(sets: DataFrame) -> np.ndarray:
    """How many shingles of the sets lie in each cell, in steps of an eighth of a doubling. 0 stands for one at most."""

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list = []
        for piece, _, _ in flat.pieces(batches, "hashes"):
            waiting += [packed.unpack_sorted(x) >> np.uint64(64 - CELL_BITS) for x in piece.column("hashes").to_pylist()]
            if sum(map(len, waiting)) > 2_000_000:
                yield sent(waiting)
                waiting = []
        if waiting:
            yield sent(waiting)

    def sent(waiting: list) -> pa.RecordBatch:
        cells = np.sort(np.concatenate(waiting))
        slices = np.arange(1 << (CELL_BITS - _SLICE_BITS))
        bounds = [*np.searchsorted(cells, slices.astype(np.uint64) << np.uint64(_SLICE_BITS)), len(cells)]
        parts = [packed.pack_sorted(cells[bounds[i] : bounds[i + 1]]) for i in slices]
        return pa.RecordBatch.from_arrays([pa.array(slices, pa.int32()), pa.array(parts, pa.binary())], ["slice", "cells"])

    def count(table: pa.Table) -> pa.Table:
        slice_ = table.column("slice")[0].as_py()
        total = np.zeros(1 << _SLICE_BITS, np.int64)
        for part in table.column("cells").to_pylist():
            inside = packed.unpack_sorted(part).astype(np.int64) - (slice_ << _SLICE_BITS)
            total += np.bincount(inside, minlength=len(total))
        steps = np.minimum(np.round(8 * np.log2(np.maximum(total, 1))), 255).astype(np.uint8)
        return pa.table([pa.array([slice_], pa.int32()), pa.array([steps.tobytes()], pa.binary())], ["slice", "steps"])

    found = sets.select("hashes").mapInArrow(send, "slice int, cells binary")
    found = found.groupBy("slice").applyInArrow(count, "slice int, steps binary").toArrow()
    out = np.zeros((1 << (CELL_BITS - _SLICE_BITS), 1 << _SLICE_BITS), np.uint8)
    for slice_, steps in zip(found.column("slice").to_pylist(), found.column("steps").to_pylist()):
        out[slice_] = np.frombuffer(steps, np.uint8)
    return out.reshape(-1)


def _expanded(begin: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each i with begin[i] .. begin[i] + n[i] - 1, about PAIRS pairs at a time."""
    own = np.flatnonzero(n)
    begin, n = begin[own], n[own]
    ends, low = np.cumsum(n), 0
    while low < len(n):
        done = ends[low] - n[low]
        high = max(int(np.searchsorted(ends, done + PAIRS, "right")), low + 1)
        part = n[low:high]
        step = np.arange(ends[high - 1] - done) - np.repeat(ends[low:high] - part - done, part)
        yield np.repeat(own[low:high], part), np.repeat(begin[low:high], part) + step
        low = high


def _meeting(table: pa.Table, percent: int) -> pa.Table:
    """Pairs (a, b) of sets with a common shingle at places that leave enough of both, and with different labels."""
    token, key, label, size, place = (table.column(c).to_numpy() for c in ("token", "key", "label", "size", "place"))
    groups = packed.Groups(token.view(np.uint64))
    apart = groups.spread(groups.reduce(np.minimum, label) != groups.reduce(np.maximum, label))
    token, key, label, size, place = (x[apart] for x in (token, key, label, size, place))
    size, place = size.astype(np.int64), place.astype(np.int64)
    found = [np.zeros((2, 0), np.int64)]
    if len(token):
        group = np.unique(token, return_inverse=True)[1].astype(np.int64) << 32
        label = np.unique(label, return_inverse=True)[1]
        # Either the sets that are larger, up to the largest that can be similar; or those of labels further on.
        by_size, by_label = np.lexsort((size, group)), np.lexsort((label, group))
        most = np.clip((100 + percent) * (size - place) // percent - size, 0, _LARGEST)
        ranked = (group + size)[by_size]
        after = np.arange(1, len(ranked) + 1)
        larger = np.maximum(np.searchsorted(ranked, (group + most)[by_size], "right") - after, 0)
        ranked = (group + label)[by_label]
        other = np.searchsorted(ranked, ranked, "right")
        further = np.searchsorted(group[by_label], group[by_label], "right") - other
        group >>= 32
        fewer = np.bincount(group[by_size], larger) <= np.bincount(group[by_label], further)
        for order, begin, n, use in ((by_size, after, larger, fewer), (by_label, other, further, ~fewer)):
            for x, y in _expanded(begin, np.where(use[group[order]], n, 0)):
                x, y = order[x], order[y]
                least = -(-percent * (size[x] + size[y]) // (100 + percent))
                fits = (label[x] != label[y]) & (size[x] - place[x] >= least) & (size[y] - place[y] >= least)
                x, y = key[x[fits]], key[y[fits]]
                found.append(np.unique([np.minimum(x, y), np.maximum(x, y)], axis=1))
    a, b = np.unique(np.concatenate(found, axis=1), axis=1)
    flat.release()
    return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _candidates(sets: DataFrame, bands: Bands, ranges: int) -> DataFrame:
    """Pairs (a, b) of sets (key, label, hashes) that have different labels and may be similar enough.

    All shingles are put in one order. Two sets share no more than what each has from their first common shingle on. So the
    first shingles of each set find all pairs, and few others if rare shingles come first: a set of many shingles of its own
    has only these in front.
    """
    rarity = sets.sparkSession.sparkContext.broadcast(_rarity(sets))

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = rarity.value
        for piece, _, _ in flat.pieces(batches, "hashes"):
            hashes = [packed.unpack_sorted(x) for x in piece.column("hashes").to_pylist()]
            size = np.array([len(x) for x in hashes])
            h, own = np.concatenate(hashes), np.repeat(np.arange(len(size)), size)
            rare = steps[(h >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
            order = np.lexsort((h, rare, own))
            place = np.arange(len(h)) - (np.cumsum(size) - size)[own]
            # A shingle alone in its cell is in no other set.
            use = (place < bands.prefix(size)[own]) & (rare[order] > 0)
            token, own = h[order[use]], own[use]
            columns = [
                pa.array(((token >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)),
                pa.array(token.view(np.int64)),
                piece.column("key").take(pa.array(own)),
                piece.column("label").take(pa.array(own)),
                pa.array(size[own].astype(np.int32)),
                pa.array(place[use].astype(np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["range", "token", "key", "label", "size", "place"])

    kinds = "range int, token long, key long, label long, size int, place int"
    sent = sets.select("key", "label", "hashes").mapInArrow(send, kinds).repartition(ranges, "range")
    return sent.groupBy("range").applyInArrow(lambda table: _meeting(table, bands.percent), "a long, b long").distinct()


def _with_leaders(led: DataFrame) -> DataFrame:
    """Pairs (a, b) of each set and those leaders of its groups (sig, key, top) that it has the most groups with."""
    shared = led.filter("top.key <> key").groupBy("key", F.col("top.key").alias("leader")).agg(F.count(F.lit(1)).alias("n"))
    most = Window.partitionBy("key").orderBy(F.desc("n"), "leader")
    chosen = shared.withColumn("at", F.row_number().over(most)).filter(F.col("at") <= LEADERS)
    return chosen.select(F.least("leader", "key").alias("a"), F.greatest("leader", "key").alias("b")).distinct()


def _open_links(led: DataFrame, labels: DataFrame, sets: DataFrame, bands: Bands, ranges: int) -> DataFrame:
    """Links (a, b) between sets of one group (sig, key, its leader `top`) that are in different components so far."""
    rest = led.join(labels.select(F.col("node").alias("key"), "label"), "key", "left")
    rest = rest.select("sig", "top", "key", F.coalesce("label", "key").alias("label"))
    apart = rest.groupBy("sig").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y").select("sig")
    homes = rest.join(apart, "sig").groupBy("key").agg(F.max("top")["key"].alias("home"), F.min("label").alias("label"))
    left_open = kept(homes.join(sets, "key"), "open")
    # A common shingle is in one range with others; more ranges spread them.
    may = kept(_candidates(left_open, bands, 4 * ranges), "candidates")
    ends = may.select(F.col("a").alias("key")).union(may.select(F.col("b").alias("key"))).distinct()
    homes = left_open.join(ends, "key", "left_semi")
    sizes = homes.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    block = F.xxhash64("home", F.pmod(F.xxhash64("key"), "blocks")).alias("block")
    members = kept(homes.join(sizes, "home").select("key", "label", block, "hashes"), "homes")
    one = members.select(F.col("key").alias("a"), F.col("block").alias("x"))
    two = members.select(F.col("key").alias("b"), F.col("block").alias("y"))
    both = may.join(one, "a").join(two, "b").select(F.least("x", "y").alias("block"), F.greatest("x", "y").alias("other")).distinct()
    left = both.join(members, "block").select(*[F.col(c).alias(c) for c in ("block", "other", "key", "label", "hashes")])
    # Another projection, so that both sides have columns of their own.
    second = members.select(*[F.col(c).alias(f"_{c}") for c in ("block", "key", "label", "hashes")])
    right = both.filter("block < other").join(second, F.col("other") == F.col("_block"))
    right = right.select(
        F.col("block").alias("r_block"), F.col("other").alias("r_other"), F.col("_label").alias("label"), F.col("_key").alias("key"), F.col("_hashes").alias("hashes")
    )
    def compare(one: pa.Table, two: pa.Table) -> pa.Table:
        x = one.to_pylist()
        y = two.to_pylist() or x
        first: dict[tuple[int, int], tuple[int, int]] = {}
        if len({r["label"] for r in x} | {r["label"] for r in y}) > 1:
            a = [packed.unpack_sorted(r["hashes"]) for r in x]
            b = [packed.unpack_sorted(r["hashes"]) for r in y]
            size_b = np.array([len(v) for v in b])[None, :]
            for low in range(0, len(a), _STEP):
                part = a[low : low + _STEP]
                both_ = _in_common(part, b)
                total = np.array([len(v) for v in part])[:, None] + size_b - both_
                for i, j in zip(*np.nonzero(100 * both_ >= bands.percent * total)):
                    ends = tuple(sorted((x[low + i]["label"], y[j]["label"])))
                    if ends[0] != ends[1]:
                        first.setdefault(ends, (x[low + i]["key"], y[j]["key"]))
        return pa.table([pa.array([p[k] for p in first.values()], pa.int64()) for k in (0, 1)], ["a", "b"])

    return left.groupBy("block", "other").cogroup(right.groupBy("r_block", "r_other")).applyInArrow(compare, "a long, b long")


def _in_common(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many features each set of `a` shares with each of `b`, counted in strips of the features of `a`, so that memory does
    not grow with the length of the sets; exact up to 2 ** 24 common features in a strip."""
    features = flat.distinct_sorted(np.concatenate(a))
    total = np.zeros((len(a), len(b)), np.int64)
    for low in range(0, len(features), STRIP):
        strip = features[low : low + STRIP]
        total += (_incidence(a, strip) @ _incidence(b, strip).T).astype(np.int64)
    return total


def _incidence(sets: list[np.ndarray], features: np.ndarray) -> np.ndarray:
    """Sets x features, 1 where a sorted set has the feature."""
    out = np.zeros((len(sets), len(features)), np.float32)
    for row, own in zip(out, sets):
        own = own[np.searchsorted(own, features[0]) : np.searchsorted(own, features[-1], "right")]
        place = np.searchsorted(features, own)
        row[place[features[place] == own]] = 1
    return out


def similar_documents(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """(id, n_shingles, component_id) of every document.

    The set of a document is its distinct shingles of `width` words, lower-cased A-Z; with fewer words the whole sequence
    is one. Two documents link when 100 * intersection >= percent * union. component_id is the smallest id that links
    reach, the own one included. NULL and empty texts have no shingles and no links. Rows of a repeated id are each a
    document; a NULL id is never the smallest, and stays NULL if it has no links.
    """
    bands = Bands(percent)
    names = kept(shingle_sets(docs, id, text, width), "sets")
    # A range has the signatures of about 16 MB of text, some three million, whatever the input is.
    ranges = max(packed.number_of_batches(docs, text) // 2, 4 * docs.sparkSession.sparkContext.defaultParallelism)
    groups = _groups(docs, text, width, bands, ranges)
    leaders = groups.groupBy("sig").agg(F.max(F.struct("weight", "key")).alias("top"))
    # The leader's own rows are in it too.
    led = kept(groups.drop("weight").join(leaders, "sig").select("sig", "key", "top"), "groups")
    sets = kept(_sets_of(docs, led.select("key").distinct(), text, width), "hashes")
    links = kept(_linked(_with_leaders(led), sets, percent), "links")
    labels = components(links)
    more = kept(_open_links(led, labels, sets, bands, ranges), "links")
    if not more.isEmpty():
        labels = components(links.union(more))
    nodes = names.groupBy("key").agg(F.min("__id").alias("low")).filter("key is not null")
    nodes = nodes.join(labels.select(F.col("node").alias("key"), "label"), "key", "left")
    nodes = nodes.select("key", "low", F.coalesce("label", "key").alias("label"))
    lows = nodes.groupBy("label").agg(F.min("low").alias("component_id"))
    found = names.join(nodes.join(lows, "label").select("key", "component_id"), "key", "left")
    return found.select(F.col("__id").alias(id), "n_shingles", F.coalesce("component_id", "__id").alias("component_id"))
