"""Best-fit packing of pieces of documents into sequences of bounded length, by a grouping genetic algorithm.

1. `cut` turns each text into token ids with an end id and cuts them into pieces. The distinct words of some megabytes are
   looked up in what the Python worker has encoded before, and only new ones are encoded; texts are not shuffled.
2. Pieces shorter than a sequence are dealt evenly to shards of about SHARD_PIECES. A shard is known by the lengths of its
   pieces alone, and is solved by several islands.
3. An island evolves a population of packings. A crossover injects whole well-filled bins of one parent into another,
   removes the bins that hold a piece twice, and puts displaced pieces back by best fit; a mutation empties the worst bins.
   Between epochs the elite of each island migrates to the next one of its shard.
4. The best packing of a shard keeps its fuller bins; the pieces of its emptiest bins, at most one bin in OPEN, are dealt
   to shards again, until one shard is left. So many shards waste no more than one does.

An island ends early at a lower bound (see `lower_bound`), which no packing beats.
"""

from __future__ import annotations

import itertools
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablejobs.llm import flat
from tablejobs.llm.links import kept
from tablejobs.llm.wordcache import encoder_of

CAPACITY, END_ID = 2048, 0
SHARD_PIECES, ISLANDS, EPOCHS, GENERATIONS, POPULATION, ELITE, OPEN = 4096, 3, 2, 6, 6, 2, 8
_TEXT_BYTES = 4_000_000


def cut(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, piece, start, length, ids): the ids of each text and `end_id`, cut every `capacity` ids.

    `path` names a tokenizer that drops white space and lower-cases. `start` counts the document's ids before the piece; `ids`
    are little-endian unsigned 32-bit integers. NULL and empty texts are a piece of the end id alone. Rows of a repeated id
    are cut each.
    """
    if capacity < 1:
        raise ValueError("a sequence holds one id at least")
    end = np.array([end_id], "<u4").tobytes()
    frame = docs.select(F.col(f"`{id}`").alias("__id"), F.col(f"`{text}`").cast("string").alias("__text"))

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path, "between")
        for rows, data, offsets in flat.pieces(batches, "__text", _TEXT_BYTES):
            at, piece, start, size, out = [], [], [], [], []
            ids, bounds = encoder.ids(data, offsets)
            ids = ids.tobytes()
            for i, (low, high) in enumerate(zip((4 * bounds[:-1]).tolist(), (4 * bounds[1:]).tolist())):
                own = ids[low:high] + end
                for k, first in enumerate(range(0, len(own), 4 * capacity)):
                    at.append(i)
                    piece.append(k)
                    start.append(first // 4)
                    out.append(own[first : first + 4 * capacity])
                    size.append(len(out[-1]) // 4)
            columns = [
                rows.column("__id").take(pa.array(at, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(size, pa.int64()),
                pa.array(out, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["__id", "piece", "start", "length", "ids"])

    kind = T.StructType(
        [frame.schema["__id"], *[T.StructField(n, t) for n, t in [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids", T.BinaryType())]]]
    )
    return frame.mapInArrow(step, kind).withColumnRenamed("__id", id)


# --- one shard -------------------------------------------------------------------------------------


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that no packing can do without.

    For a length `a` up to half the capacity: pieces over half a bin share none; those that leave less than `a` take none of
    the pieces from `a` to one half, and these need what room the others do not leave.
    """
    if not len(lengths):
        return 0
    ranked = np.sort(lengths.astype(np.int64))
    total = np.concatenate([[0], np.cumsum(ranked)])
    half = np.searchsorted(ranked, capacity // 2, "right")
    least = np.unique(np.append(ranked[:half], 0))
    wide = np.searchsorted(ranked, capacity - least, "right")
    small = total[half] - total[np.searchsorted(ranked, least, "left")]
    left = (wide - half) * capacity - (total[wide] - total[half])
    return max(int((len(ranked) - half - (small - left) // -capacity * (small > left)).max()), 1)


class Shard:
    """Packings of pieces of the given lengths: for each piece, its bin."""

    def __init__(self, lengths: np.ndarray, capacity: int, seed: int) -> None:
        self.lengths, self.capacity = lengths.astype(np.int64), capacity
        self.random = np.random.default_rng(seed)
        self.bound = lower_bound(self.lengths, capacity)

    def fills(self, bins: np.ndarray) -> np.ndarray:
        return np.bincount(bins, self.lengths).astype(np.int64)

    def cost(self, bins: np.ndarray) -> tuple[int, float]:
        """Fewer bins first, then fuller ones: the share of waste by squares."""
        fills = self.fills(bins)
        return len(fills), -float(np.square(fills / self.capacity).sum())

    def best_fit(self, bins: np.ndarray, waiting: np.ndarray) -> np.ndarray:
        """Puts the waiting pieces, longest first, into the fullest bins that take them; opens bins where none does.

        `bins` holds -1 for the waiting pieces; bins are renumbered without gaps.
        """
        out = bins.copy()
        held = out >= 0
        used, out[held] = np.unique(out[held], return_inverse=True)
        free = self.capacity - np.bincount(out[held], self.lengths[held], minlength=len(used)).astype(np.int64)
        n, lengths = len(used), self.lengths.tolist()
        # Free space and bin as one number, in order.
        spaces = sorted((free * (1 << 32) + np.arange(n)).tolist())
        for i in waiting[np.argsort(-self.lengths[waiting], kind="stable")].tolist():
            at = bisect_left(spaces, lengths[i] << 32)
            if at < len(spaces):
                room, own = divmod(spaces.pop(at), 1 << 32)
            else:
                room, own, n = self.capacity, n, n + 1
            out[i] = own
            if room > lengths[i]:
                insort(spaces, (room - lengths[i]) << 32 | own)
        return out

    def start(self, noise: float) -> np.ndarray:
        """Best fit of pieces in order of length, blurred by `noise`."""
        order = np.argsort(-self.lengths * (1 + noise * self.random.standard_normal(len(self.lengths))), kind="stable")
        bins = np.full(len(self.lengths), -1, np.int64)
        if not noise:
            return self.best_fit(bins, order)
        # The first half in blurred order as it comes, the rest by best fit.
        half = order[: len(order) // 2]
        level = np.cumsum(self.lengths[half]) // self.capacity
        for own in np.split(half, np.flatnonzero(np.diff(level)) + 1):
            inside = np.cumsum(self.lengths[own]) <= self.capacity
            bins[own[inside]] = own[0] if len(own) else 0
        return self.best_fit(bins, np.flatnonzero(bins < 0))

    def crossover(self, mother: np.ndarray, father: np.ndarray) -> np.ndarray:
        """Well-filled bins of the father go into the mother whole; bins that then hold a piece twice go, and the other
        pieces of these are put back by best fit."""
        fills = self.fills(father)
        tried = self.random.permutation(len(fills))[: max(len(fills) // 2, 1)]
        chosen = np.zeros(len(fills), bool)
        chosen[tried[fills[tried] >= np.median(fills[tried])]] = True
        moved = chosen[father]
        broken = np.zeros(int(mother.max()) + 1, bool)
        broken[mother[moved]] = True
        out = np.where(broken[mother], -1, mother)
        out[moved] = father[moved] + len(broken)
        return self.best_fit(out, np.flatnonzero(out < 0))

    def mutated(self, bins: np.ndarray) -> np.ndarray:
        """The emptiest bins and some others are dissolved."""
        fills = self.fills(bins)
        n = max(len(fills) // 20, 2)
        gone = np.zeros(len(fills), bool)
        gone[np.argsort(fills, kind="stable")[:n]] = True
        gone[self.random.integers(0, len(fills), n)] = True
        out = np.where(gone[bins], -1, bins)
        return self.best_fit(out, self.random.permutation(np.flatnonzero(out < 0)))

    def evolve(self, guests: list[np.ndarray], size: int, generations: int) -> list[np.ndarray]:
        """A population after some generations, best first; `guests` take part from the start."""
        if not len(self.lengths):
            return [np.zeros(0, np.int64)]
        people = list(guests) or [self.start(0.0)]
        for step in itertools.count():
            people = sorted(people, key=self.cost)[:size]
            if step == generations or int(people[0].max()) + 1 == self.bound:
                return people
            while len(people) < size:
                people.append(self.start(0.1 * len(people)))
            children = []
            for mother in people:
                father = people[int(self.random.integers(0, len(people)))]
                children.append(self.mutated(mother) if father is mother else self.crossover(mother, father))
            people += children


def _pack_bins(people: list[np.ndarray]) -> bytes:
    return zstandard.ZstdCompressor().compress(np.stack(people).astype("<u4").tobytes())


def _unpack_bins(data: bytes | None, n: int) -> list[np.ndarray]:
    if data is None:
        return []
    return list(np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<u4").reshape(-1, n).astype(np.int64))


# --- all shards ------------------------------------------------------------------------------------


def _evolved(state: DataFrame, capacity: int, epoch: int, level: int) -> DataFrame:
    """(shard, island, lengths, elite, n_bins, cost) after one epoch; `elite` and `guests` may be NULL in `state`."""

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                lengths = np.frombuffer(row["lengths"], "<u4")
                shard = Shard(lengths, capacity, hash((level, epoch, row["shard"], row["island"])) & 0x7FFFFFFF)
                guests = _unpack_bins(row["elite"], len(lengths)) + _unpack_bins(row["guests"], len(lengths))
                people = shard.evolve(guests, POPULATION, GENERATIONS)
                n, cost = shard.cost(people[0]) if len(lengths) else (0, 0.0)
                row |= {"elite": _pack_bins(people[:ELITE]), "n_bins": n, "cost": cost}
                row.pop("guests")
            yield pa.RecordBatch.from_pylist(rows, out)

    out = pa.schema(
        [("shard", pa.int64()), ("island", pa.int32()), ("lengths", pa.binary()), ("elite", pa.binary()), ("n_bins", pa.int64()), ("cost", pa.float64())]
    )
    return state.mapInArrow(step, "shard long, island int, lengths binary, elite binary, n_bins long, cost double")


def _solved(items: DataFrame, shards: int, capacity: int, level: int) -> DataFrame:
    """(shard, at, bin, offset, closed) of every piece of the shards, by the best packing that the islands find."""

    def spelled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (r["shard"], np.array([x["length"] for x in sorted(r["pieces"], key=lambda x: x["at"])], "<u4").tobytes())
                for r in batch.to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["shard", "lengths"])

    def chosen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
                if not len(lengths):
                    continue
                bins = _unpack_bins(row["elite"], len(lengths))[0]
                fills = np.bincount(bins, lengths)
                emptiest = np.argsort(fills, kind="stable")[: max(len(fills) // OPEN, 1)]
                # No more than half of the pieces go on, so that the rounds end.
                emptiest = emptiest[np.cumsum(np.bincount(bins)[emptiest]) <= len(bins) // 2]
                closed = np.ones(len(fills), bool)
                closed[emptiest] = shards == 1
                closed |= fills == capacity
                order = np.argsort(bins, kind="stable")
                before = np.cumsum(lengths[order]) - lengths[order]
                first = np.concatenate([[0], np.flatnonzero(np.diff(bins[order])) + 1])
                offset = np.empty(len(bins), np.int64)
                offset[order] = before - np.repeat(before[first], np.diff(np.append(first, len(bins))))
                columns = [np.full(len(bins), row["shard"]), np.arange(len(bins)), bins, offset, closed[bins]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["shard", "at", "bin", "offset", "closed"])

    pieces = F.collect_list(F.struct(F.col("__at").alias("at"), F.col("__length").alias("length")))
    grouped = items.groupBy(F.col("__shard").alias("shard")).agg(pieces.alias("pieces"))
    problems = grouped.mapInArrow(spelled, "shard long, lengths binary")
    island = F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1)))
    none = F.lit(None).cast("binary")
    state = problems.withColumn("island", island).withColumn("elite", none).withColumn("guests", none)
    # Little data for much work: the number of tasks is set, so that they are not merged for their size.
    tasks = min(shards * ISLANDS, 4 * items.sparkSession.sparkContext.defaultParallelism)
    state = kept(_evolved(state.repartition(tasks, "shard", "island"), capacity, 0, level), "islands")
    for epoch in range(1, EPOCHS):
        moved = state.select("shard", ((F.col("island") + 1) % ISLANDS).alias("island"), F.col("elite").alias("guests"))
        met = state.select("shard", "island", "lengths", "elite").join(moved, ["shard", "island"])
        state = kept(_evolved(met.repartition(tasks, "shard", "island"), capacity, epoch, level), "islands")
    best = state.groupBy("shard").agg(F.min_by(F.struct("lengths", "elite"), F.struct("n_bins", "cost", "island")).alias("best"))
    return best.select("shard", "best.*").mapInArrow(chosen, "shard long, at long, bin long, offset long, closed boolean")


def pack(pieces: DataFrame, capacity: int = CAPACITY, length: str = "length", shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """`pieces` with `sequence_id` and `offset`: sequences of at most `capacity`, filled without gaps.

    A piece of no length or NULL counts as nothing and lies somewhere; a piece longer than `capacity` is an error. Rows need
    no id: equal rows are pieces each. Columns of the input named `sequence_id` or `offset` are replaced. An empty table
    stays empty. Full pieces are sequences of their own; all others are packed as this module describes.
    """
    size = F.coalesce(F.col(f"`{length}`").cast("long"), F.lit(0))
    own = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    names = {c: f"__own_{i}" for i, c in enumerate(own)}
    carried = [F.col(f"`{c}`").alias(n) for c, n in names.items()]
    all_pieces = kept(pieces.select(*carried, size.alias("__length"), F.monotonically_increasing_id().alias("__row")), "pieces")
    facts = all_pieces.agg(F.max("__length"), F.min("__length"), F.count_if(F.col("__length") < capacity)).first()
    if facts[0] is not None and (facts[0] > capacity or facts[1] < 0):
        raise ValueError(f"pieces have lengths from {facts[1]} to {facts[0]}, a sequence holds {capacity}")
    given = [F.col(n).alias(c) for c, n in names.items()]
    # Whole sequences are numbered by their rows, all others from 2 ** 60 on.
    packed = all_pieces.filter(F.col("__length") == capacity).select(*given, F.col("__row").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    waiting, n, level = all_pieces.filter(F.col("__length") < capacity).drop("__row"), facts[2], 0
    while n:
        shards = -(-n // shard_pieces)
        place = F.monotonically_increasing_id()
        dealt = waiting.repartition(shards).withColumn("__shard", F.shiftright(place, 33)).withColumn("__at", place.bitwiseAND((1 << 33) - 1))
        items = kept(dealt, "shards")
        solved = kept(_solved(items, shards, capacity, level), "packings")
        on = (F.col("__shard") == F.col("shard")) & (F.col("__at") == F.col("at"))
        number = F.lit((1 << 60) + (level << 54)) + F.col("shard") * (1 << 22) + F.col("bin")
        done = items.join(solved.filter("closed"), on).select(*given, number.alias("sequence_id"), "offset")
        packed = packed.union(done)
        if shards == 1:
            break
        waiting = items.join(solved.filter("not closed"), on).select(*[F.col(c) for c in all_pieces.columns if c != "__row"])
        n, level = solved.filter("not closed").count(), level + 1
    return packed
