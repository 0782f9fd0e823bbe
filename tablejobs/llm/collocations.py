"""Collocations of each language by SON partitioning, with exact counts.

A phrase that occurs `support` times in all documents occurs `support * share` times in at least one shard, whatever the
shares are, as long as they add up to one. So

1. the documents are dealt to a few shards by the part of the input they lie in, and each shard is mined completely: all
   its phrases of 1 to 3 words are counted by a hash, and those at the shard's proportionally lowered support stay;
2. the union of the locally frequent hashes becomes a bit filter of bounded size, shared with every task;
3. all documents are read again, and each phrase whose hash is in the filter is counted, by its words, over all shards.

A hash that two phrases share, or a filter that is full, only lets more phrases into the exact count; none is lost and none
is counted for another. Within a batch words get codes from a dictionary of their bytes and phrases codes from the codes of
their words, so equality never rests on a hash. Counts are reduced in the batch and on the map side before they are
shuffled, so a phrase in every document is one row for each task.

Parts of a candidate occur at least as often as the candidate, so the counts of all phrases at the support hold every count
that the score needs.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablejobs.llm import flat, packed
from tablejobs.llm.links import kept
from tablejobs.llm.tokens import spread

SUPPORT, LONGEST, SHARDS, RANKS = 10, 3, 4, 2000
BATCH_BYTES, RANGE_BYTES = 4_000_000, 16_000_000
# Ranges that a batch is dealt to at once; more of them are reached in two steps.
_AT_ONCE, _BUFFER = 4096, 8_000_000
# The filter has 16 bits for each locally frequent phrase, between these sizes: 128 KB and 16 MB.
_LEAST_BITS, _MOST_BITS = 20, 27
_BREAKS = flat.byte_class((0x0A, 0x0D), *[(ord(c), ord(c)) for c in ".,;:!?"])
_IN_WORD = ~(_BREAKS | flat.byte_class((0x20, 0x20), (0x09, 0x09)))
_STEP = np.uint64(0x9E3779B97F4A7C15)


class _Phrases:
    """The distinct phrases of some documents, with their language, counts and hashes."""

    def __init__(self, rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> None:
        data = flat.LOWER[data]
        words = flat.Words(data, offsets, _IN_WORD)
        doc = words.doc()
        breaks = np.concatenate([[0], np.cumsum(_BREAKS[data])])
        piece = breaks[words.starts] + doc
        # All words with one space behind each: phrases are slices of this.
        sizes = words.ends - words.starts + 1
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.text = np.append(data, np.uint8(0x20))[spread(words.starts, sizes)]
        self.text[self.ends - 1] = 0x20
        bounds = np.append(self.starts, self.ends[-1:] if len(words) else [0]).astype(np.int64)
        spelled = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(words), [None, pa.py_buffer(bounds), pa.py_buffer(self.text)]
        ).dictionary_encode()
        word = spelled.indices.to_numpy(zero_copy_only=False).astype(np.uint64)
        n_words = np.uint64(max(len(spelled.dictionary), 1))
        letters, ends = flat.raw(spelled.dictionary)
        word_hash = flat.Words.between(letters, ends, ends[:-1], ends[1:]).hashes()
        langs = rows.column("__lang").dictionary_encode()
        self.langs = langs.dictionary
        own = langs.indices.to_numpy(zero_copy_only=False).astype(np.uint64)
        letters, ends = flat.raw(self.langs)
        lang_hash = flat.Words.between(letters, ends, ends[:-1], ends[1:]).hashes()
        self.lang = own[doc]
        self.totals = np.bincount(own.astype(np.int64), weights=np.diff(words.first), minlength=len(self.langs))
        code, n_codes, hashed = self.lang, len(self.langs), lang_hash[self.lang] if len(self.langs) else self.lang
        self.found = []
        for width in range(1, LONGEST + 1):
            at = np.arange(len(words) - width + 1)
            if width > 1:
                at = at[piece[at] == piece[at + width - 1]]
            groups = packed.Groups(code[at] * n_words + word[at + width - 1], bits=(n_codes * int(n_words)).bit_length())
            first = at[groups.order[groups.begins]]
            h = flat.mix(hashed[first] * _STEP + word_hash[word[first + width - 1]])
            self.found.append((width, first, groups.sizes(), h))
            # The codes and hashes of phrases one word longer are made from these, by the place of the first word.
            place = groups.spread(np.arange(len(first), dtype=np.uint64))
            code, hashed, n_codes = np.zeros(len(words), np.uint64), np.zeros(len(words), np.uint64), max(len(first), 1)
            code[at], hashed[at] = place, h[place.astype(np.int64)] if len(at) else h

    def strings(self, first: np.ndarray, width: int) -> pa.Array:
        """The phrases of `width` words that begin at the words `first`."""
        low, high = self.starts[first], self.ends[first + width - 1] - 1
        sizes = high - low
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        letters = self.text[spread(low, sizes)]
        return pa.StringArray.from_buffers(len(first), pa.py_buffer(ends), pa.py_buffer(letters))


def _frame(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(
        F.col(f"`{text}`").cast("string").alias("__text"), F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("__lang")
    )


def _phrases(batches: Iterable[pa.RecordBatch]) -> Iterator[_Phrases]:
    for rows, data, offsets in flat.pieces(batches, "__text", BATCH_BYTES):
        yield _Phrases(rows, data, offsets)


def local_supports(docs: DataFrame, support: int, shards: int) -> list[int]:
    """The least count in each shard, in proportion to its part of the text, rounded up."""
    size = F.coalesce(F.octet_length("__text"), F.lit(0)).cast("long")
    found = docs.groupBy(_shard(shards).alias("shard")).agg(F.sum(size).alias("n")).collect()
    total = sum(r.n for r in found)
    share = {r.shard: r.n / total for r in found if r.n}
    # A little less than the exact product, which a rounded quotient could pass.
    return [max(math.ceil(support * share.get(s, 0.0) - 1e-6), 1) for s in range(shards)]


def _shard(shards: int) -> Column:
    return F.pmod(F.spark_partition_id(), F.lit(shards))


def locally_frequent(docs: DataFrame, support: int = SUPPORT, shards: int = SHARDS) -> DataFrame:
    """(hash): of every phrase that reaches the lowered support in a shard. `docs` has `__text` and `__lang`.

    A batch sends its hashes with their counts, cut off at the support, in the low bits; a range adds them up. The number of
    ranges grows with the text, so a range holds about as much at every size.
    """
    spark = docs.sparkSession
    low = np.uint64((1 << support.bit_length()) - 1)
    least = local_supports(docs, support, shards)
    total = docs.agg(F.sum(F.octet_length("__text").cast("long"))).first()[0] or 0
    ranges = max(math.ceil(total / RANGE_BYTES), 2 * spark.sparkContext.defaultParallelism)
    first = ranges if ranges <= _AT_ONCE else math.isqrt(ranges - 1) + 1
    inner = -(-ranges // first)
    schema = pa.schema([("shard", pa.int32()), ("range", pa.int64()), ("keys", pa.binary())])

    def dealt(shard: int, keys: np.ndarray, ranges: int) -> pa.RecordBatch:
        bounds = packed.range_bounds(keys, ranges, 64)
        own = np.flatnonzero(bounds[1:] > bounds[:-1])
        data = [packed.pack_sorted(keys[bounds[r] : bounds[r + 1]]) for r in own]
        columns = [pa.array(np.full(len(own), shard, np.int32)), pa.array(own), pa.array(data, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId() % shards
        for phrases in _phrases(batches):
            keys = np.concatenate([h & ~low | np.minimum(n, int(low)).astype(np.uint64) for _, _, n, h in phrases.found])
            keys.sort()
            yield dealt(shard, keys, first)
            flat.release()

    def dealt_again(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[tuple[int, int], list[np.ndarray]] = {}
        size = 0
        for row in (r for b in batches for r in b.to_pylist()):
            own = packed.unpack_sorted(row["keys"])
            waiting.setdefault((row["shard"], row["range"]), []).append(own)
            size += len(own)
            if size > _BUFFER:
                yield from (dealt(shard, np.sort(np.concatenate(own)), first * inner) for (shard, _), own in waiting.items())
                waiting, size = {}, 0
        yield from (dealt(shard, np.sort(np.concatenate(own)), first * inner) for (shard, _), own in waiting.items())

    def added(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        keys = np.concatenate([packed.unpack_sorted(data) for data in table.column("keys").to_pylist()])
        keys.sort()
        counts, keys = (keys & low).astype(np.int64), keys & ~low
        begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        found = keys[begins][np.add.reduceat(counts, begins) >= least[shard]]
        flat.release()
        return pa.table({"hash": pa.array(found.view(np.int64))})

    sent = docs.mapInArrow(count, "shard int, range long, keys binary")
    if inner > 1:
        sent = sent.repartition("shard", "range").mapInArrow(dealt_again, "shard int, range long, keys binary")
    return sent.groupBy("shard", "range").applyInArrow(added, "hash long")


def bit_filter(hashes: DataFrame, n: int) -> np.ndarray:
    """Bits by the leading bits of the hashes, eight to a byte; no larger than 16 MB whatever `n`, their number, is."""
    bits = min(max((16 * max(n, 1)).bit_length(), _LEAST_BITS), _MOST_BITS)
    place = F.shiftrightunsigned("hash", 64 - bits)
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    cells = hashes.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("cell")).agg(F.bit_or(bit).alias("bits"))
    rows = cells.toArrow()
    found = np.zeros(1 << (bits - 6), np.int64)
    found[rows.column("cell").to_numpy()] = rows.column("bits").to_numpy()
    return found.view(np.uint8)


def counts_of(docs: DataFrame, support: int = SUPPORT, shards: int = SHARDS) -> DataFrame:
    """(lang, width, phrase, n) of every phrase of 1 to 3 words with n >= `support`, and rows of width 0 with the number of all
    words of the language."""
    frequent = kept(locally_frequent(docs, support, shards), "local-phrases")
    bits = bit_filter(frequent, frequent.count())
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    shift = np.uint64(64 - (8 * len(bits)).bit_length() + 1)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        candidates = shared.value
        names = ["lang", "width", "phrase", "n"]
        for phrases in _phrases(batches):
            n = len(phrases.langs)
            columns = [phrases.langs, pa.array(np.zeros(n, np.int32)), pa.array([""] * n, pa.string()), pa.array(phrases.totals.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names)
            for width, first, sizes, h in phrases.found:
                place = (h >> shift).astype(np.int64)
                hit = (candidates[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
                first = first[hit]
                own = phrases.langs.take(pa.array(phrases.lang[first].astype(np.int64)))
                columns = [own, pa.array(np.full(len(first), width, np.int32)), phrases.strings(first, width), pa.array(sizes[hit].astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names)
            flat.release()

    counted = docs.mapInArrow(count, "lang string, width int, phrase string, n long")
    return kept(
        counted.groupBy("lang", "width", "phrase").agg(F.sum("n").alias("n")).filter((F.col("width") == 0) | (F.col("n") >= support)),
        "phrases",
    )


def _scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of all candidates, by their lowest cut."""
    words = F.split("phrase", " ")
    cuts = [
        F.struct(
            F.lit(k).alias("k"),
            F.array_join(F.slice(words, 1, k), " ").alias("head"),
            F.array_join(F.slice(words, F.lit(k + 1), F.size(words) - k), " ").alias("tail"),
        )
        for k in range(1, LONGEST)
    ]
    pairs = counts.filter("width > 1").select(
        "lang", "phrase", F.col("n").alias("a"), F.inline(F.slice(F.array(*cuts), F.lit(1), F.col("width") - 1))
    )
    parts = counts.filter("width > 0")
    left = parts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    # Long multiplication in decimals of 38 digits; the quotient fits a long since a is no greater than l and r.
    score = F.expr("(cast(a as decimal(16)) * cast(a as decimal(16)) * 1000000) div (cast(l as decimal(19)) * cast(r as decimal(19)))")
    cut = F.struct(score.alias("score"), "k", "l", "r")
    found = pairs.join(left, ["lang", "head"]).join(right, ["lang", "tail"])
    return found.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.min(cut).alias("cut")).select("lang", "phrase", "a", "cut.*")


def _covered(counts: DataFrame) -> DataFrame:
    """(lang, phrase, longest): the highest count of a longer candidate around a candidate."""
    words = F.split("phrase", " ")
    inner = [
        F.array_join(F.slice(words, start, width), " ")
        for width in range(2, LONGEST)
        for start in range(1, LONGEST - width + 2)
    ]
    longer = counts.filter(F.col("width") == LONGEST).select("lang", "n", F.explode(F.array(*inner)).alias("phrase"))
    return longer.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", support: int = SUPPORT, shards: int = SHARDS, ranks: int = RANKS
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first `ranks` phrases of 2 or 3 words of each language.

    Texts are lower-cased (A-Z) and cut into pieces at `.,;:!?` and line ends, pieces into words at spaces and tabs. A phrase
    occurs `a >= support` times inside pieces, overlaps included; its best cut into two parts that occur l and r times scores
    floor(1000000 * a * a / (l * r)), and the lowest-scoring cut counts. Phrases inside a longer one that occurs at least half
    as often are dropped. Ties fall to the higher a, then to the phrase in the order of its bytes.

    NULL and empty texts have no words; a NULL language is `und`. Repeated rows count each. An empty table has no rows.
    """
    counts = counts_of(_frame(docs, text, lang), support, shards)
    totals = counts.filter("width = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    found = _scored(counts).join(_covered(counts), ["lang", "phrase"], "left")
    found = found.filter("longer is null or 100 * longer < 50 * a")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= ranks)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
