"""Token files: the ids of all documents in order of their ids, coded by one shared table (see `rans`).

A folder of token files holds

* `table`: one row, the frequencies by token id (little-endian 32-bit integers);
* `blocks`: one row for each block of whole documents, in ascending order of the document ids, file by file. A block has
  its file's number, the tokens before it in this file, documents and their lengths, lanes, checkpoints, the coded words
  and two checksums: of the coded words and of the decoded ids. Each block can be read by itself.

Blocks are rows of Parquet, so Spark commits them, splits them among tasks and prunes what a reader does not ask for.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablejobs.llm import packed
from tablejobs.llm.rans import Coder, quantised
from tablejobs.llm.tokens import unpack_ids

BLOCK_TOKENS = 1 << 20
# A checkpoint for every LANES * CHECKPOINT_STEPS = 65,536 tokens; its states take about a tenth of the words it covers.
LANES = 1024
CHECKPOINT_STEPS = 64
LEAST_STEPS = 64
FILE_TOKENS = 1 << 23
END = 2

_BLOCK = pa.schema(
    [
        ("file", pa.int32()),
        ("before", pa.int64()),
        ("n_tokens", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("sizes", pa.binary()),
        ("lanes", pa.int32()),
        ("every", pa.int32()),
        ("states", pa.binary()),
        ("places", pa.binary()),
        ("words", pa.binary()),
        ("words_crc", pa.int64()),
        ("ids_crc", pa.int64()),
    ]
)
_BLOCK_DDL = (
    "file int, before bigint, n_tokens bigint, doc_ids array<bigint>, sizes binary, lanes int, every int, states binary, "
    "places binary, words binary, words_crc bigint, ids_crc bigint"
)


def _coded(coder: Coder, file: int, before: int, docs: list, ids: list[np.ndarray]) -> dict:
    joined = np.concatenate(ids)
    # Few tokens take few lanes, so that states never outweigh words.
    lanes = min(LANES, max(1, len(joined) // LEAST_STEPS))
    words, states, places = coder.encode(joined, lanes, CHECKPOINT_STEPS)
    return {
        "file": file,
        "before": before,
        "n_tokens": len(joined),
        "doc_ids": docs,
        "sizes": packed.pack_numbers(np.array([len(x) for x in ids])),
        "lanes": lanes,
        "every": CHECKPOINT_STEPS,
        "states": states,
        "places": places,
        "words": words,
        "words_crc": zlib.crc32(words),
        "ids_crc": zlib.crc32(joined.astype("<u4").tobytes()),
    }


def write_tokens(
    tokens: DataFrame, counts: DataFrame, n_docs: int, path: str, id: str = "doc_id", ids: str = "packed", end: int = END
) -> None:
    """Writes `tokens` (id, packed ids, see `tokens.pack_ids`), with the id `end` after each document.

    `counts` (token, n) tells how often each id occurs, without the ends, of which there are `n_docs`. Its rows are bounded by the vocabulary, which
    must fit the table. NULL ids are a document of the end id alone; rows of a repeated document id stay rows of their
    own, in the order of their ids; a NULL document id comes first. An empty input makes a table and no blocks.
    """
    spark = tokens.sparkSession
    known = counts.toArrow()
    token, n = known.column("token").to_numpy(), known.column("n").to_numpy()
    often = np.zeros(max(int(token.max()) if len(token) else 0, end) + 1, np.int64)
    often[token] = n
    often[end] += n_docs
    freq = quantised(often)
    files = max(1, math.ceil(int(often.sum()) / FILE_TOKENS), spark.sparkContext.defaultParallelism)
    table = pa.table({"frequencies": pa.array([freq.astype("<i4").tobytes()], pa.binary())})
    spark.createDataFrame(table).coalesce(1).write.parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast(Coder(freq))

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, file = shared.value, TaskContext.get().partitionId()
        before, held, docs, waiting = 0, 0, [], []
        for batch in batches:
            for doc, data in zip(batch.column("id").to_pylist(), batch.column("ids").to_pylist()):
                docs.append(doc)
                waiting.append(np.append(unpack_ids(data), np.uint32(end)))
                held += len(waiting[-1])
                if held >= BLOCK_TOKENS:
                    yield pa.RecordBatch.from_pylist([_coded(coder, file, before, docs, waiting)], _BLOCK)
                    before, held, docs, waiting = before + held, 0, [], []
        if docs:
            yield pa.RecordBatch.from_pylist([_coded(coder, file, before, docs, waiting)], _BLOCK)

    small = tokens.select(F.col(id).alias("id"), F.col(ids).alias("ids"))
    ordered = small.repartitionByRange(files, "id").sortWithinPartitions(F.col("id").asc_nulls_first(), "ids")
    ordered.mapInArrow(blocks, _BLOCK_DDL).write.option("compression", "none").parquet(f"{path}/blocks")


def _reader(spark: SparkSession, path: str):
    table = spark.read.parquet(f"{path}/table").first()[0]
    return spark.sparkContext.broadcast(np.frombuffer(table, "<i4"))


_CODERS: dict[bytes, Coder] = {}


def _coder(freq: np.ndarray) -> Coder:
    """The coder of a table, kept by a worker from one task to the next."""
    key = freq.tobytes()
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = Coder(freq)
    return _CODERS[key]


def _checked(coder: Coder, row: dict) -> np.ndarray:
    if zlib.crc32(row["words"]) != row["words_crc"]:
        raise ValueError("checksum of a block's words")
    ids = coder.decode(row["n_tokens"], row["lanes"], row["every"], row["words"], row["states"], row["places"])
    if zlib.crc32(ids.astype("<u4").tobytes()) != row["ids_crc"]:
        raise ValueError("checksum of a block's ids")
    return ids


def read_tokens(spark: SparkSession, path: str, id: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids) of all documents: ids with the end id, `start` the ids of all documents before."""
    shared = _reader(spark, path)
    blocks = spark.read.schema(_BLOCK_DDL).parquet(f"{path}/blocks")
    # One row for each file, of FILE_TOKENS tokens or more.
    totals = sorted((r["file"], r["n"]) for r in blocks.groupBy("file").agg(F.sum("n_tokens").alias("n")).collect())
    begin, total = {}, 0
    for file, n in totals:
        begin[file], total = total, total + n
    begins = spark.sparkContext.broadcast(begin)

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared.value)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                data = _checked(coder, row).astype("<u4").tobytes()
                sizes = packed.unpack_numbers(row["sizes"]).astype(np.int64)
                ends = np.cumsum(sizes)
                texts = [data[4 * (b - n) : 4 * b] for b, n in zip(ends.tolist(), sizes.tolist())]
                start = begins.value[row["file"]] + row["before"] + ends - sizes
                columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(start), pa.array(sizes), pa.array(texts, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, [id, "start", "n_tokens", "ids"])

    return blocks.mapInArrow(step, f"`{id}` long, start long, n_tokens long, ids binary")


def read_from_checkpoints(spark: SparkSession, path: str, file: int, start: int, stop: int) -> DataFrame:
    """(start, ids) of the tokens start .. stop - 1 of a file, decoded from the checkpoints around them only."""
    shared = _reader(spark, path)
    blocks = spark.read.schema(_BLOCK_DDL).parquet(f"{path}/blocks")
    blocks = blocks.filter((F.col("file") == file) & (F.col("before") < stop) & (F.col("before") + F.col("n_tokens") > start))

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared.value)
        for row in (row for batch in batches for row in batch.to_pylist()):
            low, high = max(start - row["before"], 0), min(stop - row["before"], row["n_tokens"])
            grain = row["lanes"] * row["every"]
            first, last = low // grain, -(-high // grain)
            end = last if last * grain < row["n_tokens"] else None
            found = coder.decode(row["n_tokens"], row["lanes"], row["every"], row["words"], row["states"], row["places"], first, end)
            data = found[low - first * grain : high - first * grain].astype("<u4").tobytes()
            columns = [pa.array([row["before"] + low]), pa.array([data], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["start", "ids"])

    return blocks.mapInArrow(step, "start long, ids binary")
