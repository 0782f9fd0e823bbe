"""Token ids of texts by a table of distinct words, and texts of token ids by a table of pieces.

A block of documents is split into words; each distinct word gets its place in the block, in the order of the words'
hashes. The block sends its distinct words, dealt by ranges of the hash. A range gathers the words of all blocks, encodes
each distinct word once, and answers every block with ids in the order asked. Words are told apart by their bytes; the hash
only deals them. The documents of the block, kept as places, turn into ids by looking up their places. So a word costs the tokenizer once however often it occurs, a frequent word is
one entry for each block, and texts are not shuffled: only places are.

A block is known by a hash of its words. Should a task that runs again meet other documents in a block, the id differs
and the job stops with an error instead of mixing up places.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablejobs.llm import flat, packed
from tablejobs.llm.links import kept

BLOCK_BYTES = 5_000_000
_BATCH = 5_000
_ANY_SPACE = flat.byte_class((0x20, 0x20), (0x09, 0x0A), (0x0D, 0x0D))
# First bytes of characters that are certainly no white space.
_NO_SPACE_FIRST = flat.byte_class((0x21, 0x7E), (0xC3, 0xDF), (0xE0, 0xE0), (0xE4, 0xF4))


def between_spaces(data: np.ndarray, offsets: np.ndarray) -> flat.Words:
    """Words between spaces, tabs and line ends, for a tokenizer that drops white space."""
    return flat.Words(data, offsets, ~_ANY_SPACE)


def before_spaces(data: np.ndarray, offsets: np.ndarray) -> flat.Words:
    """The whole text cut before each space that a character other than white space follows.

    A byte-level tokenizer puts such a space in front of the word after it, so no token crosses a cut.
    """
    cut = np.zeros(len(data) + 1, bool)
    cut[:-2] = (data[:-1] == 0x20) & _NO_SPACE_FIRST[data[1:]] if len(data) else cut[:-2]
    cut[offsets] = True
    bounds = np.flatnonzero(cut)
    return flat.Words.between(data, offsets, bounds[:-1], bounds[1:])


SPLITS = {"between": between_spaces, "before": before_spaces}


@functools.lru_cache(maxsize=2)
def tokenizer_of(path: str):
    """The tokenizer of a file, without truncation and padding, on one thread; a worker loads it once."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def pack_ids(ids: np.ndarray) -> bytes:
    """Ids as compressed integers of 16 or 32 bits; the first byte tells how many bytes each has."""
    width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    return bytes([width]) + _shrunk(ids.astype(f"<u{width}").tobytes())


def unpack_ids(data: bytes | None) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint32)
    return np.frombuffer(_grown(data[1:]), f"<u{data[0]}").astype(np.uint32)


def _planes(data: bytes, width: int) -> bytes:
    """First bytes of all numbers, then second bytes and so on, which compress better apart."""
    return np.frombuffer(data, np.uint8).reshape(-1, width).T.tobytes()


def _joined(data: bytes, width: int) -> bytes:
    return np.frombuffer(data, np.uint8).reshape(width, -1).T.tobytes()


class _Block:
    """Distinct words of some documents by hash, and the documents as places in this list."""

    def __init__(self, pieces: list) -> None:
        ids, letters, sizes, counts = zip(*pieces)
        self.ids = [i for own in ids for i in own]
        self.counts = np.concatenate(counts)
        own, code = distinct(np.concatenate(letters), np.concatenate(sizes))
        hashes = own.hashes()
        order = packed.order_of(hashes)
        self.hashes = hashes[order]
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        self.places = place[code]
        self.sizes = (own.ends - own.starts)[order]
        self._letters = own.data[spread(own.starts[order], self.sizes)]
        self._ends = np.concatenate([[0], np.cumsum(self.sizes)])
        total = flat.mix(self.hashes ^ np.uint64(0x2545F4914F6CDD1D)).sum(dtype=np.uint64)
        self.name = int(total.view(np.int64))

    def letters(self, low: int, high: int) -> bytes:
        """The distinct words low .. high - 1, one after the other."""
        return self._letters[self._ends[low] : self._ends[high]].tobytes()


def distinct(letters: np.ndarray, sizes: np.ndarray) -> tuple[flat.Words, np.ndarray]:
    """The distinct words of a run of words, and for each word which of them it is; compared byte by byte."""
    bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(bounds), pa.py_buffer(letters)])
    coded = column.dictionary_encode()
    data, ends = flat.raw(coded.dictionary)
    return flat.Words.between(data, ends, ends[:-1], ends[1:]), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _blocks(batches: Iterable[pa.RecordBatch], split: str) -> Iterator[_Block]:
    waiting, size = [], 0
    for batch, data, offsets in flat.pieces(batches, "__text"):
        words = SPLITS[split](data, offsets)
        sizes = words.ends - words.starts
        # The words one after the other: all bytes, or all but the white space between words.
        letters = data if int(sizes.sum()) == len(data) else data[~_ANY_SPACE[data]]
        waiting.append((batch.column("__id").to_pylist(), letters, sizes, words.counts))
        size += len(data)
        if size >= BLOCK_BYTES:
            yield _Block(waiting)
            waiting, size = [], 0
    if waiting:
        yield _Block(waiting)


@functools.cache
def _compressors() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    """One pair for a worker: making them costs more than a short text does."""
    return zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def _shrunk(data: bytes) -> bytes:
    return _compressors()[0].compress(data)


def _grown(data: bytes) -> bytes:
    return _compressors()[1].decompress(data)


def encode(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", split: str = "between") -> DataFrame:
    """(id, n_tokens, ids) of every row of `docs`: ids as little-endian unsigned 32-bit integers, as the tokenizer of
    `path` gives them for the whole text without special tokens added.

    `split` names the cuts that this tokenizer never crosses: "between" spaces if it drops them, "before" spaces if it
    is byte-level. NULL and empty texts have no ids. Rows of a repeated id are each encoded; a NULL id stays NULL. An id
    is a 64-bit integer.
    """
    return _encode(docs, path, id, text, split)[0]


def encode_and_decode(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", split: str = "between") -> DataFrame:
    """As `encode`, with the text of the ids as `decoded` (see `decode`), made where the ids are."""
    return _encode(docs, path, id, text, split, decoded=True)[0]


def encode_and_count(
    docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", split: str = "between"
) -> tuple[DataFrame, DataFrame]:
    """(id, n_tokens, packed) as `encode` with the ids packed (see `pack_ids`), and (token, n): how often each id occurs in
    all documents, counted on the table of words."""
    return _encode(docs, path, id, text, split, counted=True)


def ids_of(words: list[str], path: str, split: str) -> tuple[np.ndarray, np.ndarray]:
    """How many ids each word has, and all ids in order.

    Some thousands of words are encoded as one text where the ids tell where one ends, which a tokenizer reads faster than
    single words: no token crosses a cut. Words cut before spaces begin with the only piece that has a space in front; words
    of letters end with the only piece that has the suffix of word ends. All others are encoded alone.
    """
    tokenizer = tokenizer_of(path)
    if split == "before":
        mark, glue = _begins_with_space(path), ""
        joined = [i for i, w in enumerate(words) if w[0] == " " and w.count(" ") == 1]
    else:
        mark, glue = _ends_words(path), " "
        # Lower case may hold marks that the letters do not.
        joined = [i for i, w in enumerate(words) if w.isalpha() and w.lower().isalpha()] if mark.any() else []
    parts = [joined[start : start + _BATCH] for start in range(0, len(joined), _BATCH)]
    single = set(joined)
    alone = [i for i in range(len(words)) if i not in single]
    sizes, order, out = np.zeros(len(words), np.int64), [], [np.zeros(0, "<u4")]
    texts = (glue.join([words[i] for i in part]) for part in parts)
    for part, text in zip(parts, texts):
        ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        at = np.flatnonzero(mark[ids])
        if len(at) != len(part):  # a vocabulary of other rules
            alone += part
            continue
        sizes[part] = np.diff(np.append(at, len(ids))) if split == "before" else np.diff(np.append(-1, at))
        order += part
        out.append(ids)
    for start in range(0, len(alone), _BATCH):
        part = alone[start : start + _BATCH]
        found = [e.ids for e in tokenizer.encode_batch_fast([words[i] for i in part], add_special_tokens=False)]
        sizes[part] = [len(ids) for ids in found]
        order += part
        out.append(np.array([t for ids in found for t in ids], "<u4"))
    ids = np.concatenate(out)
    first = np.zeros(len(words), np.int64)
    first[order] = np.cumsum(sizes[order]) - sizes[order]
    return sizes, ids[spread(first, sizes)]


@functools.lru_cache(maxsize=2)
def _ends_words(path: str) -> np.ndarray:
    """Which pieces of a vocabulary with a suffix of word ends have it."""
    vocabulary = tokenizer_of(path)
    suffix = getattr(vocabulary.model, "end_of_word_suffix", None)
    return np.array([bool(suffix) and (vocabulary.id_to_token(i) or "").endswith(suffix) for i in range(vocabulary.get_vocab_size())])


@functools.lru_cache(maxsize=2)
def _begins_with_space(path: str) -> np.ndarray:
    """Which pieces of a byte-level vocabulary begin with a space."""
    vocabulary = tokenizer_of(path)
    return np.array([(vocabulary.id_to_token(i) or "").startswith("\u0120") for i in range(vocabulary.get_vocab_size())])


def _encode(
    docs: DataFrame, path: str, id: str, text: str, split: str, counted: bool = False, decoded: bool = False
) -> tuple[DataFrame, DataFrame | None]:
    if split not in SPLITS:
        raise ValueError(f"split must be one of {sorted(SPLITS)}, not {split!r}")
    shared = _pieces(docs, path) if decoded else None
    ranges = max(packed.number_of_batches(docs, text) // 2, 2 * docs.sparkSession.sparkContext.defaultParallelism)
    frame = docs.select(F.col(f"`{id}`").cast("long").alias("__id"), F.col(f"`{text}`").cast("string").alias("__text"))

    def words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, split):
            bounds = packed.range_bounds(block.hashes, ranges, 64)
            own = [r for r in range(ranges) if bounds[r] < bounds[r + 1]]
            often = np.bincount(block.places, minlength=len(block.hashes)) if counted else None
            # Lengths apart from the letters: a word of a text may hold any character.
            columns = [
                pa.array(own, pa.int32()),
                pa.array([block.name] * len(own), pa.int64()),
                pa.array([packed.pack_numbers(block.sizes[bounds[r] : bounds[r + 1]]) for r in own], pa.binary()),
                pa.array([_shrunk(block.letters(bounds[r], bounds[r + 1])) for r in own], pa.binary()),
                pa.array([packed.pack_numbers(often[bounds[r] : bounds[r + 1]]) if counted else None for r in own], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["range", "block", "sizes", "words", "often"])

    def places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, split):
            columns = [
                pa.array([block.name], pa.int64()),
                pa.array([block.ids], pa.list_(pa.int64())),
                pa.array([block.counts.astype("<i8").tobytes()], pa.binary()),
                pa.array([_shrunk(_planes(block.places.astype("<u4").tobytes(), 4))], pa.binary()),
                pa.array([len(block.hashes)], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["block", "ids", "counts", "places", "n_words"])

    def encoded(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        lengths = [packed.unpack_numbers(row["sizes"]).astype(np.int64) for row in rows]
        data = np.frombuffer(b"".join(_grown(row["words"]) for row in rows), np.uint8)
        words, code = distinct(data, np.concatenate(lengths))
        asked = np.split(code, np.cumsum([len(x) for x in lengths])[:-1])
        part = [words.data[a:b].tobytes().decode() for a, b in zip(words.starts.tolist(), words.ends.tolist())]
        sizes, flat_ids = ids_of(part, path, split)
        first = np.concatenate([[0], np.cumsum(sizes)])
        out, often = [], np.zeros(len(part), np.int64)
        for row, at in zip(rows, asked):
            ids = flat_ids[spread(first[at], sizes[at])]
            answer = {"sizes": packed.pack_numbers(sizes[at]), "tokens": _shrunk(packed.pack_numbers(ids.astype(np.uint64)))}
            out.append({"block": row["block"], "range": row["range"], **answer})
            if counted:
                often[at] += packed.unpack_numbers(row["often"]).astype(np.int64)
        if counted:
            token, place = np.unique(flat_ids, return_inverse=True)
            n = np.zeros(len(token), np.int64)
            np.add.at(n, place, np.repeat(often, sizes))
            answer = {"sizes": n.astype("<i8").tobytes(), "tokens": token.astype("<u4").tobytes()}
            out.append({"block": None, "range": rows[0]["range"], **answer})
        flat.release()
        kind = pa.schema([("block", pa.int64()), ("range", pa.int32()), ("sizes", pa.binary()), ("tokens", pa.binary())])
        return pa.Table.from_pylist(out, kind)

    def looked_up(documents: pa.Table, answers: pa.Table) -> pa.Table:
        ids, counts, texts = [], [], []
        known = {r["range"]: r for r in answers.to_pylist()}
        ordered = [known[r] for r in sorted(known)]
        sizes = np.concatenate([packed.unpack_numbers(r["sizes"]).astype(np.int64) for r in ordered] or [np.zeros(0, np.int64)])
        tokens = np.concatenate([packed.unpack_numbers(_grown(r["tokens"])) for r in ordered] or [np.zeros(0)]).astype("<u4")
        first = np.concatenate([[0], np.cumsum(sizes)])
        for row in documents.to_pylist():
            if row["n_words"] != len(sizes):
                raise ValueError("a block of documents was read in two different ways; write the input to a table first")
            at = np.frombuffer(_joined(_grown(row["places"]), 4), "<u4").astype(np.int64)
            ends = np.cumsum(np.frombuffer(row["counts"], "<i8"))
            total = np.concatenate([[0], np.cumsum(sizes[at])])[np.concatenate([[0], ends])]
            found = tokens[spread(first[at], sizes[at])]
            ids += row["ids"]
            counts += np.diff(total).tolist()
            bounds = zip(total[:-1].tolist(), total[1:].tolist())
            texts += [pack_ids(found[a:b]) if counted else found[a:b].tobytes() for a, b in bounds]
        columns = [pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(texts, pa.binary())]
        names = ["__id", "n_tokens", "packed" if counted else "ids"]
        if decoded:
            columns.append(pa.array([_text(data, shared.value) for data in texts], pa.string()))
            names.append("decoded")
        flat.release()
        return pa.Table.from_arrays(columns, names)

    def numbers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                columns = [np.frombuffer(row["tokens"], "<u4").astype(np.int64), np.frombuffer(row["sizes"], "<i8")]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "n"])

    asked = frame.mapInArrow(words, "range int, block long, sizes binary, words binary, often binary")
    table = asked.repartition(ranges, "range").groupBy("range")
    answers = table.applyInArrow(encoded, "block long, range int, sizes binary, tokens binary")
    counts = None
    if counted:
        answers = kept(answers, "words")
        counts = answers.filter("block is null").mapInArrow(numbers, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
        answers = answers.filter("block is not null")
    sent = frame.mapInArrow(places, "block long, ids array<long>, counts binary, places binary, n_words long")
    both = sent.repartition(ranges, "block").groupBy("block").cogroup(answers.groupBy("block"))
    found = both.applyInArrow(looked_up, f"__id long, n_tokens long, {'packed' if counted else 'ids'} binary" + ", decoded string" * decoded)
    return found.withColumnRenamed("__id", id), counts


def spread(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions first[0], first[0] + 1, ... of runs of the given sizes, one after the other."""
    total = int(sizes.sum())
    begin = np.cumsum(sizes) - sizes
    return np.arange(total) + np.repeat(first - begin, sizes)


def _pieces(frame: DataFrame, path: str):
    """The piece of each id, shared with every task: one entry for each id of the vocabulary."""
    vocabulary = tokenizer_of(path)
    if vocabulary.decoder is not None:
        raise ValueError("this tokenizer has a decoder of its own")
    pieces = [vocabulary.id_to_token(i) for i in range(vocabulary.get_vocab_size())]
    if any(p is None for p in pieces):
        raise ValueError("the vocabulary has gaps")
    return frame.sparkSession.sparkContext.broadcast(pieces)


def _text(ids: bytes | None, pieces: list[str]) -> str:
    return " ".join([pieces[i] for i in np.frombuffer(ids, "<u4").tolist() if i < len(pieces)]) if ids else ""


def decode(tokens: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """`tokens` with the text of `ids` (little-endian unsigned 32-bit integers), special tokens shown.

    The table of pieces by id has one row for each id of the tokenizer, so its size is bounded by the vocabulary, and every
    task holds it as a list to join by position. It fits tokenizers without a decoder, whose text is the pieces joined by
    a space. NULL and empty ids give the empty text; an id that the vocabulary lacks is passed over.
    """
    shared = _pieces(tokens, path)
    others = [c for c in tokens.columns if c != name]

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = [_text(data, table) for data in part.column(ids).to_pylist()]
                yield pa.RecordBatch.from_arrays([*map(part.column, others), pa.array(texts, pa.string())], [*others, name])

    schema = T.StructType([*tokens.select(*[F.col(f"`{c}`") for c in others]).schema.fields, T.StructField(name, T.StringType())])
    return tokens.mapInArrow(step, schema)
