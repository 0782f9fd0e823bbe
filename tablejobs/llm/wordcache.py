"""Token ids of texts by words that a Python worker remembers; texts are not shuffled.

The distinct words of some megabytes are looked up in what the worker has encoded before, and only new ones are encoded.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablejobs.llm import flat
from tablejobs.llm.links import kept
from tablejobs.llm.tokens import before_spaces, distinct, ids_of, pack_ids, spread

# Words of each of the two generations that a worker remembers; words forgotten are encoded again.
REMEMBERED = 500_000
TEXT_BYTES = 4_000_000
# Besides white space, texts are cut between a letter and the punctuation after it, which no token crosses.
_WHITE = flat.byte_class((0x20, 0x20), (0x09, 0x0D))
_LETTERS = flat.byte_class((0x41, 0x5A), (0x61, 0x7A))
_PUNCTUATION = flat.byte_class(*[(ord(c), ord(c)) for c in ".,;:!?"])


def _after_letters(data: np.ndarray) -> np.ndarray:
    """Bytes of punctuation behind a letter."""
    out = np.zeros(len(data), bool)
    out[1:] = _LETTERS[data[:-1]] & _PUNCTUATION[data[1:]]
    return out


def _between(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words begin, their letters and their sizes, for a tokenizer that drops white space and reads A-Z as a-z."""
    data = flat.LOWER[data]
    inside = ~_WHITE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin = np.ones(len(data), bool)
    begin[1:] = ~inside[:-1]
    starts = np.flatnonzero(inside & (begin | edge[:-1] | _after_letters(data)))
    rank = np.cumsum(inside)
    return starts, data[inside], np.diff(np.append(rank[starts] - 1, rank[-1:]))


def _before(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As `_between`, for a byte-level tokenizer: every byte is in a word."""
    cut = np.zeros(len(data) + 1, bool)
    cut[before_spaces(data, offsets).starts] = True
    cut[:-1] |= _after_letters(data)
    starts = np.flatnonzero(cut[:-1])
    return starts, data, np.diff(np.append(starts, len(data)))


_CUTS = {"between": _between, "before": _before}


class Encoder:
    """`split` as in `tokens.encode`. Of the known words the latest two generations are remembered."""

    def __init__(self, path: str, split: str) -> None:
        self.path, self.split, self.known, self.older = path, split, {}, {}

    def _found(self, words: list[bytes]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        found = list(map(self.known.get, words))
        if None in found:
            gaps = [i for i, ids in enumerate(found) if ids is None]
            new = []
            for i in gaps:
                found[i] = self.older.get(words[i])
                if found[i] is None:
                    new.append(i)
            sizes, ids = ids_of([words[i].decode() for i in new], self.path, self.split)
            data, low = ids.tobytes(), 0
            for i, high in zip(new, (4 * np.cumsum(sizes)).tolist()):
                found[i] = data[low:high]
                low = high
            self.known.update((words[i], found[i]) for i in gaps)
        return found

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a piece (see `flat.pieces`), and where those of each text begin and end."""
        starts, letters, sizes = _CUTS[self.split](data, offsets)
        words, code = distinct(letters, sizes)
        letters = words.data.tobytes()
        found = self._found([letters[a:b] for a, b in zip(words.starts.tolist(), words.ends.tolist())])
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        tokens = np.frombuffer(b"".join(found), "<u4")
        first = np.cumsum(sizes) - sizes
        ends = np.concatenate([[0], np.cumsum(sizes[code])])
        return tokens[spread(first[code], sizes[code])], ends[np.searchsorted(starts, offsets)]


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder_of(path: str, split: str) -> Encoder:
    """The worker's encoder, kept from one task to the next."""
    if (path, split) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path, split] = Encoder(path, split)
    return _ENCODERS[path, split]


def encode_and_count(
    docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", split: str = "between"
) -> tuple[DataFrame, DataFrame]:
    """(id, n_tokens, packed) and (token, n), as `tokens.encode_and_count` gives them, from one pass over the texts.

    The ids are written to the scratch folder with the counts of each piece, so that both results read them there.
    """
    frame = docs.select(F.col(f"`{id}`").cast("long").alias("__id"), F.col(f"`{text}`").cast("string").alias("__text"))

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path, split)
        for rows, data, offsets in flat.pieces(batches, "__text", TEXT_BYTES):
            ids, bounds = encoder.ids(data, offsets)
            n = np.bincount(ids)
            token = np.flatnonzero(n)
            own = [pack_ids(ids[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            often = [np.stack([token, n[token]]).astype("<i8").tobytes()] + [None] * (len(own) - 1)
            columns = [rows.column("__id"), pa.array(np.diff(bounds)), pa.array(own, pa.binary()), pa.array(often, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["__id", "n_tokens", "packed", "often"])

    def numbers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("often").to_pylist():
                token, n = np.frombuffer(data, "<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(n)], ["token", "n"])

    found = kept(frame.mapInArrow(step, "__id long, n_tokens long, packed binary, often binary"), "ids")
    often = found.filter("often is not null").select("often").mapInArrow(numbers, "token long, n long")
    return found.drop("often").withColumnRenamed("__id", id), often.groupBy("token").agg(F.sum("n").alias("n"))
