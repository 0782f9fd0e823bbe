"""Language identification by inference of a mixture of languages.

A document is a bag of words, each written in one language of the mixture. The likelihood of a word in a language is the
product of the probabilities of its letter trigrams there. Expectation-maximisation estimates the shares of the
languages in the document. Then nested sets of languages, by falling share, are fitted again, up to all whose share is
above LEAST_SHARE, and the set with the largest penalised likelihood stays: each language more must gain PENALTY times
the logarithm of the number of words. No set has a likelihood above 0 here, so the search ends where the penalty of one
language more is beyond the best value.

Trigrams are hashed into BUCKETS cells, so a model has a fixed size for each language. Learning is a map-side reduced
count by language and cell; prediction reads the model from a broadcast and shuffles nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablejobs.llm import flat

BUCKETS = 1 << 16
SMOOTHING = 0.5
ROUNDS, REFITS = 10, 5
LEAST_SHARE = 1e-6
PENALTY = 1.5
MAX_LANGUAGES = 100
UNKNOWN = "und"

_INSIDE = flat.byte_class((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_FOLDED = np.where(_INSIDE, flat.LOWER, 0x20).astype(np.uint32)


@dataclass(frozen=True)
class Model:
    """Languages, and for each the log probability of every trigram cell."""

    languages: tuple[str, ...]
    logs: np.ndarray


class _Letters:
    """Trigram cells around each letter of a piece, word by word; and which documents have words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        words = flat.Words(data, offsets, _INSIDE)
        text = _FOLDED[data]
        before, after = np.full(len(text), 0x20, np.uint32), np.full(len(text), 0x20, np.uint32)
        before[1:], after[:-1] = text[:-1], text[1:]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(text))]
        before[edges], after[edges - 1] = 0x20, 0x20
        inside = _INSIDE[data]
        code = (before | text << np.uint32(8) | after << np.uint32(16))[inside]
        self.cells = ((code * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int32)
        self.word_first = np.cumsum(words.ends - words.starts) - (words.ends - words.starts)
        self.counts = words.counts
        self.doc_first = words.first


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", languages: int = MAX_LANGUAGES) -> Model:
    """A model of the languages in `lang`, from all rows whose text and language are given.

    More than `languages` languages are an error, as each takes BUCKETS cells of the model. No rows give a model without
    languages.
    """
    frame = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    frame = frame.filter("text is not null and lang is not null")
    seen = frame.agg(F.countDistinct("lang").alias("languages")).first()["languages"]
    if seen > languages:
        raise ValueError(f"{seen} languages; at most {languages} fit a model")

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch, data, offsets in flat.pieces(batches, "text"):
            letters = _Letters(data, offsets)
            names = batch.column("lang").to_pylist()
            ends = np.append(letters.word_first, len(letters.cells))[letters.doc_first]
            for d, name in enumerate(names):
                if name not in totals:
                    totals[name] = np.zeros(BUCKETS, np.int64)
            for name in set(names):
                cells = [letters.cells[ends[d] : ends[d + 1]] for d, n in enumerate(names) if n == name]
                totals[name] += np.bincount(np.concatenate(cells), minlength=BUCKETS)
        for name, total in totals.items():
            cell = np.flatnonzero(total)
            columns = [pa.array([name] * len(cell), pa.string()), pa.array(cell), pa.array(total[cell])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "cell", "n"])

    counted = frame.mapInArrow(step, "lang string, cell long, n long")
    found = counted.groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(found.column("lang").to_pylist()))
    place = {name: i for i, name in enumerate(names)}
    counts = np.zeros((len(names), BUCKETS))
    row = np.array([place[x] for x in found.column("lang").to_pylist()], np.int64)
    counts[row, found.column("cell").to_numpy()] = found.column("n").to_numpy()
    counts += SMOOTHING
    return Model(tuple(names), np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32))


def _em(likely: np.ndarray, share: np.ndarray, counts: np.ndarray, first: np.ndarray, rounds: int) -> np.ndarray:
    """Shares (languages x documents) after some rounds; a share of 0 stays 0."""
    for _ in range(rounds):
        weighed = likely * np.repeat(share, counts, axis=1)
        weighed /= np.maximum(weighed.sum(axis=0), 1e-30)
        share = np.add.reduceat(weighed, first, axis=1) / counts
    return share


def _mixtures(model: Model, letters: _Letters) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the languages in each document that has words (0 outside the chosen set), and these documents."""
    docs = np.flatnonzero(letters.counts)
    if not len(docs) or not model.languages:
        return np.zeros((len(model.languages), 0)), docs[:0]
    counts = letters.counts[docs]
    first = np.cumsum(counts) - counts
    logs = np.stack([np.add.reduceat(row[letters.cells], letters.word_first) for row in model.logs])
    best = logs.max(axis=0)
    likely = np.exp(np.maximum(logs - best, -80))
    share = np.full((len(model.languages), len(docs)), 1 / len(model.languages), np.float32)
    share = _em(likely, share, counts, first, ROUNDS)
    order = np.argsort(-share, axis=0, kind="stable")
    ranked = np.take_along_axis(share, order, axis=0)
    chosen, value = np.zeros_like(share), np.full(len(docs), -np.inf)
    penalty = PENALTY * np.log(counts + 1.0)
    for size in range(1, len(model.languages) + 1):
        open_ = value < -penalty * (size - 1)
        if size > 1:
            open_ &= ranked[size - 1] > LEAST_SHARE
        left = np.flatnonzero(open_)
        if not len(left):
            break
        words, n = likely[:, np.repeat(open_, counts)], counts[left]
        begin = np.cumsum(n) - n
        own = np.zeros((len(share), len(left)), share.dtype)
        np.put_along_axis(own, order[:size, left], np.maximum(ranked[:size, left], LEAST_SHARE), axis=0)
        own /= own.sum(axis=0)
        if size > 1:
            own = _em(words, own, n, begin, REFITS)
        fitted = np.log(np.maximum((words * np.repeat(own, n, axis=1)).sum(axis=0), 1e-35), dtype=np.float64)
        now = np.add.reduceat(fitted, begin) - penalty[left] * (size - 1)
        better = now > value[left]
        value[left[better]] = now[better]
        chosen[:, left[better]] = own[:, better]
    return chosen, docs


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with `lang_pred`, `score`, `languages` and `shares` for the whole text.

    `languages` are those of the chosen set by falling share, `lang_pred` the first of them and `score` its share of the
    words. A text that is NULL or has no letter is `und` with score 0 and no languages, and so is any text if the model
    has no languages. Columns of the input with the name of an output column are replaced.
    """
    made = ("lang_pred", "score", "languages", "shares")
    others = [c for c in docs.columns if c not in made]
    plain = docs.select(*[F.col(f"`{c}`") for c in others])
    kinds = [T.StringType(), T.DoubleType(), T.ArrayType(T.StringType()), T.ArrayType(T.DoubleType())]
    schema = T.StructType([*plain.schema.fields, *[T.StructField(n, k) for n, k in zip(made, kinds)]])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        ascii_letter = flat.byte_class((0x41, 0x5A), (0x61, 0x7A))
        for batch, data, offsets in flat.pieces(batches, text):
            found: list[tuple] = [(UNKNOWN, 0.0, [], [])] * batch.num_rows
            seen = np.concatenate([[0], np.cumsum(ascii_letter[data])])[offsets]
            chosen, rows = _mixtures(own, _Letters(data, offsets))
            order = np.argsort(-chosen, axis=0, kind="stable")
            for n, d in enumerate(rows.tolist()):
                if seen[d] == seen[d + 1] and not any(c.isalpha() for c in data[offsets[d] : offsets[d + 1]].tobytes().decode()):
                    continue
                top = order[: np.count_nonzero(chosen[:, n]), n].tolist()
                shares = [min(float(chosen[k, n]), 1.0) for k in top]
                found[d] = (own.languages[top[0]], shares[0], [own.languages[k] for k in top], shares)
            types = [pa.string(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.float64())]
            columns = [pa.array(c, t) for c, t in zip(zip(*found), types)]
            yield pa.RecordBatch.from_arrays([*map(batch.column, others), *columns], [*others, *made])

    return plain.mapInArrow(step, schema)
