"""Toxicity by a weighted lexicon.

Texts are folded first: lower case, accents off, look-alike letters and digits that stand for letters become the plain
letter, everything else a space. An Aho-Corasick automaton finds all terms of the lexicon as whole words, and all exception
phrases; a term inside an exception phrase does not count. The weights of the terms found, as a sum and by length of the
text, give a probability by a logistic curve.

The lexicon is learnt from labels: words of toxic documents against words of the others, by grouped counts. The labelled
rows that are read for it are bounded by a parameter, which bounds the lexicon. Terms and the curve come from different rows.
"""

from __future__ import annotations

import functools
import math
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablejobs.llm import flat
from tablejobs.llm.labelled import with_labels

# Labelled rows read for a lexicon at most, about; of more, a sample by a hash of the id.
FIT_ROWS = 100_000
SUPPORT, LEAST_WEIGHT, CAUTION = 3, 2.0, 1.5

# Letters of other scripts, digits and signs that are read as a Latin letter.
LOOK_ALIKE = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "ɡ": "g", "ӏ": "l", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ø": "o", "ł": "l", "đ": "d", "ħ": "h", "ß": "s",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s",
}
_TABLE_SIZE = 0x110000


@functools.cache
def _table() -> np.ndarray:
    """The folded code point of each code point; 0 for marks that go."""
    out = np.arange(_TABLE_SIZE + 1, dtype=np.uint32)
    for point in range(_TABLE_SIZE):
        c = chr(point)
        if 0xD800 <= point < 0xE000:
            out[point] = 0x20
            continue
        plain = unicodedata.normalize("NFKD", c).lower()[:1] or " "
        plain = LOOK_ALIKE.get(plain, plain)
        if unicodedata.category(plain)[0] == "M":
            out[point] = 0
        else:
            out[point] = ord(plain) if plain.isalnum() else 0x20
    out[_TABLE_SIZE] = 0x20
    return out


def folded(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    """The folded texts of a piece: words with one space between and around them."""
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    ends = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    plain = _table()[np.minimum(points, _TABLE_SIZE)]
    space = plain == 0x20
    keep = plain != 0
    keep[1:] &= ~(space[1:] & space[:-1])
    bounds = np.concatenate([[0], np.cumsum(keep)])[ends].tolist()
    whole = plain[keep].tobytes().decode("utf-32-le")
    return [f" {whole[a:b].strip()} " if b > a else "  " for a, b in zip(bounds, bounds[1:])]


@dataclass(frozen=True)
class Lexicon:
    """Weights of terms, exception phrases (both folded), and the curve's three coefficients."""

    weights: dict[str, float]
    exceptions: frozenset[str] = frozenset()
    curve: tuple[float, float, float] = (-4.0, 0.0, 0.0)
    _automaton: list = field(default_factory=list, compare=False, repr=False)

    def __reduce__(self):
        return Lexicon, (self.weights, self.exceptions, self.curve)

    def automaton(self) -> ahocorasick.Automaton:
        if not self._automaton:
            made = ahocorasick.Automaton()
            for term, weight in self.weights.items():
                made.add_word(f" {term} ", (len(term), weight, False))
            for phrase in self.exceptions:
                made.add_word(f" {phrase} ", (len(phrase), 0.0, True))
            if len(made):
                made.make_automaton()
            self._automaton.append(made)
        return self._automaton[0]

    def found(self, text: str) -> list[tuple[str, float]]:
        """Terms of a folded text outside exception phrases, with their weights, in order."""
        automaton = self.automaton()
        if not len(automaton):
            return []
        terms, excused = [], []
        for end, (length, weight, exception) in automaton.iter(text):
            place = (end - length, end)  # without the spaces around it
            (excused if exception else terms).append((*place, weight))
        # One sweep by beginnings: the phrase that reaches furthest of those that have begun excuses all it covers.
        excused.sort()
        clear, at, reach = [True] * len(terms), 0, -1
        for i in sorted(range(len(terms)), key=lambda i: terms[i][0]):
            begin, end, _ = terms[i]
            while at < len(excused) and excused[at][0] <= begin:
                reach, at = max(reach, excused[at][1]), at + 1
            clear[i] = end > reach
        return [(text[a:b], w) for (a, b, w), own in zip(terms, clear) if own]

    def score(self, weight: float, words: int) -> float:
        z = float(np.dot(self.curve, _features(np.array([weight]), np.array([words]))[0]))
        return 1 / (1 + math.exp(-max(min(z, 50.0), -50.0)))


def _features(weight: np.ndarray, words: np.ndarray) -> np.ndarray:
    """1, the sum of weights and the sum by 100 words, both on a log scale."""
    return np.stack([np.ones(len(weight)), np.log1p(weight), np.log1p(100 * weight / np.maximum(words, 1))], axis=1)


def _curve(weight: np.ndarray, words: np.ndarray, label: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression with a small ridge, by Newton steps."""
    x, b = _features(weight, words), np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -50, 50)))
        ridge = np.array([1e-3, 1e-1, 1e-1])
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (label - p) - ridge * b)
        b = b + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(b.tolist())


def _counted(rows: DataFrame, parts_of) -> DataFrame:
    """(term, toxic, other): documents of each kind that have the term. `parts_of` gives a folded text's terms."""

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        for batch, data, offsets in flat.pieces(batches, "text"):
            for label, text in zip(batch.column("label").to_pylist(), folded(data, offsets)):
                counts[label].update(parts_of(text))
            if len(counts[0]) + len(counts[1]) > 300_000:
                yield _rows(counts)
                counts = (Counter(), Counter())
        yield _rows(counts)

    counted = rows.mapInArrow(step, "term string, toxic long, other long")
    return counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def _rows(counts: tuple[Counter, Counter]) -> pa.RecordBatch:
    terms = list(counts[0].keys() | counts[1].keys())
    columns = [terms, [counts[1][t] for t in terms], [counts[0][t] for t in terms]]
    kinds = [pa.string(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["term", "toxic", "other"])


def fit(
    docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", id: str = "doc_id", rows: int = FIT_ROWS
) -> Lexicon:
    """A lexicon from the texts of `docs` and the labels 0 or 1 of `labels`; other labels and NULL are left out.

    See `labelled.with_labels` for the sample. Three quarters of its rows give the terms, the rest the curve. Without
    toxic rows, or without others, the lexicon is empty and every score is the same.
    """
    frame = with_labels(docs, labels, text, label, id, rows)
    quarter = F.pmod(F.xxhash64("id", F.lit("curve")), F.lit(4))
    for_terms = frame.filter(quarter > 0).select("text", "label")
    sizes = {r["label"]: r["count"] for r in for_terms.groupBy("label").count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        return Lexicon({})

    # The log ratio of both rates, less its standard error: what few documents say weighs less.
    ratio = F.log(((F.col("toxic") + 0.5) / (sizes[1] + 1.0)) / ((F.col("other") + 0.5) / (sizes[0] + 1.0)))
    weight = ratio - CAUTION * F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("other") + 0.5))
    words = _counted(for_terms, lambda t: set(t.split())).withColumn("weight", weight)
    best = words.filter((F.col("toxic") >= SUPPORT) & (F.col("weight") >= LEAST_WEIGHT))
    # In this order, so that a lexicon is the same each time; FIT_ROWS bounds how many terms and phrases have support.
    best = best.orderBy((F.col("toxic") * F.col("weight")).desc(), "term")
    weights = {r["term"]: r["weight"] for r in best.collect()}
    terms = Lexicon(weights)

    def around(folded_text: str) -> set[str]:
        """The phrases of two words that hold a term."""
        if not terms.found(folded_text):
            return set()
        own = folded_text.split()
        return {f"{a} {b}" for a, b in zip(own, own[1:]) if a in terms.weights or b in terms.weights}

    phrases = _counted(for_terms, around).filter((F.col("other") >= SUPPORT) & (F.col("toxic") * 10 <= F.col("other")))
    lexicon = Lexicon(weights, frozenset(r["term"] for r in phrases.collect()))
    measured = _measured(frame.filter(quarter == 0).select("text", "label"), lexicon, "text").select("label", "weight", "n_words").toArrow()
    columns = [measured.column(c).to_numpy().astype(float) for c in ("weight", "n_words", "label")]
    return Lexicon(weights, lexicon.exceptions, _curve(*columns) if measured.num_rows else (-4.0, 1.0, 1.0))


def _measured(docs: DataFrame, lexicon: Lexicon, text: str) -> DataFrame:
    """`docs` without the text, with `terms`, `weight` and `n_words`."""
    others = [c for c in docs.columns if c != text]
    plain = docs.select(*[F.col(f"`{c}`") for c in others])
    made = [("terms", T.ArrayType(T.StringType())), ("weight", T.DoubleType()), ("n_words", T.LongType())]
    schema = T.StructType([*plain.schema.fields, *[T.StructField(n, k) for n, k in made]])
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch, data, offsets in flat.pieces(batches, text):
            texts = folded(data, offsets)
            found = [own.found(t) for t in texts]
            columns = [
                pa.array([[t for t, _ in f] for f in found], pa.list_(pa.string())),
                pa.array([sum(w for _, w in f) for f in found], pa.float64()),
                pa.array([max(t.count(" ") - 1, 0) for t in texts], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays([*map(batch.column, others), *columns], schema.names)

    return docs.mapInArrow(step, schema)


def score(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """`docs` without the text, with `terms` found, their `weight`, `n_words` and `score` from 0 to 1.

    NULL and empty texts have no terms and get the score of a text without terms. Columns of the input with the name of
    an output column are replaced.
    """
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("terms", "weight", "n_words", "score")])
    a, b, c = map(F.lit, lexicon.curve)
    rate = F.log1p(100 * F.col("weight") / F.greatest("n_words", F.lit(1)))
    z = a + b * F.log1p("weight") + c * rate
    z = F.greatest(F.least(z, F.lit(50.0)), F.lit(-50.0))
    return _measured(docs, lexicon, text).withColumn("score", 1 / (1 + F.exp(-z)))
