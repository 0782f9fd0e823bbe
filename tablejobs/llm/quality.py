"""Document quality by hierarchical empirical Bayes.

A logistic classifier on shape features of the text gives each document its own evidence. Documents belong to a path, paths
to a host. The share of good documents of a host is shrunk towards the global share, that of a path towards its host's:
each counts like so many documents as the spread of the shares among groups tells (method of moments). A sparse site
thus speaks with its parent's voice. A document's score is its evidence moved by its path's share without the document
itself, against the global share.

All sums come from map-side reduced groupings. Shares are joined to the documents by host and path; the side of the
documents has no limit on a group, and adaptive execution splits what is skewed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablejobs.llm import flat
from tablejobs.llm.labelled import with_labels
from tablejobs.llm.links import kept

# Labelled rows that the classifier is learnt from at most, about; of more, a sample by a hash of the id.
FIT_ROWS = 100_000
RIDGE = 1.0
# A group's share counts at least and at most like so many documents of its child groups.
LEAST_PRIOR, LARGEST_PRIOR = 1.0, 1e6

_CLASSES = (
    flat.byte_class((0x41, 0x5A)),
    flat.byte_class((0x61, 0x7A)),
    flat.byte_class((0x30, 0x39)),
    flat.byte_class((0x80, 0xBF)),
    flat.byte_class((0x0A, 0x0A)),
    flat.byte_class((0x2E, 0x2E), (0x2C, 0x2C)),
    flat.byte_class((0x21, 0x21), (0x3F, 0x3F)),
    flat.byte_class((0x7C, 0x7C)),
    flat.byte_class((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)),
)
N_FEATURES = len(_CLASSES) + 9


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Shape of each text: shares of character classes, lengths, repeats, and how words differ (documents x N_FEATURES)."""
    size = np.diff(offsets).astype(float)
    words = flat.Words(data, offsets, flat.NOT_SPACE)
    n = words.counts.astype(float)
    at_least = np.maximum(n, 1)
    columns = []
    for inside in _CLASSES:
        columns.append(np.diff(np.concatenate([[0], np.cumsum(inside[data])])[offsets]) / np.maximum(size, 1))
    h, doc = words.hashes(), words.doc()
    length = (words.ends - words.starts).astype(float)
    count = lambda mask: np.bincount(doc, weights=mask.astype(float), minlength=len(size))
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    order = np.argsort((doc.astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24)))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    distinct = np.bincount(doc[order][new], minlength=len(size))
    letters = np.concatenate([[0], np.cumsum(_CLASSES[0][data] | _CLASSES[1][data] | flat.byte_class((0xC3, 0xFF))[data])])
    plain = count(letters[words.ends] - letters[words.starts] == 0)
    total = np.bincount(doc, weights=length, minlength=len(size))
    mean = total / at_least
    columns += [
        np.log1p(n),
        np.log1p(size),
        mean / 10,
        np.sqrt(np.maximum(np.bincount(doc, weights=length**2, minlength=len(size)) / at_least - mean**2, 0)) / 10,
        count(same) / at_least,
        distinct / at_least,
        np.log1p(distinct) / np.log1p(at_least),
        plain / at_least,
        (size == 0).astype(float),
    ]
    return np.stack(columns, axis=1)


@dataclass(frozen=True)
class Classifier:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.mean) / self.scale) @ self.weights[1:] + self.weights[0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(
    docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality", id: str = "doc_id", rows: int = FIT_ROWS
) -> Classifier:
    """A classifier from the texts of `docs` and the labels 0 or 1 of `labels`, see `labelled.with_labels`.

    The features of the sample, N_FEATURES numbers for each row, go to the driver. Without any label each text gets 1 / 2.
    """

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in flat.pieces(batches, "text"):
            x = pa.FixedSizeListArray.from_arrays(pa.array(features(data, offsets).reshape(-1)), N_FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column("label"), x.cast(pa.list_(pa.float64()))], ["label", "x"])

    sample = with_labels(docs, labels, text, label, id, rows).select("text", "label")
    found = sample.mapInArrow(step, "label int, x array<double>").toArrow()
    if not found.num_rows:
        return Classifier(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES + 1))
    x = np.stack(found.column("x").to_numpy())
    y = found.column("label").to_numpy().astype(float)
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    x = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    b, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], RIDGE)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step_ = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * b)
        b = b + np.clip(step_, -3, 3)
        if np.abs(step_).max() < 1e-6:
            break
    return Classifier(mean, scale, b)


def evidence(docs: DataFrame, classifier: Classifier, text: str = "text", name: str = "evidence") -> DataFrame:
    """`docs` with the probability that the classifier gives the whole text; NULL counts as the empty text."""
    others = [c for c in docs.columns if c != name]
    plain = docs.select(*[F.col(f"`{c}`") for c in others])
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in flat.pieces(batches, text):
            p = shared.value.probability(features(data, offsets))
            yield pa.RecordBatch.from_arrays([*map(batch.column, others), pa.array(p)], [*others, name])

    return plain.mapInArrow(step, T.StructType([*plain.schema.fields, T.StructField(name, T.DoubleType())]))


def _logit(p: Column) -> Column:
    inside = F.greatest(F.least(p, F.lit(1 - 1e-9)), F.lit(1e-9))
    return F.log(inside / (1 - inside))


def _strength(groups: DataFrame, share: Column, centre: Column) -> float:
    """How many documents the centre counts like, from the spread of the groups' shares around it.

    The spread beyond what documents of one group differ by is the spread among groups; a small one means a strong centre.
    """
    found = groups.agg(
        F.sum(F.col("__n") * (share - centre) ** 2).alias("spread"),
        F.sum(centre * (1 - centre)).alias("noise"),
        F.sum("__n").alias("n"),
        F.sum(F.col("__n") * centre * (1 - centre)).alias("total"),
    ).first()
    among = ((found["spread"] or 0) - (found["noise"] or 0)) / max(found["n"] or 0, 1)
    if among <= 0:
        return LARGEST_PRIOR
    return min(max(found["total"] / max(found["n"], 1) / among - 1, LEAST_PRIOR), LARGEST_PRIOR)


def posteriors(scored: DataFrame, host: str = "host", path: str = "path", name: str = "evidence") -> DataFrame:
    """`scored` with `host_share`, `path_share` and `score`, the posterior probability of a good document.

    Paths are told apart within their host; a NULL host or path is the empty text. Shares of a path leave out the document
    itself, so a site of one document has its parent's share. Columns of the input with the name of an output column
    are replaced.
    """
    own = [c for c in scored.columns if c not in ("host_share", "path_share", "score")]
    keys = {"__host": F.coalesce(F.col(host).cast("string"), F.lit("")), "__path": F.coalesce(F.col(path).cast("string"), F.lit(""))}
    frame = scored.select(*[F.col(f"`{c}`") for c in own]).withColumns(keys)
    # Written once: the shares and the strengths of both levels are read from it.
    sums = frame.groupBy("__host", "__path").agg(F.count(F.lit(1)).alias("__n"), F.sum(name).alias("__s"))
    paths = kept(sums, "paths")
    total = paths.agg(F.sum("__n").alias("n"), F.sum("__s").alias("s")).first()
    centre = F.lit(total["s"] / total["n"] if total["n"] else 0.5)
    hosts = paths.groupBy("__host").agg(F.sum("__n").alias("__n"), F.sum("__s").alias("__s"))
    of_host = _strength(hosts, F.col("__s") / F.col("__n"), centre)
    share = (F.col("__s") + F.lit(of_host) * centre) / (F.col("__n") + of_host)
    both = paths.join(hosts.select("__host", share.alias("host_share")), "__host")
    of_path = F.lit(_strength(both, F.col("__s") / F.col("__n"), F.col("host_share")))
    joined = frame.join(both, ["__host", "__path"])
    rest = (F.col("__s") - F.col(name) + of_path * F.col("host_share")) / (F.col("__n") - 1 + of_path)
    moved = _logit(F.col(name)) + _logit(F.col("path_share")) - _logit(centre)
    return joined.withColumn("path_share", rest).select(
        *[F.col(f"`{c}`") for c in own], "host_share", "path_share", (1 / (1 + F.exp(-moved))).alias("score")
    )
