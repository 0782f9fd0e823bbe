"""A bounded sample of labelled documents."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_labels(docs: DataFrame, labels: DataFrame, text: str, label: str, id: str, rows: int, *more: str) -> DataFrame:
    """(id, text, label, more columns of `docs`) of labelled documents.

    Labels other than 0 and 1 are left out, and documents without a text. Of more than `rows` labels about so many are
    taken, by a hash of the id; this bounds the broadcast of the labels, and no text is shuffled. Ids are compared as text;
    an id labelled twice counts twice.
    """
    known = labels.select(F.col(id).cast("string").alias("id"), F.col(label).cast("int").alias("label"))
    known = known.filter("label in (0, 1) and id is not null")
    part = math.ceil(known.count() / rows)
    if part > 1:
        known = known.filter(F.pmod(F.xxhash64("id"), F.lit(part)) == 0)
    own = docs.select(F.col(id).cast("string").alias("id"), F.col(text).cast("string").alias("text"), *more)
    return own.filter("text is not null").join(F.broadcast(known), "id")


def fold(id: str, folds: int) -> Column:
    """crc32 of the id's text, modulo `folds`."""
    return F.pmod(F.crc32(F.col(id).cast("string").cast("binary")), F.lit(folds))
