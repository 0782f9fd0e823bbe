"""Text and number expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def or_blank(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def prefixed(prefix: str, text: Column) -> Column:
    """`prefix` followed by the text; a NULL text leaves the prefix alone."""
    return F.concat_ws("", F.lit(prefix), text)


def parse_int(text: Column) -> Column:
    """Text to int; text that is no int gives NULL, also under ANSI rules."""
    return text.try_cast("int")


def key_bytes(value: Column) -> Column:
    """UTF-8 bytes of the value's text form."""
    return F.encode(value.cast("string"), "UTF-8")


def empty(data_type: str) -> Column:
    """A typed NULL."""
    return F.lit(None).cast(data_type)


def min_text_length(df: DataFrame, column: str, length: int) -> Column:
    """The value written as text has at least `length` characters.

    For integer columns this is a pair of plain bounds, which the Parquet reader can use.
    The minus sign of a negative number counts as a character.
    """
    col = F.col(column)
    if isinstance(df.schema[column].dataType, T.IntegralType):
        if length <= 1:
            return col.isNotNull()
        return (col >= 10 ** (length - 1)) | (col <= -(10 ** (length - 2)))
    return F.length(col.cast("string")) >= length


def row_hash(columns: list[str]) -> Column:
    """SHA-256 of the columns' text forms; NULL has its own mark, so it differs from empty text."""
    parts = ", ".join(f"coalesce(cast(`{c}` AS string), char(2))" for c in columns)
    return F.expr(f"sha2(concat_ws(char(1), {parts}), 256)")


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
