from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame


def rows(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def same(left: DataFrame, right: DataFrame) -> bool:
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def plan(df: DataFrame, capture) -> str:
    """The physical plan as `explain` prints it."""
    capture.readouterr()
    df.explain()
    return capture.readouterr().out
