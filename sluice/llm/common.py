"""What several operators share: whole rows carried as one column, texts in tasks, objects kept by a worker."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Blanks of the contracts that name them: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = r"[\x20\x09-\x0D]+"

ROW = "row"


def packed(docs: DataFrame) -> DataFrame:
    """All columns as the one struct ``row``, so that no column of the caller's can clash with an operator's own."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(ROW))


def unpacked(rows: DataFrame) -> DataFrame:
    """The columns that :func:`packed` put away."""
    return rows.select(f"{ROW}.*")


def texts_of(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 of each text, a null as the empty one; one at a time, as texts can be long."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def per_worker(key: tuple, build: Callable[[], object]) -> object:
    """An object that a Python worker builds once and keeps for all tasks it runs, until another one is asked for.

    Functions travel by value, so their module's globals would be new for each task. A worker serves one operator after
    the other; what the last one kept would only take memory from the next.
    """
    kept = sys.__dict__.setdefault("_sluice_per_worker", {})
    if key not in kept:
        kept.clear()
        kept[key] = build()
    return kept[key]


class Memo(dict):
    """Results by key, about as many as ``bound``; which of them are kept changes nothing but the time taken.

    Once half as many are new the others go, but for those that are asked for again meanwhile.
    """

    def __init__(self, compute: Callable, bound: int):
        super().__init__()
        self.compute, self.bound, self.older = compute, bound, {}

    def __missing__(self, key):
        value = self.older[key] if key in self.older else self.compute(key)
        if 2 * len(self) >= self.bound:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def joined(items: Column) -> Column:
    """Strings of an array with commas between."""
    return F.array_join(items, ",")


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """The session with some settings of an operator's own, for what is run meanwhile."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
