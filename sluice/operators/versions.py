"""Versioned rows: latest per key, not yet loaded, current state."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.dates import coerce_date
from sluice.functions.numbers import to_decimal


def typed_projection(rows: DataFrame, texts: Mapping[str, Column], dates: Mapping[str, Column],
                     amounts: Mapping[str, Column], version: tuple[str, Column],
                     number: Callable[[Column], Column] = to_decimal) -> DataFrame:
    """Named texts, dates, fixed-point amounts and the version column; what cannot be read becomes null."""
    return rows.select(*(c.alias(n) for n, c in texts.items()),
                       *(coerce_date(c).alias(n) for n, c in dates.items()),
                       *(number(c).alias(n) for n, c in amounts.items()),
                       version[1].alias(version[0]))


def latest_version(rows: DataFrame, keys: Sequence[str], version: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """The row with the highest version per key; equal versions are told apart by the tie-break columns.

    The rank filter sits directly above the window, so Spark keeps one row per key and map task before the shuffle and
    a hot key never reaches one task whole.
    """
    newest_first = Window.partitionBy(*keys).orderBy(F.col(version).desc_nulls_last(),
                                                     *(F.col(c).desc_nulls_last() for c in tie_break))
    return rows.withColumn("nr_ord", F.row_number().over(newest_first)).filter("nr_ord = 1").drop("nr_ord")


def complete_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a null in any key."""
    return rows.filter(reduce(and_, (F.col(key).isNotNull() for key in keys)))


def incomplete_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a null in some key; they could never be matched with loaded ones."""
    return rows.filter(reduce(or_, (F.col(key).isNull() for key in keys)))


def unseen_versions(candidates: DataFrame, loaded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Candidates whose keys (version included) are not loaded yet.

    Both sides hold about one row per key, so this is left to an ordinary join: Catalyst broadcasts a small target and
    shuffles a large one.
    """
    return candidates.join(loaded.select(*keys), list(keys), "left_anti").select(*candidates.columns)
