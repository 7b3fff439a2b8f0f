"""Joins of many rows against a set of keys.

The rows may be skewed: one key can hold a third of them. A set that is proven small is broadcast, so the rows are not
shuffled at all. A larger one is joined by shuffle; it is written out first, which leaves both sides as plain shuffle
stages that adaptive execution can split where the rows of one key pile up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sluice.session import shared_folder

MAX_BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD_BYTES = 48


def settle(df: DataFrame) -> DataFrame:
    """The frame, computed once and kept in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def settle_measured(df: DataFrame) -> tuple[DataFrame, int]:
    """As :func:`settle`, with the size of the frame, counted as text while it is written."""
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns),
                F.lit(ROW_OVERHEAD_BYTES))
    size = Observation()
    settled = settle(df.observe(size, F.sum(width.cast("bigint")).alias("bytes")))
    return settled, size.get["bytes"] or 0


def lookup_join(rows: DataFrame, lookup: DataFrame, on: Sequence[str], how: str,
                max_broadcast_bytes: int | None = None) -> DataFrame:
    """Join rows to a lookup that has at most one row per key, on equality of the ``on`` columns."""
    bound = MAX_BROADCAST_BYTES if max_broadcast_bytes is None else max_broadcast_bytes
    lookup, size = settle_measured(lookup)
    if size <= bound:
        lookup = F.broadcast(lookup)
    return rows.join(lookup, list(on), how)


def keep_matching(rows: DataFrame, keys: DataFrame, on: Sequence[str], **bounds) -> DataFrame:
    """Rows whose key is in the set; a null in a key never matches."""
    return lookup_join(rows, keys.select(*on).distinct(), on, "left_semi", **bounds)


def drop_matching(rows: DataFrame, keys: DataFrame, on: Sequence[str], **bounds) -> DataFrame:
    """Rows whose key is not in the set; a null in a key never matches."""
    return lookup_join(rows, keys.select(*on).distinct(), on, "left_anti", **bounds)
