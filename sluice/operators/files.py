"""File-level bookkeeping on loaded tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.joins import drop_matching, keep_matching


def loaded_files(bronze: DataFrame, version: Sequence[str]) -> DataFrame:
    """The set of file versions in a table."""
    return bronze.select(*version).distinct()


def new_rows(rows: DataFrame, bronze: DataFrame, version: Sequence[str], **bounds) -> DataFrame:
    """Rows, or files, whose version is not in the table."""
    return drop_matching(rows, bronze, version, **bounds)


def members_to_extract(members: DataFrame, unseen: DataFrame, version: Sequence[str], **bounds) -> DataFrame:
    """Members whose name and time are in the list of unseen ones."""
    return keep_matching(members, unseen, version, **bounds)


def file_versions(control: DataFrame, name: str = "nome_arquivo") -> DataFrame:
    """Number of versions per file."""
    return control.groupBy(name).agg(F.count(F.lit(1)).alias("qtd_versoes"))


def row_count(df: DataFrame, label: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(label))


def union_files(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of frames with differing headers, matched by column name; absent columns are null."""
    united = frames[0]
    for frame in frames[1:]:
        united = united.unionByName(frame, allowMissingColumns=True)
    return united
