"""Tables: creation, appends by column name, views across databases."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from sluice.operators.files import new_rows

log = logging.getLogger(__name__)


def create_table(spark: SparkSession, name: str, columns: str, partition_by: Sequence[str] = (),
                 table_format: str = "parquet", location: str | None = None) -> None:
    """Create the table unless it exists."""
    partitions = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    place = f"LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {table_format} {partitions} {place}")


def current_table(spark: SparkSession, name: str) -> DataFrame:
    """The table as it is now, whatever listing of its files the session remembers: another one may have appended."""
    spark.catalog.refreshTable(name)
    return spark.table(name)


def append_by_name(df: DataFrame, table: str, cluster_by: Sequence[str] = ()) -> None:
    """Append rows; columns are matched by name and those the frame lacks become null.

    ``cluster_by`` gathers the rows of a partition before writing. It is a rebalance, not a repartition: adaptive
    execution splits a value that holds too much and joins values that hold little.
    """
    if cluster_by:
        df = df.hint("rebalance", *cluster_by)
    df.sparkSession.sql(f"INSERT INTO {table} BY NAME SELECT * FROM {{rows}}", rows=df)


def append_unseen(rows: DataFrame, table: str, version: Sequence[str], cluster_by: Sequence[str] = ()) -> bool:
    """Append the rows whose file version the table lacks; nothing is written, and false returned, when there are none."""
    fresh = new_rows(rows, current_table(rows.sparkSession, table), version)
    if fresh.isEmpty():
        log.info("no new rows for %s", table)
        return False
    append_by_name(fresh, table, cluster_by)
    return True


def publish_view(spark: SparkSession, view: str, table: str) -> DataFrame:
    """Make a table of one layer visible in another."""
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {table}")
    return spark.table(view)
