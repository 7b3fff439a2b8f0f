"""The daily-report chain: discovery, bronze, silver, each only after the one before has succeeded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from sluice.plans.bronze import BronzeTables, LoadResult, load_bronze
from sluice.plans.discovery import fetch_plan
from sluice.plans.silver import SilverTables, load_silver
from sluice.streaming.silver_feed import feed_silver


def run_chain(spark: SparkSession, pages: DataFrame, headers: DataFrame, landing: str, base: Column,
              bronze: BronzeTables, silver: SilverTables, fetch: Callable[[DataFrame], None],
              feed_checkpoint: str | None = None) -> LoadResult:
    """Plan what to fetch, hand the plan to ``fetch``, load bronze and then silver.

    ``fetch`` puts the planned archives into the landing folder. With ``feed_checkpoint`` silver reads only the months
    that bronze gained since the last run; without it, all of them. Returns what the bronze load did.
    """
    fetch(fetch_plan(spark, pages, headers, landing, base))
    done = load_bronze(spark, landing, bronze)
    if feed_checkpoint is None:
        load_silver(spark, bronze.bronze, silver)
    else:
        feed_silver(spark, bronze.bronze, silver, feed_checkpoint)
    return done
