"""Which archives to fetch: index pages against the landing folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from sluice.operators.manifest import manifest_diff
from sluice.sources.landing import landing_manifest
from sluice.sources.portal import portal_links, portal_listing


def fetch_plan(spark: SparkSession, pages: DataFrame, headers: DataFrame, landing: str, base: Column,
               suffix: str = ".zip") -> DataFrame:
    """``arquivo``, ``url`` and ``data_modificacao`` of every archive that is new or newer than the landed one."""
    portal = portal_listing(portal_links(pages, base, suffix), headers)
    return manifest_diff(portal, landing_manifest(spark, landing, suffix).select("arquivo", "data_modificacao"))
