"""Which files to fetch, and where to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.names import strip_extension
from sluice.operators.joins import lookup_join


def manifest_diff(portal: DataFrame, landed: DataFrame) -> DataFrame:
    """Portal files that have not landed, or that the portal has in a strictly later version.

    A landed file without a portal date stays as it is.
    """
    latest = landed.groupBy("arquivo").agg(F.max("data_modificacao").alias("landed_at"),
                                           F.lit(True).alias("has_landed"))
    compared = lookup_join(portal, latest, ["arquivo"], "left")
    return (compared.filter(F.col("has_landed").isNull() | (F.col("data_modificacao") > F.col("landed_at")))
            .select(*portal.columns))


def ingest_plan(links: DataFrame, destination: Column, order: Sequence[str], name: str = "nome_arquivo") -> DataFrame:
    """One row per archive name without extension, with its destination; the last in ``order`` wins."""
    return (links.groupBy(strip_extension(F.col(name)).alias("nome_arquivo"))
            .agg(F.max_by(destination, F.struct(*order)).alias("caminho_completo"))
            .select("caminho_completo", "nome_arquivo"))


def exclude_names(plan: DataFrame, names: Sequence[str], name: str = "nome_arquivo") -> DataFrame:
    """The plan without the named archives; names it does not hold are ignored."""
    return plan.filter(~F.col(name).isin(list(names))) if names else plan
