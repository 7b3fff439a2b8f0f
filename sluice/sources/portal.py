"""Links to archives in index pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.dates import http_last_modified
from sluice.operators.joins import lookup_join

# Parts of a page whose text is no markup.
NOT_MARKUP = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>"
ANCHOR_TARGET = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""


def page_links(html: Column) -> Column:
    """Targets of all anchors in a page, in page order; anchors without a target are left out."""
    quoted = F.regexp_extract_all(F.regexp_replace(html, NOT_MARKUP, ""), F.lit(ANCHOR_TARGET), F.lit(1))
    return F.transform(quoted, lambda target: F.replace(F.trim(F.trim(target, F.lit('"')), F.lit("'")),
                                                        F.lit("&amp;"), F.lit("&")))


def portal_links(pages: DataFrame, base: Column, suffix: str = ".zip", html: str = "html",
                 order: tuple[str, ...] = ()) -> DataFrame:
    """One row per link ending in ``suffix``: ``arquivo``, full ``url`` and its position in the page.

    ``order`` columns of the pages are kept, so that links of several pages have one total order.
    """
    links = pages.select(*order, base.alias("base"), F.posexplode(page_links(F.col(html))).alias("position", "arquivo"))
    return (links.filter(F.col("arquivo").endswith(suffix))
            .select("arquivo", F.concat("base", "arquivo").alias("url"), *order, "position"))


def portal_links_nodate(pages: DataFrame, base: Column, suffix: str = ".zip", html: str = "html") -> DataFrame:
    """The listing without dates: ``nome_arquivo`` and ``url``."""
    return portal_links(pages, base, suffix, html).select(F.col("arquivo").alias("nome_arquivo"), "url")


def portal_listing(links: DataFrame, headers: DataFrame) -> DataFrame:
    """Links with the time of their ``Last-Modified`` header; null where there is none or it is no date.

    ``headers`` holds ``url`` and ``last_modified`` as text.
    """
    times = (headers.groupBy("url")
             .agg(F.max(http_last_modified(F.col("last_modified"))).alias("data_modificacao")))
    return (lookup_join(links.select("arquivo", "url"), times, ["url"], "left")
            .select("arquivo", "url", "data_modificacao"))
