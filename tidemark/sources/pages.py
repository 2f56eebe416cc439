"""Search-response pages to listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.barrier import computed_once
from tidemark.schemas import PAGE


def explode_listings(pages: DataFrame, body: str = "body") -> DataFrame:
    """One row per element of each body's ``businesses`` array, as JSON text.

    An empty, null or missing array yields none; so does a page that ``failed_pages`` tells.
    Page columns are kept; the listing's place in its page is added as ``position``.
    """
    return (
        pages.withColumn("_page", F.from_json(F.col(body), PAGE))
        .select("*", F.posexplode("_page.businesses").alias("position", "listing"))
        .drop("_page", body)
    )


def explode_pages(pages: DataFrame, body: str = "body") -> DataFrame:
    """Listings and failed pages in one parse: at least one row of every page.

    ``position`` and ``listing`` are null for a page without a listing; ``page_failed`` tells those that
    ``failed_pages`` tells, whose ``body`` is kept as ``failed_body``.
    """
    flagged = F.from_json(F.col(body), f"{PAGE}, _flagged string", {"columnNameOfCorruptRecord": "_flagged"})
    failed = F.expr("_page IS NULL OR _page._flagged IS NOT NULL")
    return (
        computed_once(pages.withColumn("_parsed", flagged), "_page", "_parsed")
        .withColumn("page_failed", failed)
        .withColumn("failed_body", F.when(F.col("page_failed"), F.col(body)))
        .select("*", F.posexplode_outer(F.expr("CASE WHEN NOT page_failed THEN _page.businesses END")).alias("position", "listing"))
        .drop("_page", "_parsed", body)
    )


def failed_pages(pages: DataFrame, body: str = "body") -> DataFrame:
    """Pages whose body is null, no JSON object or truncated, or whose ``businesses`` is no array.

    Their rows are kept whole, raw body included, to be quarantined or fetched again.
    """
    flagged = F.from_json(
        F.col(body), f"{PAGE}, _flagged string", {"columnNameOfCorruptRecord": "_flagged"}
    )
    return (
        pages.withColumn("_page", flagged)
        .filter("_page IS NULL OR _page._flagged IS NOT NULL")
        .drop("_page")
    )
