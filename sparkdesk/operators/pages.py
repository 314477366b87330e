"""Paged JSON ingest: explode the locations of all pages, check that every page
arrived, pick the top locations by resident count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_pages(pages: DataFrame) -> DataFrame:
    """One row per location: ``(page, pos, id, name, type, dimension, residents_cnt)``.

    A missing string field becomes '' and a missing resident list counts 0
    (a JSON ``null`` is treated like a missing field).  ``pos`` is the place
    inside the page, so page order survives for stable tie-breaks.
    """
    loc = pages.select(F.col("page"), F.posexplode_outer("results").alias("pos", "loc"))
    return loc.where(F.col("loc").isNotNull()).select(
        F.col("page"), F.col("pos"),
        F.col("loc.id").alias("id"),
        F.coalesce(F.col("loc.name"), F.lit("")).alias("name"),
        F.coalesce(F.col("loc.type"), F.lit("")).alias("type"),
        F.coalesce(F.col("loc.dimension"), F.lit("")).alias("dimension"),
        F.coalesce(F.size("loc.residents"), F.lit(0)).cast("int").alias("residents_cnt"))


def page_coverage(pages: DataFrame) -> DataFrame:
    """One row: pages announced by ``info.pages``, distinct pages present, and
    whether the set is complete (pages 1..n, none missing)."""
    return pages.agg(F.max("info.pages").alias("expected_pages"),
                     F.count_distinct("page").alias("present_pages"),
                     F.min("page").alias("first_page"), F.max("page").alias("last_page")) \
        .withColumn("complete", (F.col("present_pages") == F.col("expected_pages"))
                    & (F.col("first_page") == 1) & (F.col("last_page") == F.col("expected_pages")))


def assert_complete(pages: DataFrame) -> None:
    """Raise if a page is missing (one small aggregate, one row to the driver)."""
    row = page_coverage(pages).first()
    if row is None or not row["complete"]:
        raise ValueError(f"incomplete page set: {row}")


def top_locations(locations: DataFrame, k: int = 3) -> DataFrame:
    """Top ``k`` by resident count; ties keep page then position order (stable)."""
    return (locations.orderBy(F.col("residents_cnt").desc(), F.col("page").asc(), F.col("pos").asc())
                     .limit(k)
                     .select("id", "name", "type", "dimension", "residents_cnt"))
