"""Masking, paged JSON ingest and the weekday look-up."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkdesk.functions.text import card_mask, card_mask_pandas, iso_weekday, iso_weekday_of
from sparkdesk.operators import pages as page_ops
from sparkdesk.plans import analogues as an
from sparkdesk.plans.registry import query
from sparkdesk.session import scratch_path
from sparkdesk.sinks import publish
from sparkdesk.sources import files
from sparkdesk.sources.tables import table

RUN_DATE = "2024-01-17"

CARDS_SQL = """
SELECT c_custkey AS id, card_number,
       concat(substr(card_number, 1, 4), 'XXXXXXXX', substr(card_number, 13)) AS hidden
FROM (SELECT c_custkey, '4042' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS card_number FROM customer)
"""


def _cards(spark, sf_dir):
    cust = table(spark, sf_dir, "customer")
    return cust.select(F.col("c_custkey").alias("id"),
                       F.concat(F.lit("4042"), F.lpad(F.col("c_custkey").cast("string"), 12, "0"))
                        .alias("card_number"))


@query("mask_card", sql=CARDS_SQL)
def mask_card(spark, sf_dir):
    return _cards(spark, sf_dir).withColumn("hidden", card_mask("card_number"))


@query("mask_card_udf", sql=CARDS_SQL)
def mask_card_udf(spark, sf_dir):
    return _cards(spark, sf_dir).withColumn("hidden", card_mask_pandas("card_number"))


def _landed_pages(spark, sf_dir):
    """Land the stand-in pages as JSON lines (one page document per line) and read them back."""
    pages = an.conversation_pages(table(spark, sf_dir, "conversations"))
    docs = pages.select(F.to_json(F.struct(
        F.col("page"),
        F.struct(F.size("results").cast("long").alias("count"),
                 F.col("pages").cast("int").alias("pages")).alias("info"),
        F.col("results"))).alias("value"))
    path = scratch_path(spark, "location_pages")
    docs.write.mode("overwrite").text(path)
    landed = files.read_pages(spark, path)
    page_ops.assert_complete(landed)
    return landed


@query("pages_explode", sql=an.CONVERSATION_LOCATIONS_SQL)
def pages_explode(spark, sf_dir):
    return page_ops.explode_pages(_landed_pages(spark, sf_dir))


@query("pages_top3", sql=f"""
SELECT id, name, type, dimension, residents_cnt FROM ({an.CONVERSATION_LOCATIONS_SQL})
ORDER BY residents_cnt DESC, page, pos LIMIT 3
""")
def pages_top3(spark, sf_dir):
    return page_ops.top_locations(page_ops.explode_pages(_landed_pages(spark, sf_dir)), 3)


@query("publish_daily", sql=f"""
SELECT id, name, type, dimension, residents_cnt FROM ({an.CONVERSATION_LOCATIONS_SQL})
ORDER BY residents_cnt DESC, page, pos LIMIT 3
""")
def publish_daily(spark, sf_dir):
    """Extract, stage, check and publish the top locations: a day before with other rows, then
    the run date twice; readers get the last version, once."""
    root, pages = scratch_path(spark, "top_locations"), None
    for ds, k in (("2024-01-16", 5), (RUN_DATE, 3), (RUN_DATE, 3)):
        pages = _landed_pages(spark, sf_dir) if pages is None else pages
        publish.run_daily(spark, root, ds, lambda: page_ops.explode_pages(pages),
                          lambda df: page_ops.top_locations(df, k), unique_keys=["id"])  # noqa: B023
    return publish.published(spark, root)


@query("weekday_lookup", sql=f"""
SELECT n_name AS heading FROM nation WHERE n_nationkey = isodow(DATE '{RUN_DATE}')
""")
def weekday_lookup(spark, sf_dir):
    """Articles (nation: id, heading = name) read for the ISO weekday of the run date."""
    articles = table(spark, sf_dir, "nation")
    return articles.where(F.col("n_nationkey") == F.lit(iso_weekday_of(RUN_DATE))) \
                   .select(F.col("n_name").alias("heading"))


@query("weekday_lookup_daily", sql="""
SELECT d.ds, n.n_name AS heading
FROM (SELECT DISTINCT CAST(ts AS DATE) AS ds FROM events) d
JOIN nation n ON n.n_nationkey = isodow(d.ds)
""")
def weekday_lookup_daily(spark, sf_dir):
    """The same look-up for every run date present in events (a backfill):
    distinct days, then a join on the ISO weekday."""
    days = table(spark, sf_dir, "events").select(F.to_date("ts").alias("ds")).distinct()
    articles = table(spark, sf_dir, "nation")
    return days.join(articles, iso_weekday("ds") == articles.n_nationkey) \
               .select("ds", F.col("n_name").alias("heading"))
