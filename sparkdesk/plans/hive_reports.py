"""Warehouse-SQL and map/reduce reports: typed and narrow CSV tables, raw
text lines, dictionary joins, day filters and date-partitioned tables.

Stand-ins: taxi lines <- events; trips x payment <- orders x payment
dictionary; vendor stats <- lineitem by return flag; partitioned trips <-
events by day; CSV tables <- customer written as CSV.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkdesk.functions.stats import exact_avg, exact_sum
from sparkdesk.functions.text import day_range
from sparkdesk.operators import lines as line_ops
from sparkdesk.operators import reports
from sparkdesk.operators.numbering import dense_numbers
from sparkdesk.plans import analogues as an
from sparkdesk.plans.registry import query
from sparkdesk.session import scratch_path, write_scratch
from sparkdesk.sinks import catalog, writers
from sparkdesk.sources import files
from sparkdesk.sources.tables import table
from sparkdesk.streaming.line_report import run_incremental_tip_report

PAYMENT_DAY = "1996-03-15"
EVENT_DAY = "2024-01-15"
SCAN_FROM, SCAN_TO = "2024-01-10", "2024-01-20"
SCAN_SHIPDATE = "1998-01-01"


@query("scan_parquet", sql=f"""
SELECT l_orderkey, l_partkey, l_quantity, l_shipdate FROM lineitem
WHERE l_shipdate >= TIMESTAMP '{SCAN_SHIPDATE} 00:00:00'
""")
def scan_parquet(spark, sf_dir):
    li = files.read_parquet(spark, os.path.join(sf_dir, "lineitem.parquet"),
                            ["l_orderkey", "l_partkey", "l_quantity", "l_shipdate"])
    return li.where(F.col("l_shipdate") >= F.lit(f"{SCAN_SHIPDATE} 00:00:00").cast("timestamp_ntz"))


CUSTOMER_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType())])


def _customer_csv(spark, sf_dir) -> str:
    path = scratch_path(spark, "customer_csv")
    table(spark, sf_dir, "customer").write.option("header", True).mode("overwrite").csv(path)
    return path


@query("csv_typed_scan", sql="SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_typed_scan(spark, sf_dir):
    return files.read_csv_typed(spark, _customer_csv(spark, sf_dir), CUSTOMER_SCHEMA)


@query("csv_prefix_scan", sql="""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey
FROM customer
""")
def csv_prefix_scan(spark, sf_dir):
    return files.read_csv_prefix(spark, _customer_csv(spark, sf_dir),
                                 ["c_custkey", "c_name", "c_nationkey"])


def _trip_lines_path(spark, sf_dir) -> str:
    path = scratch_path(spark, "trip_lines")
    lines = an.trip_lines(spark, table(spark, sf_dir, "events"))
    lines.write.mode("overwrite").text(path)
    return path


@query("lines_parse", sql=an.TRIP_LINES_PARSED_SQL)
def lines_parse(spark, sf_dir):
    raw = files.read_lines(spark, _trip_lines_path(spark, sf_dir))
    return line_ops.parse_trip_lines(raw, an.LINE_YEAR)


LINES_AVG_SQL = f"""
WITH parsed AS ({an.TRIP_LINES_PARSED_SQL})
SELECT month, p.name AS payment,
       CAST(sum(CAST(tip_amount AS DECIMAL(26,6))) AS DOUBLE) / count(tip_amount) AS avg_tip
FROM parsed JOIN {an.PAYMENT_VALUES_SQL} ON TRY_CAST(parsed.payment_type AS INTEGER) = p.id
WHERE tip_amount IS NOT NULL AND NOT isnan(tip_amount) AND abs(tip_amount) < 1e20
GROUP BY month, p.name
"""


@query("lines_avg", sql=LINES_AVG_SQL)
def lines_avg(spark, sf_dir):
    raw = files.read_lines(spark, _trip_lines_path(spark, sf_dir))
    parsed = line_ops.parse_trip_lines(raw, an.LINE_YEAR)
    return line_ops.avg_tip_by_month_label(parsed, line_ops.payment_dim(spark), mean_fn=exact_avg)


_EXTRA = {"malformed": (an.BLANK_EVERY, an.SHORT_EVERY), "other_year": (an.OTHER_YEAR_EVERY,), "unknown_payment": (an.CODE_X_EVERY, an.CODE_7_EVERY),
          "no_payment": (an.CODE_EMPTY_EVERY,), "bad_tip": (an.TIP_TEXT_EVERY, an.TIP_EMPTY_EVERY),
          "tip_out_of_range": (an.TIP_NAN_EVERY, an.TIP_HUGE_EVERY)}


@query("lines_outcomes", sql="WITH e AS (SELECT event_id FROM events) SELECT 'header' AS outcome, 1::BIGINT AS lines"
       + "".join(f" UNION ALL SELECT '{o}', " + " + ".join(f"count(*) FILTER (event_id % {n} = 0)" for n in every) + " FROM e"
                 for o, every in _EXTRA.items())
       + " UNION ALL SELECT 'ok', count(*) FROM e UNION ALL SELECT 'lines', 1 + count(*) + "
       + " + ".join(f"count(*) FILTER (event_id % {n} = 0)" for every in _EXTRA.values() for n in every) + " FROM e")
def lines_outcomes(spark, sf_dir):
    """What became of every line, counted in the pass that makes the report: outcomes add up to the lines."""
    raw = files.read_lines(spark, _trip_lines_path(spark, sf_dir))
    _, outcomes = line_ops.tip_report(raw, line_ops.payment_dim(spark), an.LINE_YEAR)
    return outcomes.unionByName(outcomes.agg(F.sum("lines").alias("lines")).withColumn("outcome", F.lit("lines")))


@query("tip_lines", sql=f"""
SELECT row_number() OVER (ORDER BY month, payment) - 1 AS place, month || ',' || payment || ',' || printf('%.4f', avg_tip) AS line
FROM ({LINES_AVG_SQL})
""")
def tip_lines(spark, sf_dir):
    """The report as ordered result lines, written as text and read back in file order."""
    raw = files.read_lines(spark, _trip_lines_path(spark, sf_dir))
    report, _ = line_ops.tip_report(raw, line_ops.payment_dim(spark), an.LINE_YEAR)
    path = scratch_path(spark, "tip_lines")
    writers.write_lines(report.withColumn("avg_tip", F.printf(F.lit("%.4f"), "avg_tip")), path, ["month", "payment", "avg_tip"])
    lines = files.read_lines(spark, path).select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                                                 F.monotonically_increasing_id().alias("i"), F.col("value").alias("line"))
    return dense_numbers(lines, ["file", "block", "i"], "place").select("place", "line")


@query("cte_insert", sql="""
WITH t AS (SELECT TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS id, o_orderpriority AS name FROM orders)
SELECT DISTINCT id, name FROM t UNION ALL SELECT 9, 'by hand'
""")
def cte_insert(spark, sf_dir):
    """A dictionary table with one row by hand, filled from a common table expression."""
    name = f"payment_{uuid.uuid4().hex[:12]}"
    catalog.create_table_if_absent(spark, name, "id int, name string", location=scratch_path(spark, "payment"))
    try:
        catalog.insert(spark.createDataFrame([(9, "by hand")], "id int, name string"), name)
        seen = table(spark, sf_dir, "orders").select(F.substring("o_orderpriority", 1, 1).try_cast("int").alias("id"),
                                                     F.col("o_orderpriority").alias("name"))
        catalog.insert_with(spark, name, {"t": seen}, "SELECT DISTINCT id, name FROM t")
        return write_scratch(spark.table(name), "payment_read")
    finally:
        spark.sql(f"DROP TABLE {name}")


@query("lines_avg_incremental", sql=LINES_AVG_SQL)
def lines_avg_incremental(spark, sf_dir):
    """The same report fed by a landing folder: lines land as one file per
    event day and a streaming job consumes them in micro-batches."""
    landing = scratch_path(spark, "trip_landing")
    ev = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    lines = an.trip_lines(spark, ev, keep=("day",))
    (lines.withColumn("day", F.coalesce(F.col("day"), F.lit("1970-01-01").cast("date")))
          .write.partitionBy("day").mode("overwrite").text(landing))
    return run_incremental_tip_report(spark, landing + "/*", scratch_path(spark, "tip_report"),
                                      scratch_path(spark, "tip_report_ckpt"), an.LINE_YEAR)


@query("payment_totals", sql=f"""
SELECT p.name, CAST(sum(CAST(t.total_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_sum_amount
FROM ({an.ORDERS_AS_TRIPS_SQL}) t, {an.PAYMENT_VALUES_SQL}
WHERE p.id = t.payment_type AND t.tpep_pickup_datetime = TIMESTAMP '{PAYMENT_DAY}'
GROUP BY p.name ORDER BY 2, 1
""")
def payment_totals(spark, sf_dir):
    trips = an.orders_as_trips(table(spark, sf_dir, "orders"))
    pay = line_ops.payment_dim(spark)
    # Timestamp = date literal: matches pickups at midnight of that day only.
    day = trips.where(F.col("tpep_pickup_datetime") == F.lit(PAYMENT_DAY).cast("timestamp_ntz"))
    # six literal rows: the hint keeps the orders streaming past them
    return (day.join(F.broadcast(pay), day.payment_type == pay.id)
               .groupBy("name").agg(exact_sum("total_amount").alias("total_sum_amount"))
               .orderBy("total_sum_amount", "name"))


@query("payment_counts", sql=f"""
SELECT count(1) AS trip_count, p.name
FROM ({an.ORDERS_AS_TRIPS_SQL}) t JOIN {an.PAYMENT_VALUES_SQL} ON (t.payment_type = p.id)
GROUP BY p.name ORDER BY 1 DESC, 2
""")
def payment_counts(spark, sf_dir):
    trips = an.orders_as_trips(table(spark, sf_dir, "orders"))
    pay = line_ops.payment_dim(spark)
    return (trips.join(F.broadcast(pay), trips.payment_type == pay.id)
                 .groupBy("name").agg(F.count(F.lit(1)).alias("trip_count"))
                 .select("trip_count", "name").orderBy(F.col("trip_count").desc(), "name"))


@query("vendor_stats", sql="""
SELECT l_returnflag,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(l_quantity) AS avg_quantity,
       min(l_discount) + 0.0 AS min_discount,
       max(l_discount) + 0.0 AS max_discount,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(l_extendedprice) AS avg_price
FROM lineitem
WHERE l_returnflag IS NOT NULL AND l_returnflag <> ''
GROUP BY l_returnflag
""")
def vendor_stats(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    key = F.col("l_returnflag")
    return reports.group_report(
        li.where(key.isNotNull() & (key != "")), "l_returnflag",
        {"avg_quantity": exact_avg("l_quantity"),
         "min_discount": F.min("l_discount") + F.lit(0.0),
         "max_discount": F.max("l_discount") + F.lit(0.0),
         "avg_price": exact_avg("l_extendedprice")})


@query("day_filter", sql=f"""
SELECT event_id, ts, user_id, event_type, value FROM events
WHERE CAST(ts AS DATE) = DATE '{EVENT_DAY}'
""")
def day_filter(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.where(day_range("ts", EVENT_DAY)).select("event_id", "ts", "user_id", "event_type", "value")


@query("part_load", sql=f"""
SELECT event_id, ts, user_id, event_type, value, props, DATE '{EVENT_DAY}' AS dt FROM events
WHERE CAST(ts AS DATE) = DATE '{EVENT_DAY}'
""")
def part_load(spark, sf_dir):
    """Load one day into a date-partitioned table twice: the overwrite form is idempotent."""
    ev = table(spark, sf_dir, "events")
    path = scratch_path(spark, "trip_part")
    for _ in range(2):
        writers.write_day_partition(ev, path, EVENT_DAY, "ts", replace=True)
    return files.read_day(spark, path, EVENT_DAY)


@query("part_scan", sql=f"""
SELECT CAST(ts AS DATE) AS dt, count(*) AS events,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
FROM events
WHERE CAST(ts AS DATE) >= DATE '{SCAN_FROM}' AND CAST(ts AS DATE) < DATE '{SCAN_TO}'
GROUP BY CAST(ts AS DATE)
""")
def part_scan(spark, sf_dir):
    """Write all days as a dt-partitioned ORC table, then scan a day range
    (PartitionFilters prune the folders outside it)."""
    ev = table(spark, sf_dir, "events").withColumn("dt", F.to_date("ts"))
    path = scratch_path(spark, "events_by_day")
    writers.write_partitioned(ev, path, "dt", fmt="orc")
    part = files.read_orc(spark, path)
    rng = (F.col("dt") >= F.lit(SCAN_FROM).cast("date")) & (F.col("dt") < F.lit(SCAN_TO).cast("date"))
    return (part.where(rng).groupBy("dt")
                .agg(F.count(F.lit(1)).alias("events"), exact_sum("value").alias("total_value")))
