"""Driver-table stand-ins for the reference's inputs.

Each builder derives its frame from a driver table with Spark expressions, so
its size grows with the table.  Malformed rows are added beside the good ones, for
rows chosen by their id; they exercise the reject paths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkdesk.operators.lines import PAYMENT_TYPES
from sparkdesk.operators.numbering import dense_numbers

# Event type -> taxi payment code used by the line stand-in.
EVENT_PAYMENT_CODE = {"click": "1", "error": "2", "purchase": "3", "signup": "4", "view": "5"}

# Which event ids add which kind of bad line (id divisible by n).
BLANK_EVERY = 67
SHORT_EVERY = 71
OTHER_YEAR_EVERY = 61
CODE_X_EVERY = 97
CODE_7_EVERY = 89
CODE_EMPTY_EVERY = 83
TIP_TEXT_EVERY = 79
TIP_EMPTY_EVERY = 73
TIP_NAN_EVERY = 59
TIP_HUGE_EVERY = 53

LINE_YEAR = "2024"
# Fixed value: the header line of the taxi files.
TAXI_HEADER = ("VendorID,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,"
               "trip_distance,RatecodeID,store_and_fwd_flag,PULocationID,DOLocationID,"
               "payment_type,fare_amount,extra,mta_tax,tip_amount,tolls_amount,"
               "improvement_surcharge,total_amount,congestion_surcharge")


def _every(n: int) -> Column:
    return (F.col("event_id") % F.lit(n)) == 0


def _code_of(event_type: Column) -> Column:
    expr = None
    for k, v in EVENT_PAYMENT_CODE.items():
        expr = F.when(event_type == k, v) if expr is None else expr.when(event_type == k, v)
    return expr


def trip_lines(spark: SparkSession, events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw taxi-style CSV lines (column ``value``): a header, one good line per event, and
    for some event ids one more line that is bad or of another kind.
    ``keep`` carries extra event columns along (NULL on the header line)."""

    def line(stamp: Column, code: Column, tip: Column) -> Column:
        fields = [
            (F.col("user_id") % 2 + 1).cast("string"), stamp, stamp,
            (F.col("user_id") % 4 + 1).cast("string"), F.lit("1.5"), F.lit("1"), F.lit("N"),
            F.col("user_id").cast("string"), F.lit("0"), code,
            F.col("value").cast("string"), F.lit("0"), F.lit("0.5"), tip,
            F.lit("0"), F.lit("0.3"), F.col("value").cast("string"), F.lit("0"),
        ]
        return F.concat(F.concat_ws(",", *fields), F.when(_every(5), F.lit("\r")).otherwise(F.lit("")))

    time_of = lambda ts: F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    stamp, code, tip = time_of(F.col("ts")), _code_of(F.col("event_type")), F.col("value").cast("string")
    short = F.concat_ws(",", F.col("user_id").cast("string"), stamp)
    extra = [
        F.when(_every(BLANK_EVERY), F.lit("")), F.when(_every(SHORT_EVERY), short),
        F.when(_every(OTHER_YEAR_EVERY), line(time_of(F.col("ts") - F.expr("INTERVAL 1 YEAR")), code, tip)),
        F.when(_every(CODE_X_EVERY), line(stamp, F.lit("x"), tip)),
        F.when(_every(CODE_7_EVERY), line(stamp, F.lit("7"), tip)),
        F.when(_every(CODE_EMPTY_EVERY), line(stamp, F.lit(""), tip)),
        F.when(_every(TIP_TEXT_EVERY), line(stamp, code, F.lit("abc"))),
        F.when(_every(TIP_EMPTY_EVERY), line(stamp, code, F.lit(""))),
        F.when(_every(TIP_NAN_EVERY), line(stamp, code, F.lit("nan"))),
        F.when(_every(TIP_HUGE_EVERY), line(stamp, code, F.lit("1e300"))),
    ]
    lines = F.filter(F.array(line(stamp, code, tip), *extra), lambda x: x.isNotNull())
    body = events.select(F.explode(lines).alias("value"), *keep)
    header = spark.createDataFrame([(TAXI_HEADER,)], "value string")
    for c in keep:
        header = header.withColumn(c, F.lit(None).cast(body.schema[c].dataType))
    return header.unionByName(body)


# SQL twin of trip_lines after parsing: every event's good line, and the extra lines that parse.
TRIP_LINES_PARSED_SQL = f"""
WITH g AS (
  SELECT event_id, ts, CASE event_type WHEN 'click' THEN '1' WHEN 'error' THEN '2'
         WHEN 'purchase' THEN '3' WHEN 'signup' THEN '4' WHEN 'view' THEN '5' END AS code, value AS tip
  FROM events
), e AS (
  SELECT ts AS pts, code, tip FROM g
  UNION ALL SELECT ts - INTERVAL 1 YEAR, code, tip FROM g WHERE event_id % {OTHER_YEAR_EVERY} = 0
  UNION ALL SELECT ts, 'x', tip FROM g WHERE event_id % {CODE_X_EVERY} = 0
  UNION ALL SELECT ts, '7', tip FROM g WHERE event_id % {CODE_7_EVERY} = 0
  UNION ALL SELECT ts, '', tip FROM g WHERE event_id % {CODE_EMPTY_EVERY} = 0
  UNION ALL SELECT ts, code, NULL FROM g WHERE event_id % {TIP_TEXT_EVERY} = 0
  UNION ALL SELECT ts, code, NULL FROM g WHERE event_id % {TIP_EMPTY_EVERY} = 0
  UNION ALL SELECT ts, code, 'nan'::DOUBLE FROM g WHERE event_id % {TIP_NAN_EVERY} = 0
  UNION ALL SELECT ts, code, 1e300 FROM g WHERE event_id % {TIP_HUGE_EVERY} = 0
)
SELECT strftime(pts, '%Y-%m') AS month, code AS payment_type, tip AS tip_amount
FROM e WHERE strftime(pts, '%Y') = '{LINE_YEAR}' AND code <> ''
"""


def orders_as_trips(orders: DataFrame) -> DataFrame:
    """Orders as taxi trips: payment code = leading digit of the priority,
    total = order price, pickup = order date (midnight timestamps)."""
    return orders.select(
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("payment_type"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderdate").alias("tpep_pickup_datetime"))


ORDERS_AS_TRIPS_SQL = """
SELECT TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS payment_type,
       o_totalprice AS total_amount, o_orderdate AS tpep_pickup_datetime
FROM orders
"""

PAYMENT_VALUES_SQL = "(VALUES " + ", ".join(f"({i}, '{name}')" for i, name in PAYMENT_TYPES) + ") AS p(id, name)"


PAGE_SIZE = 20


def conversation_pages(conversations: DataFrame) -> DataFrame:
    """Conversations as landed API pages of ``PAGE_SIZE`` locations, of those that are there.

    A location is one conversation: id = conv_id, name = 'conversation <id>',
    type = role of the first turn, dimension = role of the last turn,
    residents = the distinct speakers, a role and the last digit of its text's length.
    Locations are numbered in id order over the ids present, so pages have no gaps.

    Per conversation only aggregates are computed (``collect_set``, ``min_by`` /
    ``max_by``), all with map-side partial results.  A resident list is bounded by ten
    times the number of roles, and a page holds at most ``PAGE_SIZE`` locations, so no
    row grows with a conversation's length.  ``pages`` (how many there are) comes from the
    numbers, not from the finished pages.
    """
    speaker = F.concat("role", F.lit(" "), (F.length("text") % 10).cast("string"))
    conv = conversations.groupBy("conv_id").agg(
        F.array_sort(F.collect_set(speaker)).alias("speakers"),
        F.min_by("role", "turn").alias("first_role"),
        F.max_by("role", "turn").alias("last_role"))
    numbered = dense_numbers(conv, ["conv_id"], "place")
    loc = numbered.select(
        (F.floor(F.col("place") / PAGE_SIZE) + 1).cast("int").alias("page"), "place",
        F.struct(F.col("conv_id").alias("id"),
                 F.concat(F.lit("conversation "), F.col("conv_id").cast("string")).alias("name"),
                 F.col("first_role").alias("type"),
                 F.col("last_role").alias("dimension"),
                 F.col("speakers").alias("residents")
                 ).alias("loc"))
    pages = loc.groupBy("page").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "loc"))), lambda x: x["loc"]).alias("results"))
    return pages.withColumn("pages", F.lit(loc.agg(F.max("page")).first()[0] or 0))


CONVERSATION_LOCATIONS_SQL = f"""
SELECT CAST(floor(place / {PAGE_SIZE}) + 1 AS INTEGER) AS page, CAST(place % {PAGE_SIZE} AS INTEGER) AS pos, * EXCLUDE (place)
FROM (SELECT row_number() OVER (ORDER BY conv_id) - 1 AS place, conv_id AS id,
       'conversation ' || CAST(conv_id AS VARCHAR) AS name,
       arg_min(role, turn) AS type,
       arg_max(role, turn) AS dimension,
       CAST(count(DISTINCT role || ' ' || CAST(length(text) % 10 AS VARCHAR)) AS INTEGER) AS residents_cnt
FROM conversations GROUP BY conv_id)
"""
