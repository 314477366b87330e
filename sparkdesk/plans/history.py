"""Historised profiles: as-of joins, incremental satellites and links, ties and bridges.

Stand-ins: the profile is the order's customer, whose balance and segment change with each
order (total price, priority); a watch is a line item at its ship date.  For loads in batches the
profile is the events' user, with event type and value as attributes, and the event type read
as the place it is linked to.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkdesk.functions.keys import hash_key
from sparkdesk.operators import anchor, asof, satellite_log, vault
from sparkdesk.operators.keyed_scan import Chunks
from sparkdesk.plans.registry import query
from sparkdesk.plans.vault import AS_OF, CHANGES_SQL, _hk_sql
from sparkdesk.session import scratch_path
from sparkdesk.sinks import writers
from sparkdesk.sources.tables import table

#: A profile with more rows is cut into days in place of years (of minutes in place of days for events).
HOT_PROFILE_ROWS = 1_000_000


def _years(c, hot_rows=HOT_PROFILE_ROWS):
    return Chunks(F.date_trunc("year", c), F.date_trunc("day", c), hot_rows)


def _days(c="ts", hot_rows=HOT_PROFILE_ROWS):
    return Chunks(F.date_trunc("day", c), F.date_trunc("minute", c), hot_rows)


PROFILE_HISTORY_SQL = """
SELECT o_custkey, o_orderdate, arg_max(o_totalprice, o_orderkey) AS balance, arg_max(o_orderpriority, o_orderkey) AS segment
FROM orders GROUP BY o_custkey, o_orderdate
"""

WATCH_ASOF_SQL = f"""
WITH h AS ({PROFILE_HISTORY_SQL}),
w AS (SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate AS start_time, o.o_custkey AS profile_id, l.l_partkey AS content_id,
             l.l_quantity AS duration FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT w.*, h.balance, h.segment, h.o_orderdate AS valid_from
FROM w ASOF LEFT JOIN h ON w.profile_id = h.o_custkey AND w.start_time >= h.o_orderdate
"""


def watches_asof(spark, sf_dir, hot_rows=HOT_PROFILE_ROWS):
    """Each watch with its profile's balance and segment at the time it started."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")
    orders = table(spark, sf_dir, "orders")
    facts = li.join(orders.select("o_orderkey", "o_custkey"), li.l_orderkey == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").alias("start_time"), F.col("o_custkey").alias("profile_id"),
        F.col("l_partkey").alias("content_id"), F.col("l_quantity").alias("duration"))
    history = orders.select("o_custkey", "o_orderdate", "o_orderkey", F.col("o_totalprice").alias("balance"),
                            F.col("o_orderpriority").alias("segment"))
    return asof.asof_join(facts, history, "profile_id", "start_time", "o_orderdate", ["balance", "segment"], tie=["o_orderkey"],
                          history_keys="o_custkey", chunk_of=lambda c: _years(c, hot_rows))


@query("watch_asof", sql=WATCH_ASOF_SQL)
def watch_asof(spark, sf_dir):
    return watches_asof(spark, sf_dir)


@query("watch_asof_hot", sql=WATCH_ASOF_SQL)
def watch_asof_hot(spark, sf_dir):
    """The same with a limit so low that every busy profile is cut into days."""
    return watches_asof(spark, sf_dir, hot_rows=20)


@query("watch_asof_questions", sql=f"""
SELECT segment, CAST(floor(balance / 50000) AS BIGINT) AS balance_band, count(*) AS watches,
       CAST(sum(CAST(duration AS DECIMAL(18, 2))) AS DOUBLE) AS watched
FROM ({WATCH_ASOF_SQL}) GROUP BY ALL
""")
def watch_asof_questions(spark, sf_dir):
    """How much is watched by segment and balance at the time, not by today's."""
    w = watches_asof(spark, sf_dir)
    return w.groupBy("segment", F.floor(F.col("balance") / 50000).alias("balance_band")).agg(
        F.count("*").alias("watches"), F.sum(F.col("duration").cast("decimal(18,2)")).cast("double").alias("watched"))


#: Three batches: every seventh row comes last, long after later rows were loaded.
BATCHES = ("event_id % 7 <> 3 AND ts < TIMESTAMP '2024-01-12 00:00:00'",
           "event_id % 7 <> 3 AND ts >= TIMESTAMP '2024-01-10 00:00:00'", "event_id % 7 = 3")


def _loaded(rows, batches, payload, name, chunk):
    """A log filled batch by batch."""
    spark, log = rows.sparkSession, None
    path = scratch_path(spark, name)
    for i, batch in enumerate(batches):
        writers.append(satellite_log.increment(log, rows.where(batch), "profile_hk", "ts", [payload], i, tie=["event_id"],
                                               chunk=chunk), path)
        log = spark.read.parquet(path)
    return log


@query("satellite_increment", sql=f"""
SELECT profile_hk, ts AS load_dttm, event_type
FROM ({CHANGES_SQL.format(hk=_hk_sql('user_id'), col='event_type')}) c
""")
def satellite_increment(spark, sf_dir):
    """Three loads, the last one repeated, give the changes of the whole history."""
    ev = table(spark, sf_dir, "events").withColumn("profile_hk", hash_key("user_id"))
    log = _loaded(ev, (*BATCHES, BATCHES[-1]), "event_type", "s_profile", _days().counted_on(ev.select("profile_hk")))
    return satellite_log.changes(log, "profile_hk", "ts", ["event_type"], tie=["event_id"]).select(
        "profile_hk", F.col("ts").alias("load_dttm"), "event_type")


@query("link_validity", sql=f"""
SELECT profile_hk, {_hk_sql('event_type')} AS place_hk, ts AS valid_from,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to
FROM ({CHANGES_SQL.format(hk=_hk_sql('user_id'), col='event_type')}) c
""")
def link_validity(spark, sf_dir):
    """A profile's link to its place closes when the profile appears elsewhere, and opens anew if it returns."""
    ev = table(spark, sf_dir, "events").select(hash_key("user_id").alias("profile_hk"), "ts", "event_id",
                                               hash_key("event_type").alias("place_hk"))
    chunk = _days().counted_on(ev.select("profile_hk"))
    log = _loaded(ev, BATCHES, "place_hk", "l_profile_place", chunk)
    return satellite_log.link_validity(log, "profile_hk", "place_hk", "ts", tie=["event_id"], chunk=chunk)


@query("tie_asof", sql=f"""
WITH past AS (SELECT * FROM events WHERE ts <= TIMESTAMP '{AS_OF}'),
p AS (SELECT user_id, arg_max(value, (ts, event_id)) AS value, arg_max(event_type, (ts, event_id)) AS event_type
      FROM past GROUP BY user_id),
k AS (SELECT event_type, arg_max(value, (ts, event_id)) AS place_value FROM past GROUP BY event_type)
SELECT u.user_id, p.value, p.event_type, k.place_value
FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN p USING (user_id) LEFT JOIN k ON p.event_type = k.event_type
""")
def tie_asof(spark, sf_dir):
    """Profile and place through their tie, all as of one time."""
    ev = table(spark, sf_dir, "events")
    profiles = anchor.latest_of(ev, "user_id", "ts", ["value"], tie=["event_id"], as_of=AS_OF)
    places = anchor.latest_of(ev.where("event_type IS NOT NULL"), "event_type", "ts", ["value"], tie=["event_id"],
                              as_of=AS_OF).withColumnRenamed("value", "place_value")
    return anchor.tie_view(ev, profiles, places, "user_id", "event_type", "ts", tie=["event_id"], as_of=AS_OF)


#: The place chain: a customer's area moves with each order's priority, the city is the market
#: segment that the area belongs to by month, country and continent are fixed.
BRIDGE_SQL = f"""
WITH a0 AS (SELECT o_custkey, o_orderdate, arg_max(o_orderpriority, o_orderkey) AS area FROM orders GROUP BY 1, 2),
a1 AS (SELECT *, lag(area) OVER w IS DISTINCT FROM area OR lag(o_orderdate) OVER w IS NULL AS new FROM a0
       WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate)),
area AS (SELECT o_custkey, area, o_orderdate AS f, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS t
         FROM a1 WHERE new),
c0 AS (SELECT o_orderpriority AS area, date_trunc('year', o_orderdate) AS y,
              arg_max(o_custkey % 25, (o_totalprice, o_orderkey)) AS nation FROM orders GROUP BY 1, 2),
c1 AS (SELECT *, lag(nation) OVER w IS DISTINCT FROM nation OR lag(y) OVER w IS NULL AS new FROM c0
       WINDOW w AS (PARTITION BY area ORDER BY y)),
city AS (SELECT area, nation, y AS f, lead(y) OVER (PARTITION BY area ORDER BY y) AS t FROM c1 WHERE new),
first AS (SELECT o_custkey, min(f) AS f FROM area GROUP BY 1), cfirst AS (SELECT area, min(f) AS f FROM city GROUP BY 1),
l1 AS (SELECT c_custkey, area, f, t FROM customer JOIN area ON c_custkey = o_custkey
       UNION ALL SELECT c_custkey, NULL, NULL, f FROM customer LEFT JOIN first ON c_custkey = o_custkey),
city_all AS (SELECT * FROM city UNION ALL SELECT area, NULL, NULL, f FROM cfirst),
l2 AS (SELECT l1.c_custkey, l1.area, k.nation,
              greatest(l1.f, k.f) AS valid_from, least(l1.t, k.t) AS valid_to
       FROM l1 LEFT JOIN city_all k ON l1.area = k.area AND (k.f IS NULL OR l1.t IS NULL OR k.f < l1.t)
            AND (k.t IS NULL OR l1.f IS NULL OR l1.f < k.t))
SELECT {_hk_sql('c_custkey')} AS place_hk, area, nation::INTEGER AS nation, n_name AS country, r_name AS continent, valid_from, valid_to
FROM l2 LEFT JOIN nation ON nation = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
"""


@query("bridge_intervals", sql=BRIDGE_SQL)
def bridge_intervals(spark, sf_dir):
    """Place -> area -> nation -> country -> continent, an interval for each constellation."""
    orders = table(spark, sf_dir, "orders")
    day = orders.groupBy("o_custkey", "o_orderdate").agg(F.max_by("o_orderpriority", "o_orderkey").alias("area"))
    year = F.date_trunc("year", "o_orderdate").cast("timestamp_ntz")
    by_year = orders.groupBy(F.col("o_orderpriority").alias("area"), year.alias("y")).agg(
        F.max_by((F.col("o_custkey") % 25).cast("int"), F.struct("o_totalprice", "o_orderkey")).alias("nation"))

    def links(rows, child, parent, ts, chunk=None):
        rows = vault.satellite_changes(rows, child, ts, [parent], chunk=chunk)
        rows = vault.validity_intervals(rows, child, ts, "valid_from", "valid_to", chunk=chunk)
        return asof.link_intervals(rows, child, parent, "valid_from", "valid_to")

    def fixed(df, child, parent):
        ends = F.lit(None).cast("timestamp_ntz")
        return asof.link_intervals(df.withColumns({"valid_from": ends, "valid_to": ends}), child, parent, "valid_from", "valid_to")

    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    steps = [("area", links(day, "o_custkey", "area", "o_orderdate", _years("o_orderdate"))),
             ("nation", links(by_year, "area", "nation", "y")),
             ("country", fixed(nation, "n_nationkey", "n_name")),
             ("continent", fixed(nation.join(region, F.col("n_regionkey") == region.r_regionkey), "n_name", "r_name"))]
    base = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("place"))
    out = asof.temporal_bridge(base, "place", steps)
    return out.select(hash_key("place").alias("place_hk"), "area", "nation", "country", "continent", "valid_from", "valid_to")
