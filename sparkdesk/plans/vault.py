"""Vault and anchor loads on events (profile = user_id, load time = ts,
attributes = event_type / value), orders (order-customer link) and the
region -> nation -> customer place chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkdesk.functions.keys import hash_key
from sparkdesk.operators import anchor, vault
from sparkdesk.operators.keyed_scan import WHOLE_ROWS, Chunks
from sparkdesk.plans.registry import query
from sparkdesk.session import scratch_path
from sparkdesk.sinks import writers
from sparkdesk.sources.tables import table

HUB_CUTOFF, HUB_LOAD_1, HUB_LOAD_2 = "2024-01-15 00:00:00", "2024-01-15 00:00:00", "2024-01-31 00:00:00"
LINK_CUTOFF, LINK_LOAD_1, LINK_LOAD_2 = "1998-01-01 00:00:00", "1998-01-01 00:00:00", "2002-01-01 00:00:00"
AS_OF = "2024-01-15 12:00:00"


def _hk_sql(*cols: str) -> str:
    texts = [f"upper(trim(CAST({c} AS VARCHAR)))" for c in cols]
    return "sha256(" + " || ".join(f"coalesce(length({t}) || ':' || {t}, 'N')" for t in texts) + ")"


# Rows above which one profile counts as hot and is chunked by minute instead of day.
HOT_KEY_ROWS = 1_000_000


def _day(col="ts", whole_rows=WHOLE_ROWS):
    """Chunking of a profile's history: a large one by day, a hot one by minute."""
    c = F.col(col) if isinstance(col, str) else col
    return Chunks(F.date_trunc("day", c), F.date_trunc("minute", c), HOT_KEY_ROWS, whole_rows=whole_rows)


def _ts(v):
    return F.lit(v).cast("timestamp_ntz")


@query("hub_load", sql=f"""
SELECT {_hk_sql('user_id')} AS profile_hk, user_id,
       CASE WHEN min(ts) < TIMESTAMP '{HUB_CUTOFF}' THEN TIMESTAMP '{HUB_LOAD_1}'
            ELSE TIMESTAMP '{HUB_LOAD_2}' END AS load_dttm,
       'events' AS source_id
FROM events GROUP BY user_id
""")
def hub_load(spark, sf_dir):
    """Two daily batches (the second re-sends old keys), the second loaded twice."""
    ev = table(spark, sf_dir, "events")
    path = scratch_path(spark, "h_profile")
    first = ev.where(F.col("ts") < _ts(HUB_CUTOFF))
    writers.append(vault.hub_rows(first, ["user_id"], "profile_hk", None, HUB_LOAD_1, "events"), path)
    for _ in range(2):
        existing = spark.read.parquet(path)
        writers.append(vault.hub_rows(ev, ["user_id"], "profile_hk", existing, HUB_LOAD_2, "events"), path)
    return spark.read.parquet(path)


@query("link_load", sql=f"""
SELECT {_hk_sql('o_orderkey', 'o_custkey')} AS order_customer_hk,
       {_hk_sql('o_orderkey')} AS order_hk, {_hk_sql('o_custkey')} AS customer_hk,
       CASE WHEN min(o_orderdate) < TIMESTAMP '{LINK_CUTOFF}' THEN TIMESTAMP '{LINK_LOAD_1}'
            ELSE TIMESTAMP '{LINK_LOAD_2}' END AS load_dttm,
       'orders' AS source_id
FROM orders GROUP BY o_orderkey, o_custkey
""")
def link_load(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    parts = {"order_hk": ["o_orderkey"], "customer_hk": ["o_custkey"]}
    path = scratch_path(spark, "l_order_customer")
    first = orders.where(F.col("o_orderdate") < _ts(LINK_CUTOFF))
    writers.append(vault.link_rows(first, parts, "order_customer_hk", None, LINK_LOAD_1, "orders"), path)
    existing = spark.read.parquet(path)
    writers.append(vault.link_rows(orders, parts, "order_customer_hk", existing, LINK_LOAD_2, "orders"),
                   path)
    return spark.read.parquet(path)


def _profile_history(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.withColumn("profile_hk", hash_key("user_id"))


CHANGES_SQL = """
SELECT * FROM (
  SELECT {hk} AS profile_hk, user_id, event_id, ts, {col},
         lag({col}) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events) x
WHERE rn = 1 OR prev IS DISTINCT FROM {col}
"""


@query("satellite_load", sql=f"""
SELECT profile_hk, ts AS load_dttm, event_type
FROM ({CHANGES_SQL.format(hk=_hk_sql('user_id'), col='event_type')}) c
""")
def satellite_load(spark, sf_dir):
    h = _profile_history(spark, sf_dir)
    sat = vault.satellite_changes(h, "profile_hk", "ts", ["event_type"], tie=["event_id"],
                                  chunk=_day().counted_on(h.select("profile_hk")))
    return sat.select("profile_hk", F.col("ts").alias("load_dttm"), "event_type")


@query("scd2_intervals", sql=f"""
SELECT profile_hk, ts AS valid_from_dttm,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to_dttm, value
FROM ({CHANGES_SQL.format(hk=_hk_sql('user_id'), col='value')}) c
""")
def scd2_intervals(spark, sf_dir):
    h = _profile_history(spark, sf_dir)
    chunks = _day().counted_on(h.select("profile_hk"))
    sat = vault.satellite_changes(h, "profile_hk", "ts", ["value"], tie=["event_id"], chunk=chunks)
    iv = vault.validity_intervals(sat, "profile_hk", "ts", tie=["event_id"], chunk=chunks)
    return iv.select("profile_hk", "valid_from_dttm", "valid_to_dttm", "value")


@query("pit_build", sql=f"""
WITH a AS (SELECT DISTINCT user_id, date_trunc('hour', ts) AS h FROM events WHERE event_type = 'click'),
     b AS (SELECT DISTINCT user_id, date_trunc('hour', ts) AS h FROM events WHERE event_type = 'purchase'),
     p AS (SELECT user_id, h FROM a UNION SELECT user_id, h FROM b)
SELECT {_hk_sql('user_id')} AS profile_hk, p.h AS pit_dttm,
       (SELECT max(a.h) FROM a WHERE a.user_id = p.user_id AND a.h <= p.h) AS click_load_dttm,
       (SELECT max(b.h) FROM b WHERE b.user_id = p.user_id AND b.h <= p.h) AS purchase_load_dttm,
       lead(p.h) OVER (PARTITION BY p.user_id ORDER BY p.h) AS valid_to_dttm
FROM p
""")
def pit_build(spark, sf_dir):
    """Two satellites of a profile (hourly click and purchase loads) -> PIT."""
    h = _profile_history(spark, sf_dir).withColumn("load_dttm", F.date_trunc("hour", "ts"))
    sats = {name: h.where(F.col("event_type") == name).select("profile_hk", "load_dttm").distinct()
            for name in ("click", "purchase")}
    hot_from = h.select("profile_hk")     # raw rows: never fewer per profile than the points
    # every profile is cut into days, however few its points
    pit = vault.pit_table("profile_hk", sats, chunk_of=lambda c: _day(c, whole_rows=0).counted_on(hot_from))
    return pit.select("profile_hk", "pit_dttm", "click_load_dttm", "purchase_load_dttm", "valid_to_dttm")


@query("bridge_place", sql=f"""
SELECT {_hk_sql('c.c_custkey')} AS place_hk, c.c_custkey,
       {_hk_sql('n.n_nationkey')} AS nation_hk, n.n_name,
       {_hk_sql('r.r_regionkey')} AS region_hk, r.r_name
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def bridge_place(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    b = vault.bridge(cust, [(nation, "c_nationkey", "n_nationkey"), (region, "n_regionkey", "r_regionkey")])
    return b.select(hash_key("c_custkey").alias("place_hk"), "c_custkey",
                    hash_key("n_nationkey").alias("nation_hk"), "n_name",
                    hash_key("r_regionkey").alias("region_hk"), "r_name")


ANCHOR_ATTRS = ["event_type", "value"]


def _anchor_tables(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return anchor.split_attributes(ev, "user_id", "ts", ANCHOR_ATTRS,
                                   tie=["event_id"], chunk=_day().counted_on(ev.select("user_id")))


@query("anchor_split", sql="""
SELECT 'event_type' AS attribute, user_id, ts AS load_dttm, event_type, CAST(NULL AS DOUBLE) AS value
FROM (""" + CHANGES_SQL.format(hk="user_id", col="event_type") + """) a
UNION ALL
SELECT 'value' AS attribute, user_id, ts AS load_dttm, CAST(NULL AS VARCHAR) AS event_type, value
FROM (""" + CHANGES_SQL.format(hk="user_id", col="value") + """) b
""")
def anchor_split(spark, sf_dir):
    tabs = _anchor_tables(spark, sf_dir)
    out = None
    for a, t in tabs.items():
        x = t.select(F.lit(a).alias("attribute"), "user_id", "load_dttm",
                     (F.col("event_type") if a == "event_type" else F.lit(None).cast("string")).alias("event_type"),
                     (F.col("value") if a == "value" else F.lit(None).cast("double")).alias("value"))
        out = x if out is None else out.unionByName(x)
    return out


@query("anchor_latest", sql="""
SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value
FROM events GROUP BY user_id
""")
def anchor_latest(spark, sf_dir):
    return anchor.latest_of(table(spark, sf_dir, "events"), "user_id", "ts", ANCHOR_ATTRS, tie=["event_id"])


@query("anchor_asof", sql=f"""
SELECT user_id,
       arg_max(event_type, (ts, event_id)) FILTER (WHERE ts <= TIMESTAMP '{AS_OF}') AS event_type,
       arg_max(value, (ts, event_id)) FILTER (WHERE ts <= TIMESTAMP '{AS_OF}') AS value
FROM events GROUP BY user_id
""")
def anchor_asof(spark, sf_dir):
    return anchor.latest_of(table(spark, sf_dir, "events"), "user_id", "ts", ANCHOR_ATTRS, tie=["event_id"], as_of=AS_OF)
