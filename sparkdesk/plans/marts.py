"""Marts on TPC-H stand-ins.

content = part, three levels by key: every 100th key a series (no parent),
every other 10th key a season (parent = key - key % 100), the rest episodes
(parent = key - key % 10).  watch fact = lineitem (profile = order's customer,
device = supplier, start time = ship date).  payment fact = orders (amount =
total price; content = the customer key read as a part key, NULL for pending
orders, which stand for subscription payments).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkdesk.functions.stats import exact_sum, usable
from sparkdesk.operators import marts
from sparkdesk.operators.joins import left_join_nulls_apart
from sparkdesk.plans.registry import query
from sparkdesk.sources.tables import table

CONTENT_SQL = """
SELECT p_partkey AS content_id, p_name AS content_name, p_type AS content_type, p_size AS content_duration,
       p_retailprice AS content_rating,
       CASE WHEN p_partkey % 100 = 0 THEN NULL
            WHEN p_partkey % 10 = 0 THEN p_partkey - p_partkey % 100
            ELSE p_partkey - p_partkey % 10 END AS parent_content_id
FROM part
"""

HIER_SQL = f"""
SELECT c.content_id AS id, c.parent_content_id AS parent_id, p.parent_content_id AS grandparent_id,
       coalesce(p.parent_content_id, c.parent_content_id, c.content_id) AS root_id,
       CASE WHEN p.parent_content_id IS NOT NULL THEN 2
            WHEN c.parent_content_id IS NOT NULL THEN 1 ELSE 0 END AS level
FROM ({CONTENT_SQL}) c LEFT JOIN ({CONTENT_SQL}) p ON c.parent_content_id = p.content_id
"""


def content(spark, sf_dir):
    k = F.col("p_partkey")
    parent = (F.when(k % 100 == 0, F.lit(None).cast("long"))
               .when(k % 10 == 0, k - k % 100).otherwise(k - k % 10))
    return table(spark, sf_dir, "part").select(
        k.alias("content_id"), F.col("p_name").alias("content_name"), F.col("p_type").alias("content_type"),
        F.col("p_size").alias("content_duration"), F.col("p_retailprice").alias("content_rating"),
        parent.alias("parent_content_id"))


CONTENT_COLUMNS = ["content_name", "content_type", "content_duration", "content_rating"]


def _hier(spark, sf_dir, carry=()):
    return marts.resolve_hierarchy(content(spark, sf_dir), "content_id", "parent_content_id", carry)


def _content_dim(spark, sf_dir):
    """The content with its place in the hierarchy: one read, the hierarchy carries the columns."""
    return _hier(spark, sf_dir, CONTENT_COLUMNS).withColumnRenamed("id", "c_content_id")


@query("hierarchy_root", sql=HIER_SQL)
def hierarchy_root(spark, sf_dir):
    return _hier(spark, sf_dir)


#: Stand-in for a profile's contacts: a customer has one if its key is divisible by the number.
CONTACTS = {"mail": 2, "phone": 3, "vk": 5, "ok": 7, "yandex": 11}
CONTACT_FLAGS = [f"is_{c}" for c in CONTACTS]
PROFILE_COLUMNS = [*CONTACT_FLAGS, "signup_method", "gender", "age", "age_group", "balance"]

_PROFILE_MORE_SQL = ", ".join(f"(c.c_custkey % {n} = 0)::INT AS is_{x}" for x, n in CONTACTS.items()) + f""",
       CASE {" ".join(f"WHEN c.c_custkey % {n} = 0 THEN '{x}'" for x, n in CONTACTS.items())} ELSE 'none' END AS signup_method,
       CASE WHEN c.c_custkey % 4 < 2 THEN 'f' ELSE 'm' END AS gender, CAST(18 + c.c_custkey % 60 AS INTEGER) AS age,
       CAST((18 + c.c_custkey % 60) // 10 * 10 AS INTEGER) AS age_group, c.c_acctbal AS balance"""


def _profile_attributes():
    """Contacts, presence flags, the sign-up method (the first contact), gender, age and balance."""
    k = F.col("c_custkey")
    contacts = {x: F.when(k % n == 0, F.concat(F.lit(f"{x}:"), k.cast("string"))) for x, n in CONTACTS.items()}
    return contacts, {"gender": F.when(k % 4 < 2, "f").otherwise("m"), "age": (18 + k % 60).cast("int"),
                      "age_group": (F.floor((18 + k % 60) / 10) * 10).cast("int"), "balance": F.col("c_acctbal")}


def _profiles(spark, sf_dir):
    contacts, more = _profile_attributes()
    cust = table(spark, sf_dir, "customer").withColumns(contacts)
    method = F.coalesce(*[F.when(F.col(x).isNotNull(), F.lit(x)) for x in CONTACTS], F.lit("none"))
    cust = cust.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey", *marts.presence_flags({x: x for x in CONTACTS}),
                       method.alias("signup_method"), *[v.alias(c) for c, v in more.items()])
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region")
    return (cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left")
                .join(region, F.col("n_regionkey") == region.r_regionkey, "left")
                .select("c_custkey", "c_name", "c_mktsegment", "n_name", "r_name", *PROFILE_COLUMNS))


PROFILES_SQL = f"""
SELECT c.c_custkey, c.c_name, c.c_mktsegment, n.n_name, r.r_name, {_PROFILE_MORE_SQL}
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
"""


MART_WATCH_SQL = f"""
SELECT l.l_shipdate AS start_time, pr.c_custkey AS profile_id, pr.c_mktsegment AS segment,
       pr.n_name AS country, pr.r_name AS continent, {", ".join(f"pr.{c}" for c in PROFILE_COLUMNS)},
       s.s_name AS device, s.s_nationkey AS device_origin, s.s_acctbal AS device_diagonal,
       l.l_partkey AS content_id, {", ".join(f"c.{c}" for c in CONTENT_COLUMNS)},
       h.level AS content_level, h.parent_id AS parent_content_id, h.root_id AS root_content_id,
       CASE WHEN h.parent_id IS NOT NULL THEN 1 ELSE 0 END AS is_parent,
       CASE WHEN h.grandparent_id IS NOT NULL THEN 1 ELSE 0 END AS is_grandparent,
       l.l_quantity AS duration
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN ({PROFILES_SQL}) pr ON o.o_custkey = pr.c_custkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN ({CONTENT_SQL}) c ON l.l_partkey = c.content_id
LEFT JOIN ({HIER_SQL}) h ON l.l_partkey = h.id
"""


@query("mart_watch", sql=MART_WATCH_SQL)
def mart_watch(spark, sf_dir):
    return _mart_watch(spark, sf_dir)


@query("mart_watch_questions", sql=f"""
SELECT continent, segment, device, content_level, count(*) AS watches,
       CAST(sum(CAST(duration AS DECIMAL(18,2))) AS DOUBLE) AS watched
FROM ({MART_WATCH_SQL}) m GROUP BY continent, segment, device, content_level
""")
def mart_watch_questions(spark, sf_dir):
    """Which user groups (continent x segment) watch on which device, and
    which kind of content (level): views and total watched duration."""
    m = _mart_watch(spark, sf_dir)
    return m.groupBy("continent", "segment", "device", "content_level").agg(
        F.count(F.lit(1)).alias("watches"), exact_sum("duration").alias("watched"))


def _mart_watch(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey",
                                                "l_shipdate", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    supp = table(spark, sf_dir, "supplier")
    # orders x profile first (orders-sized), so lineitem crosses one shuffle per key it joins on.
    op = orders.join(_profiles(spark, sf_dir), orders.o_custkey == F.col("c_custkey"))
    cont = _content_dim(spark, sf_dir)
    fact = (li.join(op, li.l_orderkey == op.o_orderkey)
              .join(supp, li.l_suppkey == supp.s_suppkey, "left")
              .join(cont, li.l_partkey == cont.c_content_id, "left"))
    return fact.select(
        F.col("l_shipdate").alias("start_time"), F.col("c_custkey").alias("profile_id"),
        F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("country"),
        F.col("r_name").alias("continent"), *PROFILE_COLUMNS, F.col("s_name").alias("device"),
        F.col("s_nationkey").alias("device_origin"), F.col("s_acctbal").alias("device_diagonal"),
        F.col("l_partkey").alias("content_id"), *CONTENT_COLUMNS,
        F.col("level").alias("content_level"), F.col("parent_id").alias("parent_content_id"),
        F.col("root_id").alias("root_content_id"),
        *marts.presence_flags({"parent": "parent_id", "grandparent": "grandparent_id"}),
        F.col("l_quantity").alias("duration"))


PAYMENT_FACT_SQL = """
SELECT o_orderdate AS dttm, o_custkey AS profile_id, o_orderpriority AS payment_type,
       o_totalprice AS amount,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS content_id
FROM orders
"""


def _payments(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderdate").alias("dttm"), F.col("o_custkey").alias("profile_id"),
                    F.col("o_orderpriority").alias("payment_type"), F.col("o_totalprice").alias("amount"),
                    F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("long"))
                     .otherwise(F.col("o_custkey")).alias("content_id"))


#: The payment mart has no age.
PAYMENT_PROFILE_COLUMNS = [c for c in PROFILE_COLUMNS if c not in ("age", "age_group")]

MART_PAYMENT_SQL = f"""
SELECT pay.dttm, pay.profile_id, pr.c_mktsegment AS segment, pr.n_name AS country,
       pr.r_name AS continent, {", ".join(f"pr.{c}" for c in PAYMENT_PROFILE_COLUMNS)}, pay.payment_type, pay.amount, pay.content_id,
       {", ".join(f"c.{c}" for c in CONTENT_COLUMNS)}, h.level AS content_level, h.parent_id AS parent_content_id,
       h.root_id AS root_content_id
FROM ({PAYMENT_FACT_SQL}) pay
JOIN ({PROFILES_SQL}) pr ON pay.profile_id = pr.c_custkey
LEFT JOIN ({CONTENT_SQL}) c ON pay.content_id = c.content_id
LEFT JOIN ({HIER_SQL}) h ON pay.content_id = h.id
"""


def _mart_payment(spark, sf_dir):
    pay = _payments(spark, sf_dir)
    cont = _content_dim(spark, sf_dir)
    # subscription payments (no content) skip the content join instead of sharing one
    # task; split at the payment scan (the NULL test reaches it as a pushed filter),
    # so the profile join below runs once on the union
    with_content = left_join_nulls_apart(pay, cont, "content_id", "c_content_id")
    fact = with_content.join(_profiles(spark, sf_dir), F.col("profile_id") == F.col("c_custkey"))
    return fact.select(
        "dttm", "profile_id", F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("country"),
        F.col("r_name").alias("continent"), *PAYMENT_PROFILE_COLUMNS, "payment_type", "amount", "content_id", *CONTENT_COLUMNS,
        F.col("level").alias("content_level"), F.col("parent_id").alias("parent_content_id"),
        F.col("root_id").alias("root_content_id"))


@query("mart_payment", sql=MART_PAYMENT_SQL)
def mart_payment(spark, sf_dir):
    return _mart_payment(spark, sf_dir)


@query("mart_questions", sql=f"""
SELECT continent, segment, content_level, count(*) AS payments,
       CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS paid
FROM ({MART_PAYMENT_SQL}) m GROUP BY continent, segment, content_level
""")
def mart_questions(spark, sf_dir):
    """Which user groups (continent x segment) pay for which kind of content
    (level; NULL = subscription)."""
    m = _mart_payment(spark, sf_dir)
    return m.groupBy("continent", "segment", "content_level").agg(
        F.count(F.lit(1)).alias("payments"), exact_sum("amount").alias("paid"))


#: Each question groups the watches by one of these.
QUESTIONS = [("continent",), ("signup_method",), ("age_group", "gender"), ("device",), ("content_level",),
             ("continent", "content_level"), ("signup_method", "content_level"), ("age_group", "gender", "content_level")]
QUESTION_COLUMNS = ["continent", "signup_method", "age_group", "gender", "device", "content_level"]


@query("mart_cube", sql=f"""
SELECT CASE {" ".join(
    "WHEN " + " AND ".join(f"grouping({c}) = {int(c not in q)}" for c in QUESTION_COLUMNS) + f" THEN '{'+'.join(q)}'" for q in QUESTIONS)} END AS question,
       {", ".join(QUESTION_COLUMNS)}, count(*) AS watches, CAST(sum(CAST(duration AS DECIMAL(26,6))) AS DOUBLE) AS watched
FROM ({MART_WATCH_SQL}) m GROUP BY GROUPING SETS ({", ".join("(" + ", ".join(q) + ")" for q in QUESTIONS)})
""")
def mart_cube(spark, sf_dir):
    """All questions in one pass: the fact is summed on its foreign keys, meets each dimension
    once, and one expansion groups it by every question; ``question`` tells them apart."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    amount = usable("l_quantity").cast("decimal(26,6)")
    fact = (li.join(orders, li.l_orderkey == orders.o_orderkey).groupBy("o_custkey", "l_suppkey", "l_partkey")
              .agg(F.count("*").alias("n"), F.sum(amount).alias("total")))
    profiles = _profiles(spark, sf_dir).select("c_custkey", F.col("r_name").alias("continent"), "signup_method", "age_group", "gender")
    devices = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("device"))
    levels = _hier(spark, sf_dir).select("id", F.col("level").alias("content_level"))
    m = (fact.join(profiles, F.col("o_custkey") == F.col("c_custkey"))
             .join(devices, F.col("l_suppkey") == F.col("s_suppkey"), "left")
             .join(levels, F.col("l_partkey") == F.col("id"), "left"))
    cols = [F.col(c) for c in QUESTION_COLUMNS]
    named = F.lit(None).cast("string")
    for q in QUESTIONS:
        bits = sum(1 << i for i, c in enumerate(reversed(QUESTION_COLUMNS)) if c not in q)
        named = F.when(F.grouping_id() == bits, "+".join(q)).otherwise(named)
    sets = [[F.col(c) for c in q] for q in QUESTIONS]
    return (m.groupingSets(sets, *cols).agg(named.alias("question"), F.sum("n").alias("watches"), F.sum("total").cast("double").alias("watched"))
            .select("question", *QUESTION_COLUMNS, "watches", "watched"))
