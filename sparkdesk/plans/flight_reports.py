"""The five flight reports on TPC-H stand-ins.

flights -> lineitem (tail number -> l_partkey, origin/destination ->
l_suppkey/l_linenumber, delay -> l_extendedprice, weekday -> l_quantity);
airlines -> supplier; airports -> nation (used in two roles: supplier nation
and customer nation).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkdesk.functions.stats import exact_avg, round_half
from sparkdesk.operators import reports
from sparkdesk.plans.registry import query
from sparkdesk.sources.tables import table

HAVING_THRESHOLD = 100000.0


@query("topk_count", sql="""
SELECT l_partkey, count(l_partkey) AS count
FROM lineitem WHERE l_partkey IS NOT NULL
GROUP BY l_partkey ORDER BY count DESC, l_partkey LIMIT 10
""")
def topk_count(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return reports.top_k_by_count(li, "l_partkey", k=10)


@query("route_stats", sql="""
SELECT l_suppkey, l_linenumber, count(l_partkey) AS tail_count,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(l_quantity) AS avg_quantity
FROM lineitem GROUP BY l_suppkey, l_linenumber
ORDER BY tail_count DESC, l_suppkey, l_linenumber LIMIT 10
""")
def route_stats(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    out = reports.route_stats(li, ["l_suppkey", "l_linenumber"], counted="l_partkey",
                              measure="l_quantity", k=10, mean_alias="avg_quantity",
                              mean_fn=exact_avg)
    return out


@query("having_stats", sql=f"""
SELECT l_partkey,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(l_extendedprice) AS avg_price,
       min(l_extendedprice) AS min_price,
       max(l_extendedprice) AS max_price,
       round(covar_pop(l_extendedprice, l_quantity)
             / nullif(stddev_pop(CASE WHEN l_quantity IS NOT NULL THEN l_extendedprice END)
                      * stddev_pop(CASE WHEN l_extendedprice IS NOT NULL THEN l_quantity END), 0),
             6) AS corr_price_l_quantity
FROM lineitem GROUP BY l_partkey
HAVING max(l_extendedprice) >= {HAVING_THRESHOLD}
""")
def having_stats(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    out = reports.having_stats(li, "l_partkey", "l_extendedprice", "l_quantity",
                               HAVING_THRESHOLD, prefix="price", mean_fn=exact_avg)
    return out.withColumn("corr_price_l_quantity", round_half("corr_price_l_quantity"))


@query("role_join", sql="""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, s.s_name,
       sn.n_name AS supp_n_name, sn.n_regionkey AS supp_n_regionkey,
       c.c_name,
       cn.n_name AS cust_n_name, cn.n_regionkey AS cust_n_regionkey
FROM lineitem l
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation sn ON s.s_nationkey = sn.n_nationkey
JOIN nation cn ON c.c_nationkey = cn.n_nationkey
""")
def role_join(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                                "l_suppkey")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = table(spark, sf_dir, "nation")
    # orders x customer first: the big lineitem side is shuffled once, on l_orderkey.
    oc = orders.join(cust, orders.o_custkey == cust.c_custkey, "inner")
    fact = (li.join(supp, li.l_suppkey == supp.s_suppkey, "inner")
              .join(oc, li.l_orderkey == oc.o_orderkey, "inner"))
    out = reports.role_join(fact, nation, "n_nationkey",
                            {"supp": "s_nationkey", "cust": "c_nationkey"},
                            ["n_name", "n_regionkey"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "s_name",
                      "supp_n_name", "supp_n_regionkey", "c_name",
                      "cust_n_name", "cust_n_regionkey")


COND_FLAGS_SQL = """
SELECT s.s_name,
       CAST(sum(CASE WHEN l.l_returnflag IS NOT DISTINCT FROM 'N'
                      AND l.l_linestatus IS NOT DISTINCT FROM 'O' THEN 1 ELSE 0 END) AS BIGINT) AS correct_count,
       CAST(sum(CASE WHEN l.l_returnflag IS NOT DISTINCT FROM 'R' THEN 1 ELSE 0 END) AS BIGINT) AS returned_count,
       CAST(sum(CASE WHEN l.l_returnflag IS NOT DISTINCT FROM 'A' THEN 1 ELSE 0 END) AS BIGINT) AS accepted_count,
       CAST(sum(CASE WHEN l.l_linestatus IS NOT DISTINCT FROM 'F' THEN 1 ELSE 0 END) AS BIGINT) AS filled_count,
       CAST(sum(CAST(l.l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(l.l_quantity) AS avg_quantity,
       CAST(sum(CAST(l.l_discount AS DECIMAL(18,2))) AS DOUBLE) / count(l.l_discount) AS avg_discount
FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey
GROUP BY s.s_name
"""


def cond_flags():
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    return {
        "correct_count": rf.eqNullSafe("N") & ls.eqNullSafe("O"),
        "returned_count": rf.eqNullSafe("R"),
        "accepted_count": rf.eqNullSafe("A"),
        "filled_count": ls.eqNullSafe("F"),
    }


@query("cond_counts", sql=COND_FLAGS_SQL)
def cond_counts(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    supp = table(spark, sf_dir, "supplier")
    out = reports.conditional_counts_via_dim(
        li, "l_suppkey", supp, "s_suppkey", "s_name", cond_flags(),
        means={"avg_quantity": "l_quantity", "avg_discount": "l_discount"}, mean_scale=2)
    return out
