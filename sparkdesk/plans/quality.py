"""Data-quality profile on a product-like view of lineitem with NULLs made by ``nullif``."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkdesk.operators import quality, schema_check
from sparkdesk.plans.registry import query
from sparkdesk.sources.tables import table

# The columns and named predicates of the product profile.
PRODUCT_COLUMNS = ["id", "vendor_code", "name", "type", "label", "price", "discount",
                   "available_count", "preorder_count"]
COMPLIANCE = {
    "discount less than 0": "discount<0",
    "discount bigger than 100": "discount>100",
    "available_count less than 0": "available_count<0",
    "preorder_count less than 0": "preorder_count<0",
}


def products(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("id"),
        F.col("l_suppkey").cast("string").alias("vendor_code"),
        F.nullif(F.col("l_returnflag"), F.lit("R")).alias("name"),
        F.nullif(F.col("l_linestatus"), F.lit("F")).alias("type"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("label"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_quantity") * F.lit(2.2) - F.lit(5.0)).alias("discount"),
        F.nullif(F.col("l_linenumber") - F.lit(2), F.lit(0)).alias("available_count"),
        (F.col("l_partkey") % 7 - 1).alias("preorder_count"))


PRODUCTS_SQL = """
SELECT l_orderkey AS id, CAST(l_suppkey AS VARCHAR) AS vendor_code,
       nullif(l_returnflag, 'R') AS name, nullif(l_linestatus, 'F') AS type,
       l_returnflag || l_linestatus AS label, l_extendedprice AS price,
       l_quantity * 2.2 - 5.0 AS discount,
       nullif(l_linenumber - 2, 0) AS available_count,
       l_partkey % 7 - 1 AS preorder_count
FROM lineitem
"""


def _ratio(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE) / CAST(count(*) AS DOUBLE)"


def _profile_sql() -> str:
    rows = ["SELECT 'Dataset' AS entity, '*' AS instance, 'Size' AS name, "
            "CAST(count(*) AS DOUBLE) AS value FROM p"]
    for c in PRODUCT_COLUMNS:
        rows.append(f"SELECT 'Column', '{c}', 'Completeness', {_ratio(f'count({c})')} FROM p")
    rows.append("SELECT 'Column', 'id', 'Uniqueness', "
                "CAST(sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) AS DOUBLE) / CAST(sum(n) AS DOUBLE) "
                "FROM (SELECT id, count(*) AS n FROM p GROUP BY id)")
    for name, pred in COMPLIANCE.items():
        rows.append(f"SELECT 'Column', '{name}', 'Compliance', "
                    f"{_ratio(f'sum(CASE WHEN {pred} THEN 1 ELSE 0 END)')} FROM p")
    return f"WITH p AS ({PRODUCTS_SQL})\n" + "\nUNION ALL\n".join(rows)


@query("dq_profile", sql=_profile_sql())
def dq_profile(spark, sf_dir):
    return quality.profile(products(spark, sf_dir), completeness=PRODUCT_COLUMNS,
                           unique=[["id"]], compliance=COMPLIANCE)


@query("dq_uniqueness", sql="""
SELECT 'Multicolumn' AS entity, 'l_orderkey,l_linenumber' AS instance, 'Uniqueness' AS name,
       CAST(sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS value
FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)
""")
def dq_uniqueness(spark, sf_dir):
    return quality.uniqueness(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


#: Made violations: orders and parts that are missing, a line that stands twice, lines without a part.
TABLE_SPECS = {
    "orders": schema_check.TableSpec({"o_orderkey": "bigint", "o_custkey": "int", "o_clerk": "string"}, ["o_orderkey"], {("o_custkey",): "customer"}),
    "customer": schema_check.TableSpec({"c_custkey": "bigint", "c_name": "string"}, ["c_custkey"]),
    "part": schema_check.TableSpec({"p_partkey": "bigint"}, ["p_partkey"]),
    "lineitem": schema_check.TableSpec({"l_orderkey": "bigint", "l_partkey": "bigint", "l_linenumber": "int"}, ["l_orderkey", "l_linenumber"],
                                       {("l_orderkey",): "orders", ("l_partkey",): "part"}),
}
_LINES_SQL = """SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 89 <> 0 THEN l_partkey END AS l_partkey FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey % 83 = 0 AND l_linenumber = 1"""


@query("schema_checks", sql=f"""
WITH o AS (SELECT * FROM orders WHERE o_orderkey % 97 <> 0), p AS (SELECT * FROM part WHERE p_partkey % 101 <> 0), l AS ({_LINES_SQL}),
m(entity, instance, name, value) AS (
  SELECT * FROM (VALUES ('Column', 'orders.o_orderkey', 'MissingColumn', 0), ('Column', 'orders.o_orderkey', 'WrongType', 0),
    ('Column', 'orders.o_custkey', 'MissingColumn', 0), ('Column', 'orders.o_custkey', 'WrongType', 1),
    ('Column', 'orders.o_clerk', 'MissingColumn', 1), ('Column', 'customer.c_custkey', 'MissingColumn', 0),
    ('Column', 'customer.c_custkey', 'WrongType', 0), ('Column', 'customer.c_name', 'MissingColumn', 0),
    ('Column', 'customer.c_name', 'WrongType', 0), ('Column', 'part.p_partkey', 'MissingColumn', 0),
    ('Column', 'part.p_partkey', 'WrongType', 0), ('Column', 'lineitem.l_orderkey', 'MissingColumn', 0),
    ('Column', 'lineitem.l_orderkey', 'WrongType', 0), ('Column', 'lineitem.l_partkey', 'MissingColumn', 0),
    ('Column', 'lineitem.l_partkey', 'WrongType', 0), ('Column', 'lineitem.l_linenumber', 'MissingColumn', 0),
    ('Column', 'lineitem.l_linenumber', 'WrongType', 0)) v
  UNION ALL SELECT 'Key', 'orders(o_orderkey)', 'Size', count(*) FROM o
  UNION ALL SELECT 'Key', 'orders(o_orderkey)', 'NullKey', count(*) FILTER (o_orderkey IS NULL) FROM o
  UNION ALL SELECT 'Key', 'orders(o_orderkey)', 'DuplicateKey', count(o_orderkey) - count(DISTINCT o_orderkey) FROM o
  UNION ALL SELECT 'Key', 'customer(c_custkey)', 'Size', count(*) FROM customer
  UNION ALL SELECT 'Key', 'customer(c_custkey)', 'NullKey', count(*) FILTER (c_custkey IS NULL) FROM customer
  UNION ALL SELECT 'Key', 'customer(c_custkey)', 'DuplicateKey', count(c_custkey) - count(DISTINCT c_custkey) FROM customer
  UNION ALL SELECT 'Key', 'part(p_partkey)', 'Size', count(*) FROM p
  UNION ALL SELECT 'Key', 'part(p_partkey)', 'NullKey', count(*) FILTER (p_partkey IS NULL) FROM p
  UNION ALL SELECT 'Key', 'part(p_partkey)', 'DuplicateKey', count(p_partkey) - count(DISTINCT p_partkey) FROM p
  UNION ALL SELECT 'Key', 'lineitem(l_orderkey,l_linenumber)', 'Size', count(*) FROM l
  UNION ALL SELECT 'Key', 'lineitem(l_orderkey,l_linenumber)', 'NullKey', count(*) FILTER (l_orderkey IS NULL OR l_linenumber IS NULL) FROM l
  UNION ALL SELECT 'Key', 'lineitem(l_orderkey,l_linenumber)', 'DuplicateKey', count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM l
  UNION ALL SELECT 'Reference', 'orders(o_custkey)->customer', 'NullReference', count(*) FILTER (o_custkey IS NULL) FROM o
  UNION ALL SELECT 'Reference', 'orders(o_custkey)->customer', 'Orphan', count(*) FROM o ANTI JOIN customer ON o_custkey = c_custkey WHERE o_custkey IS NOT NULL
  UNION ALL SELECT 'Reference', 'lineitem(l_orderkey)->orders', 'NullReference', count(*) FILTER (l_orderkey IS NULL) FROM l
  UNION ALL SELECT 'Reference', 'lineitem(l_orderkey)->orders', 'Orphan', count(*) FROM l ANTI JOIN o ON l_orderkey = o_orderkey WHERE l_orderkey IS NOT NULL
  UNION ALL SELECT 'Reference', 'lineitem(l_partkey)->part', 'NullReference', count(*) FILTER (l_partkey IS NULL) FROM l
  UNION ALL SELECT 'Reference', 'lineitem(l_partkey)->part', 'Orphan', count(*) FROM l ANTI JOIN p ON l_partkey = p_partkey WHERE l_partkey IS NOT NULL)
SELECT entity, instance, name, value::DOUBLE AS value FROM m
""")
def schema_checks(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    holes = li.withColumn("l_partkey", F.when(F.col("l_orderkey") % 89 != 0, F.col("l_partkey")))
    again = li.where("l_orderkey % 83 = 0 AND l_linenumber = 1")
    tables = {"orders": table(spark, sf_dir, "orders").where("o_orderkey % 97 <> 0"), "customer": table(spark, sf_dir, "customer"),
              "part": table(spark, sf_dir, "part").where("p_partkey % 101 <> 0"), "lineitem": holes.unionByName(again)}
    return schema_check.check_tables(tables, TABLE_SPECS)
