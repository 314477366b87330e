"""Registry consistency, plan shapes and the DuckDB oracle on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from sparkdesk.sources.tables import DRIVER_TABLES
from tests.conftest import SF_SMALL
from tools.check_oracle import norm

ORACLE = E.oracle_sql()
QUERIES = E.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_registry_consistent():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 45


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "correct_count" in df.columns


def test_pushdown_and_pruning(spark):
    p = plan(QUERIES["scan_parquet"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in p
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan(QUERIES["day_filter"](spark, SF_SMALL))
    # a profile without a row by the time stays, so the cut is inside the aggregate: one scan,
    # one shuffle, no window
    p = plan(QUERIES["anchor_asof"](spark, SF_SMALL))
    assert (p.count("FileScan"), p.count("Exchange"), p.count("Window")) == (1, 1, 0)


def test_pit_is_one_keyed_scan(spark):
    # carry-forward and next point share one (key, chunk) window and one chunk-level window
    assert plan(QUERIES["pit_build"](spark, SF_SMALL)).count("Window [") == 2


def test_null_content_payments_are_split_off(spark):
    # keyed payments join the content; payments without content are a separate branch
    assert "Union" in plan(QUERIES["mart_payment"](spark, SF_SMALL))


def test_top_k_and_broadcast(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["topk_count"](spark, SF_SMALL))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "BroadcastHashJoin" in plan(QUERIES["cond_counts"](spark, SF_SMALL))
        assert plan(QUERIES["role_join"](spark, SF_SMALL)).count("BroadcastHashJoin") >= 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_partition_pruning(spark):
    assert "PartitionFilters: [isnotnull(dt" in plan(QUERIES["part_scan"](spark, SF_SMALL))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    cols = df.columns
    cur = duck.execute(ORACLE[key])
    dcols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(dcols)
    srows = df.collect()
    drows = cur.fetchall()
    a = sorted(tuple(norm(r[c]) for c in sorted(cols)) for r in srows)
    b = sorted(tuple(norm(r[dcols.index(c)]) for c in sorted(cols)) for r in drows)
    assert a == b
