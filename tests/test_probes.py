"""Inputs that the driver tables lack: odd numbers, colliding keys, ties, NULL keys, deep parents."""

import math

import pytest
from pyspark.sql import functions as F

from sparkdesk import session
from sparkdesk.functions.keys import hash_key
from sparkdesk.functions.stats import exact_avg, exact_sum
from sparkdesk.operators import anchor, learning, lines, marts, vault
from tests.conftest import rows
from sparkdesk.operators.keyed_scan import Chunks, keyed_scan
from sparkdesk.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("values, total, mean", [
    ([1.0, 2.345], 3.345, 1.6725), ([1.0, float("nan")], 1.0, 1.0), ([1.0, float("inf"), None], 1.0, 1.0),
    ([1e20, 2.0], 2.0, 2.0), ([-1e300, 4.5], 4.5, 4.5), ([float("nan")], None, None), ([0.1] * 10, 1.0, 0.1)])
def test_sum_and_mean_leave_out_the_same_values(spark, values, total, mean):
    r = spark.createDataFrame([(v,) for v in values], "v double").agg(exact_sum("v").alias("s"), exact_avg("v").alias("a")).first()
    assert (r.s, r.a) == (total, mean)


def test_tip_report_survives_odd_tips(spark):
    text = "1,2024-05-01 10:00:00" + "," * 7 + ",{code},,,,{tip},,,,"
    tips = ["1.0", "2.345", "nan", "1e20", "1e300", "abc", ""]
    raw = spark.createDataFrame([(text.format(code=1, tip=t),) for t in tips], "value string")
    parsed = lines.parse_trip_lines(raw, "2024")
    got = lines.avg_tip_by_month_label(parsed, lines.payment_dim(spark), mean_fn=exact_avg).first()
    assert got.avg_tip == 1.6725


def test_rmse_of_small_errors_and_null_rows(spark):
    df = spark.createDataFrame([(1.0, 1.004), (2.0, 2.004), (None, 3.0), (4.0, None)], "y double, prediction double")
    assert math.isclose(learning.rmse(df, "y").first().value, 0.004)
    assert learning.rmse(df.limit(0), "y").first().value is None


def test_training_rows_lie_alike_whatever_the_input_partitions(spark):
    df = spark.range(500).select("id", (F.col("id") % 7).alias("x"))
    laid = [learning.spread(d, 5).select(F.spark_partition_id().alias("p"), "id").collect()
            for d in (df.coalesce(1), df.repartition(3), df.repartition(9, "x"))]
    assert laid[0] == laid[1] == laid[2] and len({r.p for r in laid[0]}) == 5


def test_keys_do_not_collide(spark):
    parts = [("a|b", "c"), ("a", "b|c"), (None, "a"), ("a", None), ("\\N", "a"), ("N", "a"), ("", "a"), ("1:a", ""), ("a1:b", "")]
    df = spark.createDataFrame(parts, "x string, y string")
    assert df.select(hash_key("x", "y").alias("h")).distinct().count() == len(parts)


def test_spellings_of_a_key_are_one_hub_and_one_link_row(spark):
    df = spark.createDataFrame([("Ann", 1), (" ann", 1), ("ANN", 1), ("Bo", 1)], "name string, n int")
    hub = vault.hub_rows(df, ["name"], "hk", None, "2024-01-01", "t")
    assert rows(hub, "name") == [(" ann",), ("Bo",)]
    link = vault.link_rows(df, {"a_hk": ["name"], "b_hk": ["n"]}, "l_hk", None, "2024-01-01", "t")
    assert link.count() == 2 and link.select("l_hk").distinct().count() == 2


@pytest.mark.parametrize("chunked", [lambda: None, lambda: F.to_date("ts"),
                                     lambda: Chunks(F.date_trunc("day", "ts"), F.date_trunc("minute", "ts"), 1)])
def test_null_keys_change_alike_in_chunks(spark, chunked):
    chunk = chunked()
    df = spark.createDataFrame([(k, f"2024-01-0{d} 10:00:0{d}", d, "v") for k in (None, "p") for d in (1, 2, 3)],
                               "k string, t string, id int, v string").withColumn("ts", F.to_timestamp("t"))
    assert vault.satellite_changes(df, "k", "ts", ["v"], tie=["id"], chunk=chunk).count() == 2
    scanned = keyed_scan(df, "k", ["ts", "id"], prev={"b": ["id"]}, next={"n": ["id"]}, chunk=chunk)
    got = {(r.k, r.id, r.b.id if r.b else None, r.n.id if r.n else None) for r in scanned.collect()}
    assert got == {(k, d, d - 1 or None, d + 1 if d < 3 else None) for k in (None, "p") for d in (1, 2, 3)}


def test_latest_value_of_tied_load_times(spark):
    data = [("k", "2024-01-01 00:00:00", i, v) for i, v in enumerate("ABC")] + [(None, "2024-01-02 00:00:00", 9, None)]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "k string, t string, id int, v string").withColumn("ts", F.col("t").cast("timestamp_ntz"))
        tabs = anchor.split_attributes(df, "k", "ts", ["v"], tie=["id"])
        wide = anchor.latest_view(df, "k", tabs, tie=["id"])
        assert {(r.k, r.v) for r in wide.collect()} == {("k", "C"), (None, None)}
        assert {(r.k, r.v) for r in anchor.latest_of(df, "k", "ts", ["v"], tie=["id"]).collect()} == {("k", "C"), (None, None)}
        early = anchor.latest_of(df, "k", "ts", ["v"], tie=["id"], as_of="2023-01-01 00:00:00")
        assert {(r.k, r.v) for r in early.collect()} == {("k", None), (None, None)}


def test_deep_hierarchy_reaches_its_root_and_cycles_are_refused(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 3), (5, 99)], "id int, parent int")
    got = rows(marts.resolve_hierarchy(df, "id", "parent"), "id", "root_id", "level")
    assert got == [(1, 1, 0), (2, 1, 1), (3, 1, 2), (4, 1, 3), (5, 99, 1)]
    loop = spark.createDataFrame([(1, 2), (2, 1)], "id int, parent int")
    with pytest.raises(ValueError):
        marts.resolve_hierarchy(loop, "id", "parent")


@pytest.mark.parametrize("key", ["payment_counts", "payment_totals"])
def test_payment_joins_never_shuffle_or_build_from_the_orders(spark, key):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = registry.all_queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BuildRight" in plan and "hashpartitioning(payment_type" not in plan


@pytest.mark.parametrize("key", ["anchor_latest", "anchor_asof"])
def test_views_take_one_scan_and_one_shuffle(spark, key):
    plan = registry.all_queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_every_event_keeps_its_good_line(spark):
    from sparkdesk.plans import analogues

    ev = spark.read.parquet(f"{SF}/events.parquet")
    got = analogues.trip_lines(spark, ev).count()
    assert got > 1 + ev.count()


def test_cluster_needs_a_shared_folder(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())


def test_scratch_paths_keep_the_scheme(spark):
    base = spark.sparkContext.getCheckpointDir()
    assert session.scratch_path(spark, "x").startswith(base.split(":")[0] + ":" if ":" in base else base)
