import datetime as dt
import os

import pytest
from pyspark.errors import AnalysisException

from sparkdesk.sinks import writers as W
from sparkdesk.sources import files
from tests.conftest import rows

SCHEMA = "id int, ts timestamp_ntz, v string"
D = dt.datetime


def trips(spark):
    return spark.createDataFrame([
        (1, D(2020, 1, 1, 0, 0, 0), "midnight"), (2, D(2020, 1, 1, 23, 59, 59), "late"),
        (3, D(2020, 1, 2, 0, 0, 0), "next day"), (4, D(2019, 12, 31, 23, 59, 59), "before")], SCHEMA)


def test_overwrite_new_append(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t")
    df = trips(spark)
    W.save_new(df, p)
    with pytest.raises(AnalysisException):
        W.save_new(df, p)
    W.append(df, p)
    assert spark.read.parquet(p).count() == 8
    W.save_overwrite(df, p)
    assert spark.read.parquet(p).count() == 4


def test_day_partition_load(spark, tmp_dir):
    p = os.path.join(tmp_dir, "trip_part")
    df = trips(spark)
    for _ in range(2):
        W.write_day_partition(df, p, "2020-01-01", "ts", replace=True)
    W.write_day_partition(df, p, "2020-01-02", "ts", replace=True)
    assert rows(files.read_day(spark, p, "2020-01-01"), "id") == [(1,), (2,)]   # both day edges, once
    assert spark.read.parquet(p).count() == 3                                   # other day kept
    W.write_day_partition(df, p, "2020-01-01", "ts", replace=False)             # plain INSERT duplicates
    assert files.read_day(spark, p, "2020-01-01").count() == 4


def test_staged_full_refresh(spark, tmp_dir):
    tgt, stg = os.path.join(tmp_dir, "target"), os.path.join(tmp_dir, "stage")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    assert W.staged_full_refresh(first, tgt, stg, ["id"]).count() == 2
    second = spark.createDataFrame([(3, "c")], "id int, name string")
    assert rows(W.staged_full_refresh(second, tgt, stg, ["id"])) == [(3, "c")]
    dup = spark.createDataFrame([(4, "d"), (4, "e")], "id int, name string")
    with pytest.raises(ValueError):
        W.staged_full_refresh(dup, tgt, stg, ["id"])
    assert rows(spark.read.parquet(tgt)) == [(3, "c")]                         # target untouched


def test_partitioned_orc_prunes(spark, tmp_dir):
    from pyspark.sql import functions as F
    p = os.path.join(tmp_dir, "orc")
    W.write_partitioned(trips(spark).withColumn("dt", F.to_date("ts")), p, "dt", fmt="orc")
    df = files.read_orc(spark, p).where(F.col("dt") == F.lit("2020-01-01").cast("date"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and df.count() == 2


def test_csv_typed_and_prefix(spark, tmp_dir):
    p = os.path.join(tmp_dir, "csv")
    with open(os.path.join(tmp_dir, "x.csv"), "w"):
        pass
    os.makedirs(p)
    with open(os.path.join(p, "part.csv"), "w") as f:
        f.write("vendor_id,pickup,n,extra1,extra2\n1,2020-01-01 10:00:00,3,x,y\n2,not a time,x,z,w\n")
    typed = files.read_csv_typed(spark, p, "vendor_id string, pickup timestamp, n int")
    got = rows(typed)
    assert got[0][0] == "1" and got[0][2] == 3
    assert got[1][1] is None and got[1][2] is None                              # unparsable -> NULL
    prefix = files.read_csv_prefix(spark, p, ["vendor_id", "pickup", "n"])
    assert rows(prefix) == [("1", "2020-01-01 10:00:00", "3"), ("2", "not a time", "x")]


def test_write_lines(spark, tmp_dir):
    df = spark.createDataFrame([("2020-01", "Cash", 1.5), ("2020-02", None, 2.0)], "m string, p string, a double")
    W.write_lines(df, tmp_dir + "/out", ["m", "p", "a"])
    assert sorted(r.value for r in spark.read.text(tmp_dir + "/out").collect()) == ["2020-01,Cash,1.5", "2020-02,,2.0"]


def test_partitioned_write_spreads_a_hot_day_over_tasks(spark, tmp_dir):
    from pyspark.sql import functions as F
    p = os.path.join(tmp_dir, "hot")
    hot = spark.range(0, 3000).select(F.lit("2020-01-01").cast("date").alias("dt"), F.col("id"))
    cold = spark.range(3000, 3010).select(F.lit("2020-01-02").cast("date").alias("dt"), F.col("id"))
    W.write_partitioned(hot.unionByName(cold), p, "dt", rows_per_task=1000)
    hot_files = [f for f in os.listdir(os.path.join(p, "dt=2020-01-01")) if f.endswith(".parquet")]
    cold_files = [f for f in os.listdir(os.path.join(p, "dt=2020-01-02")) if f.endswith(".parquet")]
    assert len(hot_files) >= 2 and len(cold_files) == 1
    back = spark.read.parquet(p)
    assert back.count() == 3010 and back.select("id").distinct().count() == 3010
