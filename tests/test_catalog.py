import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from sparkdesk.functions.text import day_range, iso_weekday, iso_weekday_of
from sparkdesk.operators import pages as P
from sparkdesk.sinks import catalog as C
from sparkdesk.sources.files import read_pages

LOC_DDL = "id int, name string, type string, dimension string, residents_cnt int"


def test_dimension_literals_and_reports_in_sql(spark, tmp_dir):
    C.create_database(spark, "taxi_t", os.path.join(tmp_dir, "taxi"))
    try:
        C.create_table_if_absent(spark, "payment", "id int, name string", fmt="orc")
        spark.sql("WITH t AS (SELECT 1, 'Credit card' UNION ALL SELECT 2, 'Cash' UNION ALL SELECT 3, 'No charge') "
                  "INSERT INTO payment SELECT * FROM t")
        C.create_table_if_absent(spark, "trip", "vendor_id string, pickup timestamp_ntz, payment_type int, "
                                 "total_amount double", fmt="orc")
        trips = spark.createDataFrame([
            ("1", dt.datetime(2021, 1, 19, 0, 0), 1, 10.0), ("1", dt.datetime(2021, 1, 19, 8, 0), 1, 5.0),
            ("2", dt.datetime(2021, 1, 19, 0, 0), 2, 7.5), ("", dt.datetime(2021, 1, 20, 0, 0), 9, 1.0)],
            "vendor_id string, pickup timestamp_ntz, payment_type int, total_amount double")
        C.insert(trips, "trip")
        # comma join + timestamp = date literal: midnight rows only
        got = spark.sql("SELECT p.name, sum(total_amount) AS s FROM trip t, payment p "
                        "WHERE p.id = t.payment_type AND pickup = '2021-01-19' GROUP BY p.name ORDER BY 2").collect()
        assert [(r.name, r.s) for r in got] == [("Cash", 7.5), ("Credit card", 10.0)]
        # the whole day through the half-open range
        day = spark.table("trip").where(day_range("pickup", "2021-01-19"))
        assert day.count() == 3
        got = spark.sql("SELECT count(1) AS n, p.name FROM trip t JOIN payment p ON (t.payment_type = p.id) "
                        "GROUP BY p.name ORDER BY 1 DESC").collect()
        assert [(r.n, r.name) for r in got] == [(2, "Credit card"), (1, "Cash")]
    finally:
        spark.sql("DROP DATABASE IF EXISTS taxi_t CASCADE")
        spark.catalog.setCurrentDatabase("default")


def test_extract_stage_publish_chain(spark, tmp_dir):
    land = os.path.join(tmp_dir, "land")
    os.makedirs(land)
    locs = [{"id": i, "name": f"loc {i}", "type": "t", "dimension": "d", "residents": ["r"] * (i % 4)}
            for i in range(1, 9)]
    for n in (1, 2):
        with open(os.path.join(land, f"p{n}.json"), "w") as f:
            f.write(json.dumps({"page": n, "info": {"count": 4, "pages": 2}, "results": locs[(n - 1) * 4:n * 4]}))
    pages = read_pages(spark, land)
    P.assert_complete(pages)
    top = P.top_locations(P.explode_pages(pages), 3).select(
        F.col("id").cast("int"), "name", "type", "dimension", "residents_cnt")
    C.prepare_target(spark, "ram_location", "ram_location_stg", LOC_DDL)
    try:
        C.insert(top, "ram_location_stg")
        out = C.publish_from_stage(spark, "ram_location_stg", "ram_location", ["id"])
        assert sorted(r.id for r in out.collect()) == [2, 3, 7]
        # a second run replaces the rows (no duplicates), the stage is emptied first
        C.prepare_target(spark, "ram_location", "ram_location_stg", LOC_DDL)
        C.insert(top, "ram_location_stg")
        assert C.publish_from_stage(spark, "ram_location_stg", "ram_location", ["id"]).count() == 3
        C.insert(top.limit(1), "ram_location_stg")
        with pytest.raises(ValueError):
            C.publish_from_stage(spark, "ram_location_stg", "ram_location", ["id"])
        assert spark.table("ram_location").count() == 3
    finally:
        spark.sql("DROP TABLE IF EXISTS ram_location")
        spark.sql("DROP TABLE IF EXISTS ram_location_stg")


def test_iso_weekday_all_days(spark):
    days = [dt.date(2024, 1, d) for d in range(15, 22)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r.w for r in df.select(iso_weekday("d").alias("w")).collect()]
    assert got == [d.isoweekday() for d in days] == [iso_weekday_of(d.isoformat()) for d in days]
