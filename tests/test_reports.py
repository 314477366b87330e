import math

import numpy as np
from pyspark.sql import functions as F

from sparkdesk.functions.stats import exact_avg, safe_corr
from sparkdesk.operators import reports
from tests.conftest import rows

FLIGHTS = "TAIL_NUMBER string, AIRLINE string, ORIGIN_AIRPORT string, DESTINATION_AIRPORT string, " \
          "DEPARTURE_DELAY double, DAY_OF_WEEK int, AIR_TIME double, DISTANCE double, " \
          "DIVERTED int, CANCELLED int, CANCELLATION_REASON string"


def flights(spark):
    data = [
        ("N1", "AA", "JFK", "LAX", 1000.0, 1, 300.0, 2475.0, 0, 0, None),
        ("N1", "AA", "JFK", "LAX", 999.0, 2, None, 2475.0, 0, 1, "A"),
        ("N2", "AA", "JFK", "JFK", 5.0, 3, 10.0, 0.0, 1, 0, None),
        ("N2", "ZZ", "SFO", "LAX", None, 4, 60.0, 337.0, None, None, "B"),
        ("N3", "UA", "SFO", None, 1500.0, 5, 70.0, 337.0, 0, 1, "E"),
        (None, "UA", None, "LAX", 20.0, 5, None, None, 0, 0, None),
        ("N4", "UA", "ORD", "LAX", None, 6, None, None, 0, 0, None),
        ("N4", "UA", "ORD", "LAX", None, 6, None, None, 0, 0, "D"),
    ]
    return spark.createDataFrame(data, FLIGHTS)


def test_top_k_drops_null_keys_and_breaks_ties_by_key(spark):
    out = reports.top_k_by_count(flights(spark), "TAIL_NUMBER", k=3).collect()
    assert [(r.TAIL_NUMBER, r["count"]) for r in out] == [("N1", 2), ("N2", 2), ("N4", 2)]


def test_top_k_matches_python_stable_sort(spark):
    rng = np.random.default_rng(1)
    keys = [f"k{int(x)}" for x in rng.integers(0, 40, 500)]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    counts = {}
    for k in keys:
        counts[k] = counts.get(k, 0) + 1
    expected = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:7]
    got = [(r.k, r["count"]) for r in reports.top_k_by_count(df, "k", k=7).collect()]
    assert got == expected


def test_route_stats_keeps_null_group(spark):
    out = reports.route_stats(flights(spark), ["ORIGIN_AIRPORT", "DESTINATION_AIRPORT"],
                              counted="TAIL_NUMBER", measure="AIR_TIME", k=10, mean_alias="avg_air_time")
    got = {(r.ORIGIN_AIRPORT, r.DESTINATION_AIRPORT): (r.tail_count, r.avg_air_time) for r in out.collect()}
    assert got[(None, "LAX")] == (0, None)          # NULL origin is a group; NULL tail not counted
    assert got[("ORD", "LAX")] == (2, None)         # all-NULL mean is NULL
    assert got[("JFK", "LAX")] == (2, 300.0)


def test_having_boundary_and_constant_group(spark):
    out = reports.having_stats(flights(spark), "ORIGIN_AIRPORT", "DEPARTURE_DELAY", "DAY_OF_WEEK",
                               1000.0, prefix="delay")
    got = {r.ORIGIN_AIRPORT: r for r in out.collect()}
    assert set(got) == {"JFK", "SFO"}               # exactly 1000 kept; 999-only groups and all-NULL dropped
    assert got["SFO"].corr_delay_DAY_OF_WEEK is None  # one usable pair -> undefined, not an error
    x, y = [1000.0, 999.0, 5.0], [1, 2, 3]
    assert math.isclose(got["JFK"].corr_delay_DAY_OF_WEEK, np.corrcoef(x, y)[0, 1], rel_tol=1e-12)


def test_safe_corr_constant_group_is_null(spark):
    df = spark.createDataFrame([(1, 1.0, 3.0), (1, 2.0, 3.0), (2, 1.0, None), (2, 2.0, 5.0)], "g int, x double, y double")
    got = dict(rows(df.groupBy("g").agg(safe_corr("x", "y").alias("c")), "g", "c"))
    assert got == {1: None, 2: None}


def test_exact_avg_is_order_independent(spark):
    vals = [0.1] * 7 + [0.2] * 3 + [None]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    a = df.repartition(3).agg(exact_avg("v").alias("a")).first().a
    b = df.coalesce(1).agg(exact_avg("v").alias("a")).first().a
    assert a == b == 1.3 / 10


def test_role_join_two_roles(spark):
    airports = spark.createDataFrame([("JFK", "Kennedy", "US"), ("LAX", "Los Angeles", "US")],
                                     "IATA_CODE string, AIRPORT string, COUNTRY string")
    out = reports.role_join(flights(spark), airports, "IATA_CODE",
                            {"ORIGIN": "ORIGIN_AIRPORT", "DESTINATION": "DESTINATION_AIRPORT"},
                            ["AIRPORT", "COUNTRY"])
    got = rows(out, "ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "ORIGIN_COUNTRY")
    assert got == [("JFK", "JFK", "US"), ("JFK", "LAX", "US"), ("JFK", "LAX", "US")]  # unmatched codes drop
    assert set(out.columns) >= {"ORIGIN_AIRPORT", "ORIGIN_COUNTRY", "DESTINATION_AIRPORT"}


def _flags():
    return {"correct_count": F.col("DIVERTED").eqNullSafe(0) & F.col("CANCELLED").eqNullSafe(0),
            "diverted_count": F.col("DIVERTED").eqNullSafe(1),
            "airline_issue_count": F.col("CANCELLATION_REASON").eqNullSafe("A")}


def test_conditional_counts_pre_aggregated_equals_join_then_group(spark):
    # duplicated airline code 'UA' fans out, 'ZZ' has no airline
    airlines = spark.createDataFrame([("AA", "American"), ("UA", "United"), ("UA", "United 2")],
                                     "IATA_CODE string, AIRLINE string")
    f = flights(spark)
    pre = reports.conditional_counts_via_dim(f, "AIRLINE", airlines, "IATA_CODE", "AIRLINE", _flags(),
                                             means={"avg_distance": "DISTANCE"}, mean_scale=2)
    plain = (f.withColumnRenamed("AIRLINE", "CODE").join(airlines, F.col("CODE") == airlines.IATA_CODE)
              .transform(lambda d: reports.conditional_counts(d, "AIRLINE", _flags(), {"avg_distance": "DISTANCE"})))
    assert rows(pre, *plain.columns) == rows(plain)
