from sparkdesk.operators.joins import left_join_nulls_apart
from tests.conftest import rows


def test_equals_plain_left_join_with_null_keys(spark):
    fact = spark.createDataFrame(
        [(1, 10, "a"), (2, None, "b"), (3, 10, None), (4, 99, "c"), (5, None, None), (6, 20, "d")],
        "fid long, k long, k2 string")
    dim = spark.createDataFrame([(10, "a", "x"), (10, "a", "y"), (20, "d", "z"), (30, None, "w")],
                                "dk long, dk2 string, label string")
    got = left_join_nulls_apart(fact, dim, ["k", "k2"], ["dk", "dk2"])
    want = fact.join(dim, (fact.k == dim.dk) & (fact.k2 == dim.dk2), "left")
    assert got.columns == want.columns
    assert rows(got) == rows(want)
    one = left_join_nulls_apart(fact, dim, "k", "dk")
    assert rows(one) == rows(fact.join(dim, fact.k == dim.dk, "left"))


def test_null_key_rows_skip_the_join(spark):
    fact = spark.createDataFrame([(1, None), (2, 10)], "fid long, k long")
    dim = spark.createDataFrame([(10, "x")], "dk long, label string")
    plan = left_join_nulls_apart(fact, dim, "k", "dk")._jdf.queryExecution().optimizedPlan().toString()
    # the joined branch keeps only keyed rows; the other branch has no join
    assert "isnotnull(k" in plan and "Union" in plan
    assert rows(left_join_nulls_apart(fact, dim, "k", "dk")) == [(1, None, None, None), (2, 10, 10, "x")]
