"""Dense numbers, declared tables, the publish chain, line outcomes and inserts from a CTE."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from sparkdesk.functions.stats import left_out
from sparkdesk.operators import lines as L
from sparkdesk.operators.numbering import dense_numbers
from sparkdesk.operators.schema_check import TableSpec, check_tables
from sparkdesk.sinks import catalog, publish, writers
from tests.test_lines import EDGE_LINES, brute_force, taxi


@pytest.mark.parametrize("partitions", [1, 7])
def test_dense_numbers(spark, partitions):
    rng = random.Random(partitions)
    rows = [(rng.choice([None, *range(50)]), rng.choice("abc")) for _ in range(800)] + [(7, "z")] * 300
    df = spark.createDataFrame(rows, "k int, v string").repartition(partitions)
    got = dense_numbers(df, ["k", "v"], "n", start=1).orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 1101))
    assert [(r.k, r.v) for r in got] == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert dense_numbers(df.limit(0), ["k"]).collect() == []


def test_declared_tables(spark):
    parents = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (2, "d"), (None, "e")], "id bigint, name string")
    children = spark.createDataFrame([(1, 1, "x"), (2, 9, "y"), (2, 9, "y"), (3, None, "z")], "a bigint, parent bigint, b string")
    specs = {"p": TableSpec({"id": "bigint", "name": "int", "gone": "string"}, ["id"]),
             "c": TableSpec({"a": "bigint"}, ["a", "b"], {("parent",): "p", ("absent",): "p"})}
    got = {(r.instance, r.name): r.value for r in check_tables({"p": parents, "c": children}, specs).collect()}
    assert got == {("p.id", "MissingColumn"): 0, ("p.id", "WrongType"): 0, ("p.name", "MissingColumn"): 0, ("p.name", "WrongType"): 1,
                   ("p.gone", "MissingColumn"): 1, ("c.a", "MissingColumn"): 0, ("c.a", "WrongType"): 0,
                   ("p(id)", "Size"): 5, ("p(id)", "NullKey"): 1, ("p(id)", "DuplicateKey"): 2,
                   ("c(a,b)", "Size"): 4, ("c(a,b)", "NullKey"): 0, ("c(a,b)", "DuplicateKey"): 1,
                   ("c(parent)->p", "NullReference"): 1, ("c(parent)->p", "Orphan"): 2}
    empty = {r.value for r in check_tables({"p": parents.limit(0), "c": children.limit(0)}, specs).where("entity <> 'Column'").collect()}
    assert empty == {0.0}


def test_publish_never_shows_a_failed_or_partial_run(spark, tmp_dir):
    root = f"{tmp_dir}/table"
    make = lambda rows: lambda: spark.createDataFrame(rows, "id int, v string")
    read = lambda: sorted(map(tuple, publish.published(spark, root).collect()))
    with pytest.raises(LookupError):
        publish.published(spark, root)
    publish.run_daily(spark, root, "2024-01-01", make([(1, "a"), (2, "b")]), unique_keys=["id"])
    held = publish.published(spark, root)
    for bad in ([(1, "x"), (1, "y")], [(None, "x")], []):
        with pytest.raises(ValueError):
            publish.run_daily(spark, root, "2024-01-02", make(bad), unique_keys=["id"])
    with pytest.raises(Exception, match="midway"):
        publish.run_daily(spark, root, "2024-01-02", make([(5, "x")]), lambda df: df.withColumn("v", F.raise_error(F.lit("midway"))))
    assert read() == [(1, "a"), (2, "b")]
    for _ in range(2):
        publish.run_daily(spark, root, "2024-01-02", make([(3, "c")]), unique_keys=["id"])
        assert read() == [(3, "c")]
    # a reader that began before goes on with the version that it opened
    assert sorted(map(tuple, held.collect())) == [(1, "a"), (2, "b")]
    assert [(r.seq, r.ds) for r in publish.versions(spark, root).collect()] == [(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-02")]


def test_outcomes_add_up_to_the_lines_of_the_report(spark, tmp_dir):
    lines = [*EDGE_LINES, taxi(tip="nan"), taxi(tip="1e300"), taxi(tip="-inf")]
    src = spark.createDataFrame([(x,) for x in lines], "value string")
    report, outcomes = L.tip_report(src, L.payment_dim(spark), "2020")
    assert sorted(tuple(r) for r in report.collect()) == brute_force(EDGE_LINES)
    seen = {r.outcome: r.lines for r in outcomes.collect()}
    assert sum(seen.values()) == len(lines) and seen["tip_out_of_range"] == 3 and set(seen) <= set(L.OUTCOMES)
    assert seen == {r.outcome: r.lines for r in L.line_rejects(src, L.payment_dim(spark), "2020").collect()}


def test_result_lines_keep_their_order(spark, tmp_dir):
    df = spark.range(1000).repartition(9).orderBy(F.desc("id"))
    writers.write_lines(df, tmp_dir + "/l", ["id"])
    got = spark.read.text(tmp_dir + "/l").select(F.col("_metadata.file_name").alias("f"), F.monotonically_increasing_id().alias("i"), "value")
    assert [int(r.value) for r in got.orderBy("f", "i").collect()] == list(range(999, -1, -1))


def test_insert_from_a_cte(spark, tmp_dir):
    name = f"t_{uuid.uuid4().hex[:8]}"
    catalog.create_table_if_absent(spark, name, "id int, v string", location=f"{tmp_dir}/{name}")
    try:
        one = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
        two = spark.createDataFrame([(2, "c")], "id int, w string")
        for _ in range(2):
            catalog.insert_with(spark, name, {"one": one, "two": two}, "SELECT id, w FROM one JOIN two USING (id)")
        assert [tuple(r) for r in spark.table(name).collect()] == [(2, "c")] * 2
        with pytest.raises(Exception):
            catalog.insert_with(spark, name, {"one": one}, "SELECT nothing FROM one")
        assert not [t for t in spark.catalog.listTables() if t.isTemporary]
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_numbers_left_out_are_counted(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (1e20,), (2.0,)], "x double")
    assert df.agg(left_out("x").alias("n")).first().n == 2
