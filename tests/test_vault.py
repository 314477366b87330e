import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkdesk.functions.keys import hash_key
from sparkdesk.operators import anchor, vault
from sparkdesk.operators.keyed_scan import Chunks, carry_forward, keyed_scan, with_neighbour
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)
HIST = "k string, ts timestamp_ntz, id int, v string"


def ts(hours):
    return T0 + dt.timedelta(hours=hours)


def test_hub_keys_with_null_parts_do_not_collide(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a", "a"), (" a ", "A")], "mail string, phone string")
    hk = [r.h for r in df.select(hash_key("mail", "phone").alias("h")).collect()]
    assert len(set(hk[:3])) == 3
    assert hk[2] == hk[3]                            # trimmed, case-folded business key


def test_hub_load_twice_is_once(spark):
    staged = spark.createDataFrame([("x",), ("y",), ("x",)], "bk string")
    first = vault.hub_rows(staged, ["bk"], "hk", None, "2024-01-01 00:00:00", "src")
    assert first.count() == 2
    again = vault.hub_rows(staged, ["bk"], "hk", first, "2024-01-02 00:00:00", "src")
    assert again.count() == 0
    more = spark.createDataFrame([("x",), ("z",)], "bk string")
    new = vault.hub_rows(more, ["bk"], "hk", first, "2024-01-02 00:00:00", "src").collect()
    assert [r.bk for r in new] == ["z"] and new[0].source_id == "src"


def test_link_rows_anti_join(spark):
    staged = spark.createDataFrame([(1, 10), (1, 10), (2, 10)], "a int, b int")
    parts = {"a_hk": ["a"], "b_hk": ["b"]}
    first = vault.link_rows(staged, parts, "ab_hk", None, "2024-01-01 00:00:00", "s")
    assert first.count() == 2
    assert vault.link_rows(staged, parts, "ab_hk", first, "2024-01-02 00:00:00", "s").count() == 0


def test_satellite_change_rules(spark):
    data = [("p", ts(0), 1, "a"), ("p", ts(1), 2, "a"),      # repeat: dropped
            ("p", ts(2), 3, None), ("p", ts(3), 4, None),    # value -> NULL kept, NULL -> NULL dropped
            ("p", ts(4), 5, "b"), ("p", ts(4), 6, "c"),      # two changes at one load time (tie by id)
            ("q", ts(0), 7, None)]                           # first row kept even if NULL
    df = spark.createDataFrame(data, HIST)
    for chunk in (None, F.to_date("ts")):
        out = vault.satellite_changes(df, "k", "ts", ["v"], tie=["id"], chunk=chunk)
        assert rows(out, "id") == [(1,), (3,), (5,), (6,), (7,)]


def brute_prev_next(data):
    by = {}
    for r in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        by.setdefault(r[0], []).append(r)
    out = {}
    for k, rs in by.items():
        for i, r in enumerate(rs):
            out[r[2]] = (rs[i - 1][3] if i > 0 else "<none>", rs[i + 1][3] if i + 1 < len(rs) else "<none>")
    return out


hist_rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 120),
                               st.sampled_from([None, "x", "y"])), min_size=1, max_size=40)


@settings(max_examples=15, deadline=None)
@given(hist_rows)
def test_chunked_neighbours_equal_single_window(spark, raw):
    data = [(k, ts(h), i, v) for i, (k, h, v) in enumerate(raw)]
    df = spark.createDataFrame(data, HIST)
    expected = brute_prev_next(data)
    for chunk in (None, F.to_date("ts"), F.date_trunc("hour", "ts")):
        d = with_neighbour(df, "k", ["ts", "id"], ["v"], "p", chunk, "prev")
        d = with_neighbour(d, "k", ["ts", "id"], ["v"], "n", chunk, "next")
        got = {r.id: ("<none>" if r.p is None else r.p.v, "<none>" if r.n is None else r.n.v)
               for r in d.collect()}
        assert got == expected


@settings(max_examples=15, deadline=None)
@given(hist_rows)
def test_chunked_carry_forward_equals_brute_force(spark, raw):
    data = [(k, ts(h), i, v) for i, (k, h, v) in enumerate(raw)]
    df = spark.createDataFrame(data, HIST)
    expected, last = {}, {}
    for r in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        if r[3] is not None:
            last[r[0]] = r[3]
        expected[r[2]] = last.get(r[0])
    for chunk in (None, F.to_date("ts")):
        got = {r.id: r.v for r in carry_forward(df, "k", ["ts", "id"], ["v"], chunk).collect()}
        assert got == expected


@settings(max_examples=15, deadline=None)
@given(hist_rows)
def test_one_keyed_scan_answers_prev_next_and_fill(spark, raw):
    data = [(k, ts(h), i, v) for i, (k, h, v) in enumerate(raw)]
    df = spark.createDataFrame(data, HIST).withColumn("f", F.col("v"))
    neighbours = brute_prev_next(data)
    filled, last = {}, {}
    for r in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        if r[3] is not None:
            last[r[0]] = r[3]
        filled[r[2]] = last.get(r[0])
    hot_keys_by_hour = Chunks(F.date_trunc("day", "ts"), F.date_trunc("hour", "ts"), hot_rows=3)
    for chunk in (None, F.to_date("ts"), F.date_trunc("hour", "ts"), hot_keys_by_hour):
        d = keyed_scan(df, "k", ["ts", "id"], prev={"p": ["v"]}, next={"n": ["v", "ts"]},
                       fill=["f"], chunk=chunk)
        assert d.columns == ["k", "ts", "id", "v", "f", "p", "n"]
        got = {r.id: ("<none>" if r.p is None else r.p.v, "<none>" if r.n is None else r.n.v)
               for r in d.collect()}
        assert got == neighbours
        assert {r.id: r.f for r in d.collect()} == filled


def test_validity_intervals(spark):
    df = spark.createDataFrame([("p", ts(0), 1, "a"), ("p", ts(30), 2, "b"), ("q", ts(5), 3, "c")], HIST)
    out = vault.validity_intervals(df, "k", "ts", chunk=F.to_date("ts"))
    got = rows(out, "id", "valid_from_dttm", "valid_to_dttm")
    assert got == [(1, ts(0), ts(30)), (2, ts(30), None), (3, ts(5), None)]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 100)), min_size=1, max_size=20),
       st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 100)), min_size=1, max_size=20))
def test_pit_equals_brute_force_as_of(spark, sat_a, sat_b):
    a = spark.createDataFrame(sorted({(k, ts(h)) for k, h in sat_a}), "hk string, load_dttm timestamp_ntz")
    b = spark.createDataFrame(sorted({(k, ts(h)) for k, h in sat_b}), "hk string, load_dttm timestamp_ntz")
    pit = vault.pit_table("hk", {"sa": a, "sb": b},
                          chunk_of=lambda c: Chunks(F.date_trunc("day", c), F.date_trunc("hour", c), 4))
    got = rows(pit, "hk", "pit_dttm", "sa_load_dttm", "sb_load_dttm", "valid_to_dttm")
    pts = sorted({(k, ts(h)) for k, h in sat_a + sat_b})
    la = [(k, ts(h)) for k, h in sat_a]
    lb = [(k, ts(h)) for k, h in sat_b]
    exp = []
    for k, t in pts:
        asof_a = max((x for kk, x in la if kk == k and x <= t), default=None)
        asof_b = max((x for kk, x in lb if kk == k and x <= t), default=None)
        nxt = min((x for kk, x in pts if kk == k and x > t), default=None)
        exp.append((k, t, asof_a, asof_b, nxt))
    assert got == sorted(exp, key=lambda r: (r[0], r[1]))


def test_anchor_latest_and_as_of(spark):
    data = [("p", ts(0), 1, "a"), ("p", ts(10), 2, "b"), ("q", ts(20), 3, "c")]
    df = spark.createDataFrame(data, HIST)
    tabs = anchor.split_attributes(df, "k", "ts", ["v"], tie=["id"], chunk=F.to_date("ts"))
    assert rows(anchor.latest_view(df, "k", tabs, tie=["id"])) == [("p", "b"), ("q", "c")]
    as_of = (T0 + dt.timedelta(hours=5)).strftime("%Y-%m-%d %H:%M:%S")
    assert rows(anchor.latest_view(df, "k", tabs, tie=["id"], as_of=as_of)) == [("p", "a"), ("q", None)]


def test_bridge_left_joins_keep_missing_levels(spark):
    base = spark.createDataFrame([(1, 10), (2, 99)], "code int, country_id int")
    country = spark.createDataFrame([(10, "NL", 100)], "cid int, country string, continent_id int")
    cont = spark.createDataFrame([(100, "Europe")], "ctid int, continent string")
    out = vault.bridge(base, [(country, "country_id", "cid"), (cont, "continent_id", "ctid")])
    assert rows(out, "code", "country", "continent") == [(1, "NL", "Europe"), (2, None, None)]


def test_hot_key_gets_fine_chunks_and_sparse_key_keeps_one(spark):
    data = [("hot", ts(h), i, "x") for i, h in enumerate(range(0, 10))] + \
           [("cold", ts(1), 100, "y"), ("cold", ts(7), 101, "z"), (None, ts(2), 102, "n")]
    df = spark.createDataFrame(data, HIST)
    chunks = Chunks(F.date_trunc("day", "ts"), F.date_trunc("hour", "ts"), hot_rows=5)
    got = {r.k: r.n for r in chunks.assign(df, ["k"]).groupBy("k")
           .agg(F.count_distinct("__chunk").alias("n")).collect()}
    assert got == {"hot": 10, "cold": 1, None: 1}
    # the hot set can come from a wider frame: a subset of its rows still counts as hot
    sub = df.where(F.col("ts") < F.lit(ts(3)))
    got = {r.k: r.n for r in chunks.counted_on(df).assign(sub, ["k"]).groupBy("k")
           .agg(F.count_distinct("__chunk").alias("n")).collect()}
    assert got["hot"] == 3
