"""As-of joins, incremental satellites and links, bridges and deep hierarchies against plain versions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sparkdesk.operators import anchor, asof, satellite_log
from sparkdesk.operators.keyed_scan import Chunks, keyed_scan
from sparkdesk.operators.marts import resolve_hierarchy

T0 = dt.datetime(2024, 1, 1)


def at(hours):
    return None if hours is None else T0 + dt.timedelta(hours=hours)


def chunks(hot_rows):
    return lambda c: Chunks(F.date_trunc("day", c), F.date_trunc("hour", c), hot_rows)


@pytest.mark.parametrize("chunk_of", [None, chunks(10**6), chunks(5)], ids=["one", "days", "hot"])
def test_asof_join(spark, chunk_of):
    rng = random.Random(3)
    key = lambda: rng.choice(["a", "a", "a", "b", "c", None])
    facts = [(i, key(), rng.choice([None, *range(200)]), "x") for i in range(300)] + [(900, "z", 5, "x"), (901, "a", -1, "x")]
    history = [(key(), rng.choice([None, *range(0, 200, 5)]), rng.choice([None, "v", "w"]), float(j), j) for j in range(120)]
    got = asof.asof_join(
        spark.createDataFrame([(i, k, at(t), x) for i, k, t, x in facts], "id int, k string, t timestamp_ntz, v string"),
        spark.createDataFrame([(k, at(t), v, n, j) for k, t, v, n, j in history], "who string, since timestamp_ntz, v string, n double, j int"),
        "k", "t", "since", ["v", "n"], tie=["j"], history_keys="who", prefix="then_", chunk_of=chunk_of)
    assert got.columns == ["id", "k", "t", "v", "then_v", "then_n", "then_valid_from"]

    def in_force(k, t):
        past = [h for h in history if None not in (k, t, h[1]) and h[0] == k and h[1] <= t]
        h = max(past, key=lambda h: (h[1], h[4])) if past else (None, None, None, None)
        return h[2], h[3], at(h[1])

    want = [
        (i, k, at(t), x, *in_force(k, t)) for i, k, t, x in facts]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == sorted(want, key=lambda r: r[0])


def test_asof_join_of_empty_sides_and_clashing_names(spark):
    facts = spark.createDataFrame([(1, "a", at(1))], "id int, k string, t timestamp_ntz")
    history = spark.createDataFrame([("a", at(0), "v")], "k string, s timestamp_ntz, v string")
    assert asof.asof_join(facts, history.limit(0), "k", "t", "s", ["v"]).collect()[0][3:] == (None, None)
    assert asof.asof_join(facts.limit(0), history, "k", "t", "s", ["v"]).collect() == []
    with pytest.raises(ValueError):
        asof.asof_join(facts.withColumn("v", F.lit(1)), history, "k", "t", "s", ["v"])


def shuffles(df):
    """Shuffles in the plan that ran; one that is read twice counts once."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan.count(" Exchange hashpartitioning") - plan.count("ReusedExchange")


@pytest.mark.parametrize("hot_rows, most", [(10**6, 1), (5, 3)], ids=["small keys", "cut into chunks"])
def test_asof_join_shuffles_facts_once(spark, tmp_dir, hot_rows, most):
    """Rows of small keys are shuffled once; keys that are cut add one row a chunk, to the carry and back."""
    rng = random.Random(4)
    rows = [(rng.choice("abc"), at(rng.randrange(200)), j) for j in range(300)]
    for name, part in (("facts", rows), ("history", rows[::4])):
        spark.createDataFrame(part, "k string, t timestamp_ntz, n int").write.parquet(f"{tmp_dir}/{name}")
    facts, history = spark.read.parquet(f"{tmp_dir}/facts"), spark.read.parquet(f"{tmp_dir}/history")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = asof.asof_join(facts, history.withColumnsRenamed({"t": "since", "n": "v"}), "k", "t", "since", ["v"], tie=["v"],
                                chunk_of=chunks(hot_rows))
        assert shuffles(joined) <= most
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_keys_scanned_whole_by_day_and_by_hour_side_by_side(spark):
    """A few keys of each size, with NULL keys, times and values, against the single window."""
    rng = random.Random(6)
    sizes = {"whole": 4, "days": 15, "hot": 90, None: 12, "other": 3}
    rows = [(k, at(rng.choice([None, *range(120)])), rng.choice([None, 1, 2]), i)
            for i, k in enumerate(k for k, n in sizes.items() for _ in range(n))]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v int, id int")
    scan = lambda chunk: sorted(map(str, keyed_scan(
        df, "k", ["ts", "id"], prev={"p": ["v", "id"]}, next={"n": ["k", "id"]}, fill=["v"], chunk=chunk).collect()))
    cut = Chunks(F.date_trunc("day", "ts"), F.date_trunc("hour", "ts"), 30, whole_rows=5)
    assert scan(cut) == scan(None) and [r["__hot"] for r in cut.large(df, ["k"]).orderBy("__hot").collect()] == [False, False, True]


def test_facts_without_key_or_time_are_dealt_evenly(spark):
    """They are many keys of their own, and come out as they went in; a key's type may differ between the sides."""
    facts = spark.createDataFrame([(i, None if i % 2 else 7, None if i % 3 == 0 else at(5), {"m": i}) for i in range(60)],
                                  "id int, k int, t timestamp_ntz, m map<string, int>")
    history = spark.createDataFrame([(7, at(1), "v"), (None, at(1), "w")], "k bigint, s timestamp_ntz, v string")
    got = asof.asof_join(facts, history, "k", "t", "s", ["v"], chunk_of=chunks(5))
    assert got.schema[:4] == facts.schema[:4]
    want = [(i, None if i % 2 else 7, None if i % 3 == 0 else at(5), {"m": i}, *(("v", at(1)) if i % 2 == 0 and i % 3 else (None, None)))
            for i in range(60)]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == want


def whole_history(rows):
    """Changes of (key, hour, tie, payload), each compared with the row before it."""
    out, last = [], {}
    for k, t, n, *p in sorted(rows, key=lambda r: r[:3]):
        if k not in last or last[k] != p:
            out.append((k, at(t), n, *p))
        last[k] = p
    return sorted(out, key=str)


@pytest.mark.parametrize("seed, hot", [(1, None), (2, None), (3, 4)])
def test_satellite_increments_equal_the_whole_history(spark, tmp_dir, seed, hot):
    rng = random.Random(seed)
    schema = "hk string, ts timestamp_ntz, n int, a string, b int"
    rows = [(rng.choice("xyz"), rng.randrange(60), j, rng.choice(["p", "q", None]), rng.choice([1, None])) for j in range(150)]
    batches = [[r for r in rows if r[1] < 25 and r[2] % 5], [r for r in rows if r[1] >= 20 and r[2] % 5],
               [r for r in rows if r[2] % 5 == 0 and r[1] < 40], [r for r in rows if r[2] % 5 == 0], [("w", 3, 0, None, None)] * 2]
    chunk = Chunks(F.date_trunc("day", "ts"), F.date_trunc("hour", "ts"), hot) if hot else None
    log, seen, path = None, {}, f"{tmp_dir}/log"
    for i, batch in enumerate(batches):
        df = spark.createDataFrame([(k, at(t), *rest) for k, t, *rest in batch] + [(None, at(1), 1, "p", 1), ("x", None, 1, "p", 1)], schema)
        new = satellite_log.increment(log, df, "hk", "ts", ["a", "b"], i, tie=["n"], chunk=chunk)
        new.write.mode("append").parquet(path)
        log = spark.read.parquet(path)
        seen |= {r[:3]: r for r in batch}
        got = satellite_log.changes(log, "hk", "ts", ["a", "b"], tie=["n"]).collect()
        assert sorted(map(tuple, got), key=str) == whole_history(seen.values())
        assert satellite_log.increment(log, df, "hk", "ts", ["a", "b"], i + 100, tie=["n"], chunk=chunk).count() == 0


@pytest.mark.parametrize("hot_rows", [10**6, 4])
def test_a_load_shuffles_batch_and_log_once(spark, tmp_dir, hot_rows):
    """One shuffle of the log, one of the batch's first rows by key, one of both to the scan, and nothing is written before."""
    rows = [(k, at(h), h, "pq"[h % 3 == 0]) for k in "xy" for h in range(40)]
    for i, part in enumerate((rows[::2], rows[1::2])):
        spark.createDataFrame(part, "hk string, ts timestamp_ntz, n int, a string").write.parquet(f"{tmp_dir}/batch{i}")
    first, second = (spark.read.parquet(f"{tmp_dir}/batch{i}") for i in range(2))
    chunk = Chunks(F.date_trunc("day", "ts"), F.date_trunc("hour", "ts"), hot_rows).counted_on(first.union(second))
    satellite_log.increment(None, first, "hk", "ts", ["a"], 0, tie=["n"], chunk=chunk).write.parquet(f"{tmp_dir}/log")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = satellite_log.increment(spark.read.parquet(f"{tmp_dir}/log"), second, "hk", "ts", ["a"], 1, tie=["n"], chunk=chunk)
        assert shuffles(new) <= (3 if hot_rows > 40 else 5)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    new.write.mode("append").parquet(f"{tmp_dir}/log")
    got = satellite_log.changes(spark.read.parquet(f"{tmp_dir}/log"), "hk", "ts", ["a"], tie=["n"])
    want = [r for i, r in enumerate(rows) if i % 40 == 0 or r[3] != rows[i - 1][3]]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_links_close_and_open_anew(spark, tmp_dir):
    """A profile that moves away and back, one that stays, one whose link ends; the move comes late."""
    schema = "profile string, ts timestamp_ntz, place string"
    first = spark.createDataFrame([("p", at(0), "A"), ("p", at(9), "A"), ("q", at(1), "B"), ("r", at(2), "C"), ("r", at(5), None)], schema)
    late = spark.createDataFrame([("p", at(4), "B"), ("q", at(3), "B")], schema)
    satellite_log.increment(None, first, "profile", "ts", ["place"], 1).write.parquet(tmp_dir + "/l")
    log = spark.read.parquet(tmp_dir + "/l")
    intervals = lambda log: sorted(map(tuple, satellite_log.link_validity(log, "profile", "place", "ts").collect()), key=str)
    assert intervals(log) == [("p", "A", at(0), None), ("q", "B", at(1), None), ("r", "C", at(2), at(5))]
    satellite_log.increment(log, late, "profile", "ts", ["place"], 2).write.mode("append").parquet(tmp_dir + "/l")
    log = spark.read.parquet(tmp_dir + "/l")
    assert intervals(log) == [("p", "A", at(0), at(4)), ("p", "A", at(9), None), ("p", "B", at(4), at(9)), ("q", "B", at(1), None),
                              ("r", "C", at(2), at(5))]


def test_tie_view_as_of_a_time(spark):
    ties = spark.createDataFrame([("p", at(0), "A"), ("p", at(9), "B"), ("q", at(1), "B"), ("q", at(2), None)],
                                 "profile string, ts timestamp_ntz, place string")
    people = spark.createDataFrame([("p", 1), ("q", 2), ("r", 3)], "profile string, age int")
    places = spark.createDataFrame([("A", "north"), ("B", "south")], "place string, part string")
    view = lambda t: sorted(map(tuple, anchor.tie_view(ties, people, places, "profile", "place", "ts", as_of=t).collect()))
    assert view("2024-01-01 05:00:00") == [("p", 1, "A", "north"), ("q", 2, None, None), ("r", 3, None, None)]
    assert view("2024-01-01 01:30:00")[1] == ("q", 2, "B", "south") and view(None)[0] == ("p", 1, "B", "south")


def test_bridge_of_moving_links(spark):
    """Each hour's chain by hand equals the interval that covers it; intervals of a key do not overlap."""
    rng = random.Random(5)

    def moving(children, parents):
        out = []
        for c in children:
            cuts = sorted(rng.sample(range(0, 40), rng.randrange(0, 4)))
            out += [(c, rng.choice(parents), f, t) for f, t in zip(cuts, [*cuts[1:], rng.choice([None, 45])])]
        return out

    base, mid, top = [f"b{i}" for i in range(8)], [f"m{i}" for i in range(3)], ["t0", "t1"]
    low, high = moving(base, mid), moving(mid, top)
    schema = "c string, p string, f timestamp_ntz, t timestamp_ntz"
    frame = lambda rows: asof.link_intervals(spark.createDataFrame([(c, p, at(f), at(t)) for c, p, f, t in rows], schema), "c", "p", "f", "t")
    got = asof.temporal_bridge(spark.createDataFrame([(b,) for b in base], "k string"), "k", [("mid", frame(low)), ("top", frame(high))]).collect()
    step = lambda links, c, h: next((p for x, p, f, t in links if x == c and f <= h and (t is None or h < t)), None)
    for b in base:
        for h in range(-1, 50):
            hits = [r for r in got if r.k == b and (r.valid_from is None or r.valid_from <= at(h)) and (r.valid_to is None or at(h) < r.valid_to)]
            m = step(low, b, h)
            assert [(r.mid, r.top) for r in hits] == [(m, step(high, m, h) if m else None)], (b, h)


@pytest.mark.parametrize("depth", [1, 2, 3, 70, 5000])
def test_deep_hierarchies(spark, depth):
    rows = [(i, i - 1 if i else None, f"n{i}") for i in range(depth + 1)] + [(100_000, 99_999, "absent"), (None, 0, "no id")]
    got = {r.name: r for r in resolve_hierarchy(spark.createDataFrame(rows, "id int, parent int, name string"), "id", "parent", ["name"]).collect()}
    assert len(got) == depth + 3 and all((got[f"n{i}"].root_id, got[f"n{i}"].level) == (0, i) for i in range(depth + 1))
    assert got[f"n{depth}"].grandparent_id == (depth - 2 if depth > 1 else None)
    assert (got["absent"].root_id, got["absent"].level) == (99_999, 1) and (got["no id"].root_id, got["no id"].level) == (0, 1)


def test_cycles_are_named(spark):
    make = lambda rows: spark.createDataFrame(rows, "id int, parent int")
    for rows, named in (([(1, 1)], "[1]"), ([(1, 2), (2, 3), (3, 1), (4, 3), (5, 4), (6, None), (7, 6)], "[1, 2, 3]")):
        with pytest.raises(ValueError, match=named.replace("[", r"\[").replace("]", r"\]")):
            resolve_hierarchy(make(rows), "id", "parent")
    assert resolve_hierarchy(make([]), "id", "parent").collect() == []
