from sparkdesk.operators import lines as L
from sparkdesk.sinks.writers import write_lines
from sparkdesk.sources.files import read_lines


def taxi(vendor="1", pickup="2020-01-05 10:00:00", code="1", tip="2.5", n=18):
    f = [vendor, pickup, pickup, "1", "1.2", "1", "N", "10", "20", code, "7.0", "0", "0.5", tip,
         "0", "0.3", "10.0", "2.5"]
    return ",".join(f[:n])


EDGE_LINES = [
    L.TAXI_HEADER if hasattr(L, "TAXI_HEADER") else "VendorID,tpep_pickup_datetime,x,x,x,x,x,x,x,payment_type,x,x,x,tip_amount",
    "",
    taxi(n=12),                                   # short line
    taxi(pickup="2019-12-31 23:00:00"),           # other year
    taxi(code=""),                                # empty payment type
    taxi(code="7"),                               # unknown code
    taxi(code="x"),                               # non-numeric code
    taxi(tip=""),                                 # empty tip
    taxi(tip="abc"),                              # bad tip
    taxi(code="2", tip="1.0") + "\r",             # CRLF ending
    "  " + taxi(code="1", tip="3.5") + "\t",      # surrounding white space
    taxi(pickup="2020-02-01 00:00:00", code="2", tip="4.0"),
    taxi(pickup="2020-02-01 00:00:00", code="3", tip="oops"),  # last line: bad tip opening a new key
]


def brute_force(lines, year="2020"):
    """Python statement of the intended semantics (bad rows skipped, never fatal)."""
    labels = dict(L.PAYMENT_TYPES)
    acc = {}
    for line in lines:
        v = line.strip().split(",")
        if len(v) < 14 or v[0] == "VendorID" or not v[1] or v[1][:4] != year or not v[9]:
            continue
        try:
            code, tip = int(v[9]), float(v[13])
        except ValueError:
            continue
        if code not in labels:
            continue
        key = (v[1][:7], labels[code])
        s, n = acc.get(key, (0.0, 0))
        acc[key] = (s + tip, n + 1)
    return sorted((m, p, s / n) for (m, p), (s, n) in acc.items())


def test_edge_lines_through_text_files(spark, tmp_dir):
    src = spark.createDataFrame([(x,) for x in EDGE_LINES], "value string")
    write_lines(src, tmp_dir, ["value"])
    raw = read_lines(spark, tmp_dir)
    parsed = L.parse_trip_lines(raw, "2020")
    out = L.avg_tip_by_month_label(parsed, L.payment_dim(spark))
    got = sorted((r.month, r.payment, r.avg_tip) for r in out.collect())
    assert got == brute_force(EDGE_LINES)
    assert ("2020-02", "Cash", 4.0) in got          # previous group is kept even after a bad last line


def test_reject_counts(spark):
    src = spark.createDataFrame([(x,) for x in EDGE_LINES], "value string")
    got = {r.outcome: r.lines for r in L.line_rejects(src, L.payment_dim(spark), "2020").collect()}
    assert got["header"] == 1
    assert got["malformed"] == 2                    # blank + short
    assert got["other_year"] == 1
    assert got["no_payment"] == 1
    assert got["unknown_payment"] == 2
    assert got["bad_tip"] == 3
    assert got["ok"] == 3
    assert sum(got.values()) == len(EDGE_LINES)


def test_nan_tip_parses_as_number(spark):
    src = spark.createDataFrame([(taxi(tip="nan"),)], "value string")
    r = L.parse_trip_lines(src, "2020").first()
    assert r.tip_amount != r.tip_amount             # NaN, like Python float('nan')
