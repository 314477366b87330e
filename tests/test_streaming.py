import os

from sparkdesk.operators import lines as L
from sparkdesk.streaming import run_incremental_tip_report
from tests.test_lines import EDGE_LINES, brute_force, taxi


def land(tmp_dir, name, lines):
    os.makedirs(os.path.join(tmp_dir, "landing"), exist_ok=True)
    with open(os.path.join(tmp_dir, "landing", name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_resumes_and_matches_batch(spark, tmp_dir):
    more = [taxi(code="2", tip="10.0"), taxi(pickup="2020-03-01 00:00:00", code="1", tip="1.25")]
    land(tmp_dir, "a.txt", EDGE_LINES)
    args = (os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "report"), os.path.join(tmp_dir, "ckpt"), "2020")
    first = run_incremental_tip_report(spark, *args)
    assert sorted(tuple(r) for r in first.collect()) == brute_force(EDGE_LINES)
    land(tmp_dir, "b.txt", more)
    second = run_incremental_tip_report(spark, *args)          # only b.txt is new; state carries a.txt
    assert sorted(tuple(r) for r in second.collect()) == brute_force(EDGE_LINES + more)
    assert L.HEADER_VENDOR == "VendorID"
