import json
import os

import pytest

from sparkdesk.operators import pages as P
from sparkdesk.sources.files import read_pages


def page(n, total, results):
    return {"page": n, "info": {"count": len(results), "pages": total}, "results": results}


LOCS = [
    page(1, 2, [
        {"id": 1, "name": "North Yard", "type": "Depot", "dimension": "Z-1", "residents": ["a", "b", "c"]},
        {"id": 2, "type": "Depot", "dimension": "D", "residents": ["a"]},                 # no name
        {"id": 3, "name": "Joe's \"Bar\"", "type": "Bar", "dimension": "D"},              # no residents, quote
        {"id": 4, "name": "Void", "type": "Space", "dimension": "D", "residents": None},   # null residents
    ]),
    page(2, 2, [
        {"id": 5, "name": "Harbour", "type": "Station", "dimension": "X", "residents": ["a", "b", "c"]},
        {"id": 6, "name": "Empty", "type": "X", "dimension": "X", "residents": []},
        {"id": 7, "name": "Big", "type": "X", "dimension": "X", "residents": ["a", "b", "c"]},
    ]),
]


def land(tmp_dir, docs, multi_line):
    for d in docs:
        with open(os.path.join(tmp_dir, f"page-{d['page']}.json"), "w") as f:
            f.write(json.dumps(d, indent=2 if multi_line else None))


@pytest.mark.parametrize("multi_line", [False, True])
def test_explode_defaults_and_stable_top3(spark, tmp_dir, multi_line):
    land(tmp_dir, LOCS, multi_line)
    pages = read_pages(spark, tmp_dir, multi_line=multi_line)
    P.assert_complete(pages)
    locs = {r.id: r for r in P.explode_pages(pages).collect()}
    assert locs[2].name == "" and locs[2].residents_cnt == 1
    assert locs[3].residents_cnt == 0 and locs[3].name == 'Joe\'s "Bar"'
    assert locs[4].residents_cnt == 0
    assert locs[6].residents_cnt == 0
    top = [r.id for r in P.top_locations(P.explode_pages(pages), 3).collect()]
    # ties on 3 residents keep page then position order, as a stable descending sort does
    assert top == [1, 5, 7]


def test_missing_page_is_detected(spark, tmp_dir):
    land(tmp_dir, [LOCS[1]], False)
    with pytest.raises(ValueError):
        P.assert_complete(read_pages(spark, tmp_dir))


def test_empty_results_page(spark, tmp_dir):
    land(tmp_dir, [page(1, 1, [])], False)
    pages = read_pages(spark, tmp_dir)
    P.assert_complete(pages)
    assert P.explode_pages(pages).count() == 0
