"""The pipeline's stages, each against the operator that it calls, and the registered queries."""

import corpus_pipeline
import pytest
from helpers import CLASHING, awkward_rows, frame

from sparkdesk.llm import decontaminate, line_chunks, quality_rules, registry, simhash

SF = "/root/testdata/sf0.001"


def test_stages_on_awkward_rows(spark):
    docs = frame(spark, awkward_rows(), CLASHING)
    for (name, stage) in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() <= docs.count(), name
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_run_equals_the_stages_by_hand(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    make = lambda d: spark.createDataFrame(list(d.values()), "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = {r.doc_id for r in quality_rules.quality_rules(make(docs)).filter("kept").collect()}
    docs = {i: r for i, r in docs.items() if i in kept}
    texts = {r.doc_id: r.kept_text for r in line_chunks.dedup_lines(make(docs)).collect()}
    docs = {i: (i, texts[i] if r.text is not None else None, *r[2:]) for i, r in docs.items()}
    first = {r.component_id for r in simhash.near_duplicates(make(docs)).collect()}
    docs = {i: r for i, r in docs.items() if i in first}
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    bad = {r.doc_id for r in decontaminate.benchmark_overlap(make(docs), items).filter("contaminated").collect()}
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(set(docs) - bad) and all(r.round_trip for r in got)
    assert all(len(r.token_ids) == r.n_tokens for r in got)


@pytest.mark.parametrize("name", [n for n in registry.queries() if n in registry.oracle_sql()])
def test_oracle(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(registry.oracle_sql()[name])
    cols = [c[0] for c in want.description]
    got = registry.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(cols)
    assert sorted(map(tuple, got.select(*cols).collect()), key=str) == sorted(want.fetchall(), key=str)
