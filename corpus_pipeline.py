"""A training corpus from raw documents: five stages, each written and read again.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkdesk.llm import byte_bpe, decontaminate, line_chunks, quality_rules, queries, simhash
from sparkdesk.session import write_scratch
from sparkdesk.sources.tables import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Chunks of lines that stand earlier in the corpus are taken out of the text."""
    return line_chunks.drop_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return simhash.keep_first(docs, simhash.near_duplicates(docs))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go."""
    found = decontaminate.benchmark_overlap(docs, table(spark, sf_dir, "benchmark"))
    return decontaminate.drop_contaminated(docs, found)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's token ids, and the digests of a round trip."""
    path, pattern = queries.byte_vocabulary()
    return byte_bpe.encode_documents(docs, path, pattern, keep_ids=True)


STAGES = [("quality rules", quality), ("line dedup", lines), ("near duplicates", near_duplicates),
          ("benchmark decontamination", benchmark), ("byte-level BPE", tokens)]

#: The fingerprints need XXH64 and the last stage a tokenizer, which SQL lacks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_scratch(stage(spark, docs, sf_dir), "pipeline_" + name.replace(" ", "_"))
    return docs
