"""Each operator applied to its whole table, with the columns that its contract names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkdesk.llm import (
    byte_bpe,
    context_language,
    conversation_trie,
    decontaminate,
    fill_in_middle,
    hmm,
    host_reputation,
    line_chunks,
    quality_rules,
    secrets,
    severity,
    simhash,
    substrings,
)
from sparkdesk.sources.tables import table


def byte_vocabulary() -> tuple[str, str]:
    """The rank file and the splitting pattern of the byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans",
                        "n_live", "n_copied")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = line_chunks.dedup_lines(table(spark, sf_dir, "documents"))
    return deduped.select("doc_id", "n_lines", "n_removed_lines", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = byte_vocabulary()
    return byte_bpe.encode_documents(table(spark, sf_dir, "documents"), path, pattern)


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_reputation.judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades: 0 not toxic, 1 toxic, 2 toxic and of low quality."""
    labels = table(spark, sf_dir, "labels")
    severe = (F.col("toxic") == 1) & (F.col("quality") == 0)
    graded = labels.select("doc_id", (F.col("toxic") + F.coalesce(severe.cast("int"), F.lit(0))).alias("grade"))
    judged = severity.predict_severity(table(spark, sf_dir, "documents"), graded)
    return judged.select("doc_id", "expected_severity", "grade", "toxic")


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_documents(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"), window=50)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.benchmark_overlap(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
                         F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated")


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3, seed=42)
    return found.select("doc_id", "fingerprint", "component_id")


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = context_language.identify_languages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "bits_per_byte")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = conversation_trie.conversation_trie(table(spark, sf_dir, "conversations"), group=20, heads=4)
    return nodes.withColumnRenamed("ends", "ends_sha256")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.transform_documents(table(spark, sf_dir, "documents"), salt="7", rate=100, spm_rate=50)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))
