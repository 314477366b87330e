"""The queries of this subpackage and their oracle SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkdesk.llm import queries as q
from sparkdesk.llm import sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_scans": q.op1_secret_scans,
        "op2_line_dedup": q.op2_line_dedup,
        "op3_byte_bpe": q.op3_byte_bpe,
        "op4_url_filters": q.op4_url_filters,
        "op5_toxicity": q.op5_toxicity,
        "op6_lm_scoring": q.op6_lm_scoring,
        "op7_substring_dedup": q.op7_substring_dedup,
        "op8_quality_rules": q.op8_quality_rules,
        "op9_benchmark_decontamination": q.op9_benchmark_decontamination,
        "op10_simhash_near_dedup": q.op10_simhash_near_dedup,
        "op11_language_id": q.op11_language_id,
        "op12_conversation_trie": q.op12_conversation_trie,
        "op13_fill_in_middle": q.op13_fill_in_middle,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_line_dedup": sql.LINE_DEDUP,
        "op4_url_filters": sql.url_filters(),
        "op7_substring_dedup": sql.SUBSTRING_DEDUP,
        "op8_quality_rules": sql.quality_rules(),
        "op9_benchmark_decontamination": sql.BENCHMARK_DECONTAMINATION,
        "op12_conversation_trie": sql.CONVERSATION_TRIE,
        "op13_fill_in_middle": sql.FILL_IN_MIDDLE,
    }
