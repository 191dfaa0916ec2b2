"""The subpackage's registered queries and, where SQL can express one, its DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from caretrail.llm import (chat, decontamination, hard_negatives, language_id, licenses, mixing, near_dedup, packing, prefix_trie,
                           quality_classifier, quality_rules, token_files, toxicity)
from caretrail.llm.common import ship


def _registered(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)
    return run


QUERIES = {fn.__name__: _registered(fn) for fn in (
    licenses.op1_license_scan,
    quality_rules.op2_quality_rules,
    near_dedup.op3_near_dedup,
    toxicity.op4_toxicity,
    quality_classifier.op5_quality_classifier,
    chat.op6_chat_formatting,
    packing.op7_packing,
    token_files.op8_token_files,
    decontamination.op9_decontamination,
    language_id.op10_language_id,
    prefix_trie.op11_prefix_trie,
    hard_negatives.op12_hard_negatives,
    mixing.op13_source_mixing,
)}

ORACLES = {
    "op3_near_dedup": near_dedup.ORACLE,
    "op6_chat_formatting": chat.ORACLE,
    "op9_decontamination": decontamination.ORACLE,
    "op11_prefix_trie": prefix_trie.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
    "op13_source_mixing": mixing.ORACLE,
}
