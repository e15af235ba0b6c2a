"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from repseq.llm import decontamination, hard_negatives, language_id, merkle, mixing, pii, quality_classifier, quality_rules, sharding, simhash, token_files, toxicity, url_filters

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": quality_classifier.op1_quality_classifier,
    "op2_decontamination": decontamination.op2_decontamination,
    "op3_url_filters": url_filters.op3_url_filters,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_language_id": language_id.op5_language_id,
    "op6_token_files": token_files.op6_token_files,
    "op7_sharding": sharding.op7_sharding,
    "op8_simhash": simhash.op8_simhash,
    "op9_quality_rules": quality_rules.op9_quality_rules,
    "op10_mixing": mixing.op10_mixing,
    "op11_merkle": merkle.op11_merkle,
    "op12_pii": pii.op12_pii,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}

ORACLES: dict[str, str] = {
    "op2_decontamination": decontamination.ORACLE,
    "op3_url_filters": url_filters.ORACLE,
    "op9_quality_rules": quality_rules.ORACLE,
    "op10_mixing": mixing.ORACLE,
    "op11_merkle": merkle.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}
