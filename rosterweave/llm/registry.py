"""The queries of this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rosterweave.llm import alignment, bpe, exact_dedup, hard_negatives, langid, line_dedup, lm_scoring, ngram_join, quality_classifier, quality_rules, simhash, source_mix, substring_dedup


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": langid.op1_language_id,
        "op2_exact_dedup": exact_dedup.op2_exact_dedup,
        "op3_line_dedup": line_dedup.op3_line_dedup,
        "op4_simhash": simhash.op4_simhash,
        "op5_source_mix": source_mix.op5_source_mix,
        "op6_quality_rules": quality_rules.op6_quality_rules,
        "op7_bpe": bpe.op7_bpe,
        "op8_lm_scoring": lm_scoring.op8_lm_scoring,
        "op9_quality_classifier": quality_classifier.op9_quality_classifier,
        "op10_substring_dedup": substring_dedup.op10_substring_dedup,
        "op11_token_alignment": alignment.op11_token_alignment,
        "op12_hard_negatives": hard_negatives.op12_hard_negatives,
        "op13_ngram_join": ngram_join.op13_ngram_join,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": exact_dedup.ORACLE, "op3_line_dedup": line_dedup.ORACLE, "op5_source_mix": source_mix.ORACLE, "op6_quality_rules": quality_rules.ORACLE, "op12_hard_negatives": hard_negatives.ORACLE}
