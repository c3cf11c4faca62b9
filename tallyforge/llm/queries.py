"""The queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, html_text, jaccard_join, language_id, licenses, lm_score, mix_sources, quality_classifier, quality_rules, token_output


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontaminate": decontaminate.op1,
        "op2_lm_score": lm_score.op2,
        "op3_quality_rules": quality_rules.op3,
        "op4_main_text": html_text.op4,
        "op5_jaccard_join": jaccard_join.op5,
        "op6_quality_classifier": quality_classifier.op6,
        "op7_language_id": language_id.op7,
        "op8_mix_sources": mix_sources.op8,
        "op9_license_scan": licenses.op9,
        "op10_token_output": token_output.op10,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontaminate": decontaminate.SQL,
        "op8_mix_sources": mix_sources.SQL,
        "op9_license_scan": licenses.SQL,
    }
