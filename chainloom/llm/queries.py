"""The queries of this subpackage and, where SQL can express one, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import language_id, line_dedup, lm_scoring, ngram_join, packing, piece_codec, quality_classifier, quality_rules, token_counts, topk, url_filter, vector_codes, whitening


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_join": ngram_join.op1_ngram_join,
        "op2_lm_scoring": lm_scoring.op2_lm_scoring,
        "op3_piece_codec": piece_codec.op3_piece_codec,
        "op4_maxscore": topk.op4_maxscore,
        "op5_quality_classifier": quality_classifier.op5_quality_classifier,
        "op6_best_fit": packing.op6_best_fit,
        "op7_line_dedup": line_dedup.op7_line_dedup,
        "op8_language_id": language_id.op8_language_id,
        "op9_url_filter": url_filter.op9_url_filter,
        "op10_quality_rules": quality_rules.op10_quality_rules,
        "op11_vector_codes": vector_codes.op11_vector_codes,
        "op12_token_counts": token_counts.op12_token_counts,
        "op13_whitening": whitening.op13_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_ngram_join": ngram_join.ORACLE, "op4_maxscore": topk.ORACLE, "op9_url_filter": url_filter.ORACLE, "op11_vector_codes": vector_codes.ORACLE}
