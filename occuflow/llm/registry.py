"""Queries of the training-data operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from occuflow.llm import (fingerprint, jaccard_join, lm_score, mixing, packing, periodic, quality_rules, relative_lz,
                          secret_scan, suffix_dedup, token_alignment,
                          toxicity, url_filter)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
    "op3_url_filter": url_filter.op3_url_filter,
    "op4_secret_scan": secret_scan.op4_secret_scan,
    "op5_quality_rules": quality_rules.op5_quality_rules,
    "op6_winnowing": fingerprint.op6_winnowing,
    "op7_pack_windows": packing.op7_pack_windows,
    "op8_kneser_ney": lm_score.op8_kneser_ney,
    "op9_jaccard_join": jaccard_join.op9_jaccard_join,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_periodic_runs": periodic.op11_periodic_runs,
    "op12_relative_lz": relative_lz.op12_relative_lz,
    "op13_token_alignment": token_alignment.op13_token_alignment,
}

ORACLE_SQL: dict[str, str] = {
    "op2_suffix_dedup": suffix_dedup.OP2_SQL,
    "op3_url_filter": url_filter.OP3_SQL,
    "op5_quality_rules": quality_rules.OP5_SQL,
    "op9_jaccard_join": jaccard_join.OP9_SQL,
    "op11_periodic_runs": periodic.OP11_SQL,
    "op12_relative_lz": relative_lz.OP12_SQL,
}
