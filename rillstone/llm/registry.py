"""The queries of the operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import conversation_repair, embedding_dedup, jaccard_join, line_dedup, lm_scoring, mixing, packing, periodic_runs, pii_surrogates, quality_rules, substring_dedup, toxicity, url_reputation

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": lm_scoring.query,
    "op2_quality_rules": quality_rules.query,
    "op3_source_mixing": mixing.query,
    "op4_sequence_packing": packing.query,
    "op5_url_reputation": url_reputation.query,
    "op6_pii_surrogates": pii_surrogates.query,
    "op7_substring_dedup": substring_dedup.query,
    "op8_embedding_dedup": embedding_dedup.query,
    "op9_jaccard_join": jaccard_join.query,
    "op10_line_dedup": line_dedup.query,
    "op11_periodic_runs": periodic_runs.query,
    "op12_toxicity": toxicity.query,
    "op13_conversation_repair": conversation_repair.query,
}

ORACLES: dict[str, str] = {
    "op2_quality_rules": quality_rules.ORACLE,
    "op3_source_mixing": mixing.ORACLE,
    "op5_url_reputation": url_reputation.ORACLE,
    "op7_substring_dedup": substring_dedup.ORACLE,
    "op8_embedding_dedup": embedding_dedup.ORACLE,
    "op9_jaccard_join": jaccard_join.ORACLE,
    "op10_line_dedup": line_dedup.ORACLE,
    "op11_periodic_runs": periodic_runs.ORACLE,
    "op13_conversation_repair": conversation_repair.ORACLE,
}
