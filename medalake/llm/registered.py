"""Queries of this subpackage and their SQL on another engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from medalake.llm import (
    collocations, digests, divergence, lengths, negatives, overlap, packing, resampling, sharding,
    suffixes, toxicity, warc, wrappers,
)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_wrapper_text": wrappers.op1_wrapper_text,
        "op2_noisy_channel": toxicity.op2_noisy_channel,
        "op3_first_fit_packing": packing.op3_first_fit_packing,
        "op4_jump_shards": sharding.op4_jump_shards,
        "op5_boundary_chain": warc.op5_boundary_chain,
        "op6_importance_resampling": resampling.op6_importance_resampling,
        "op7_suffix_arrays": suffixes.op7_suffix_arrays,
        "op8_divergence_rules": divergence.op8_divergence_rules,
        "op9_length_sums": lengths.op9_length_sums,
        "op10_t_occurrence": overlap.op10_t_occurrence,
        "op11_threshold_negatives": negatives.op11_threshold_negatives,
        "op12_digest_index": digests.op12_digest_index,
        "op13_vertical_phrases": collocations.op13_vertical_phrases,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that SQL can express; tests hold the others against brute force."""
    return {
        "op4_jump_shards": sharding.OP4_SQL,
        "op5_boundary_chain": warc.OP5_SQL,
        "op7_suffix_arrays": suffixes.OP7_SQL,
        "op8_divergence_rules": divergence.OP8_SQL,
        "op10_t_occurrence": overlap.OP10_SQL,
        "op11_threshold_negatives": negatives.OP11_SQL,
        "op12_digest_index": digests.OP12_SQL,
        "op13_vertical_phrases": collocations.OP13_SQL,
    }
