"""The registered queries of the operators, each beside its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from hybridloom.llm import bpe, decontamination, minhash, mixing, neighbours, periodic, preferences, sharding, spelling, suffixes, templates, toxicity, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jump_shards": sharding.op1_jump_shards,
    "op2_benchmark_hits": decontamination.op2_benchmark_hits,
    "op3_url_filter": urls.op3_url_filter,
    "op4_toxicity_scores": toxicity.op4_toxicity_scores,
    "op5_repeated_bytes": suffixes.op5_repeated_bytes,
    "op6_near_duplicates": minhash.op6_near_duplicates,
    "op7_source_mix": mixing.op7_source_mix,
    "op8_page_text": templates.op8_page_text,
    "op9_nearest_vectors": neighbours.op9_nearest_vectors,
    "op10_preference_pairs": preferences.op10_preference_pairs,
    "op11_bpe_round_trip": bpe.op11_bpe_round_trip,
    "op12_periodic_runs": periodic.op12_periodic_runs,
    "op13_spelling_variants": spelling.op13_spelling_variants,
    "pipeline": corpus_pipeline.run,
}
SQL: dict[str, str] = {
    "op1_jump_shards": sharding.JUMP_SHARDS_SQL,
    "op2_benchmark_hits": decontamination.BENCHMARK_HITS_SQL,
    "op3_url_filter": urls.URL_FILTER_SQL,
    "op6_near_duplicates": minhash.NEAR_DUPLICATES_SQL,
    "op7_source_mix": mixing.SOURCE_MIX_SQL,
    "op10_preference_pairs": preferences.PREFERENCE_PAIRS_SQL,
    "op13_spelling_variants": spelling.SPELLING_VARIANTS_SQL,
}
