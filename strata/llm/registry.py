"""Queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

import corpus_pipeline
from strata.llm import (
    centroid_clusters,
    exact_dedup,
    fill_middle,
    language_id,
    mixing,
    near_dedup,
    quality_rules,
    secrets,
    sentencepiece_codec,
    substring_trees,
    suffix_dedup,
    token_shards,
    warc,
)

QUERIES = {
    "op1_exact_dedup": exact_dedup.query,
    "op2_warc": warc.query,
    "op3_near_dedup": near_dedup.query,
    "op4_suffix_dedup": suffix_dedup.query,
    "op5_secret_scan": secrets.query,
    "op6_sentencepiece": sentencepiece_codec.query,
    "op7_quality_rules": quality_rules.query,
    "op8_language_id": language_id.query,
    "op9_token_shards": token_shards.query,
    "op10_source_mixing": mixing.query,
    "op11_centroid_clusters": centroid_clusters.query,
    "op12_fill_middle": fill_middle.query,
    "op13_substring_dedup": substring_trees.query,
    "pipeline": corpus_pipeline.run,
}
ORACLE_SQL = {
    "op1_exact_dedup": exact_dedup.ORACLE,
    "op2_warc": warc.ORACLE,
    "op3_near_dedup": near_dedup.ORACLE,
    "op4_suffix_dedup": suffix_dedup.ORACLE,
    "op5_secret_scan": secrets.ORACLE,
    "op7_quality_rules": quality_rules.ORACLE,
    "op10_source_mixing": mixing.ORACLE,
    "op11_centroid_clusters": centroid_clusters.ORACLE,
    "op12_fill_middle": fill_middle.ORACLE,
    "op13_substring_dedup": substring_trees.ORACLE,
}
