"""Registered queries of this folder and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from linkloom.llm import chat, divergence, mixing, sentence_spans, vector_codes
from linkloom.llm.exact_search import op10_exact_top_k
from linkloom.llm.group_join import op13_group_join
from linkloom.llm.line_dedup import op5_fuzzy_line_dedup
from linkloom.llm.near_dedup import op8_minhash_near_dedup
from linkloom.llm.neighbours import op9_small_world_neighbours
from linkloom.llm.packing import op7_harmonic_packing
from linkloom.llm.quality import op3_quality_discriminant
from linkloom.llm.token_counts import op4_token_counts

QUERIES = (
    mixing.op1_temperature_mixing,
    chat.op2_reply_tree_chat,
    op3_quality_discriminant,
    op4_token_counts,
    op5_fuzzy_line_dedup,
    sentence_spans.op6_sentence_spans,
    op7_harmonic_packing,
    op8_minhash_near_dedup,
    op9_small_world_neighbours,
    op10_exact_top_k,
    divergence.op11_source_divergence,
    vector_codes.op12_vector_codes,
    op13_group_join,
)
SQL: dict[str, str] = {
    "op1_temperature_mixing": mixing.SQL,
    "op2_reply_tree_chat": chat.SQL,
    "op6_sentence_spans": sentence_spans.SQL,
    "op11_source_divergence": divergence.SQL,
    "op12_vector_codes": vector_codes.SQL,
}


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {fn.__name__: fn for fn in QUERIES} | {"pipeline": corpus_pipeline.run}
