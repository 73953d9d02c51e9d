"""The numbered queries and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from linkspark.llm.chat_examples import OP1_SQL, op1_chat_prefix_targets
from linkspark.llm.warc_store import OP2_SQL, op2_warc_index_first
from linkspark.llm.pii_anchors import op9_pii_anchor_expansion
from linkspark.llm.language_codes import op10_language_ecoc
from linkspark.llm.quality_vectors import op8_quality_subwords
from linkspark.llm.source_mix import OP7_SQL, op7_source_mix
from linkspark.llm.paragraph_sketch import op4_paragraph_sketch
from linkspark.llm.best_fit_packing import op6_best_fit_packing
from linkspark.llm.learned_partitions import op3_learned_partitions
from linkspark.llm.jaccard_join import op5_jaccard_set_relations
from linkspark.llm.block_whitening import op11_block_whitening
from linkspark.llm.conversation_repair import OP12_SQL, op12_conversation_repair
from linkspark.llm.cross_polytope import op13_cross_polytope

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_prefix_targets": op1_chat_prefix_targets,
    "op2_warc_index_first": op2_warc_index_first,
    "op9_pii_anchor_expansion": op9_pii_anchor_expansion,
    "op10_language_ecoc": op10_language_ecoc,
    "op8_quality_subwords": op8_quality_subwords,
    "op7_source_mix": op7_source_mix,
    "op4_paragraph_sketch": op4_paragraph_sketch,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op3_learned_partitions": op3_learned_partitions,
    "op5_jaccard_set_relations": op5_jaccard_set_relations,
    "op11_block_whitening": op11_block_whitening,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_cross_polytope": op13_cross_polytope,
}

ORACLES: dict[str, str] = {
    "op1_chat_prefix_targets": OP1_SQL,
    "op2_warc_index_first": OP2_SQL,
    "op7_source_mix": OP7_SQL,
    "op12_conversation_repair": OP12_SQL,
}
