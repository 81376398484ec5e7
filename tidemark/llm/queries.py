"""Registered queries of the operators, and DuckDB SQL where SQL can express one."""

from __future__ import annotations

from tidemark.llm.chunks import op2_gear_chunk_dedup
from tidemark.llm.embeddings import OP3_SQL, op3_embedding_neardup
from tidemark.llm.html import op8_text_density
from tidemark.llm.jaccard import OP4_SQL, op4_jaccard_join
from tidemark.llm.langid import op7_byte_cnn_langid
from tidemark.llm.mixing import op9_source_mix
from tidemark.llm.mixture import op10_context_mixing
from tidemark.llm.packing import op5_sum_of_squares_packing
from tidemark.llm.resampling import OP13_SQL, op13_importance_resampling
from tidemark.llm.suffixes import OP6_SQL, op6_suffix_dedup
from tidemark.llm.topk import OP1_SQL, op1_kdtree_topk
from tidemark.llm.toxicity import op11_toxicity_cnn
from tidemark.llm.trie import OP12_SQL, op12_prefix_trie

LLM_QUERIES = {
    "op1_kdtree_topk": op1_kdtree_topk,
    "op2_gear_chunk_dedup": op2_gear_chunk_dedup,
    "op3_embedding_neardup": op3_embedding_neardup,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_sum_of_squares_packing": op5_sum_of_squares_packing,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_byte_cnn_langid": op7_byte_cnn_langid,
    "op8_text_density": op8_text_density,
    "op9_source_mix": op9_source_mix,
    "op10_context_mixing": op10_context_mixing,
    "op11_toxicity_cnn": op11_toxicity_cnn,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_importance_resampling": op13_importance_resampling,
}

LLM_SQL = {
    "op1_kdtree_topk": OP1_SQL,
    "op3_embedding_neardup": OP3_SQL,
    "op4_jaccard_join": OP4_SQL,
    "op6_suffix_dedup": OP6_SQL,
    "op12_prefix_trie": OP12_SQL,
    "op13_importance_resampling": OP13_SQL,
}
