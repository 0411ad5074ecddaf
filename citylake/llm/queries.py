"""Registered queries of this subpackage, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from citylake.llm.alignment import op12_pointer_alignment
from citylake.llm.bpe import op5_bpe_tree_concatenation
from citylake.llm.decontaminate import OP9_SQL, op9_benchmark_decontamination
from citylake.llm.jaccard_join import OP1_SQL, op1_ngram_jaccard_join
from citylake.llm.language_model import op3_brown_language_model
from citylake.llm.mixing import op13_pareto_mix
from citylake.llm.negatives import OP11_SQL, op11_l2ap_negatives
from citylake.llm.quality import OP6_SQL, op6_adaptive_quality
from citylake.llm.sharding import op10_sampled_splitters
from citylake.llm.substring_dedup import OP8_SQL, op8_substring_dedup
from citylake.llm.token_frames import op7_token_frames
from citylake.llm.toxicity import op4_toxicity_crf
from citylake.llm.url_filter import OP2_SQL, op2_link_graph

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_link_graph": op2_link_graph,
    "op3_brown_language_model": op3_brown_language_model,
    "op4_toxicity_crf": op4_toxicity_crf,
    "op5_bpe_tree_concatenation": op5_bpe_tree_concatenation,
    "op6_adaptive_quality": op6_adaptive_quality,
    "op7_token_frames": op7_token_frames,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_sampled_splitters": op10_sampled_splitters,
    "op11_l2ap_negatives": op11_l2ap_negatives,
    "op12_pointer_alignment": op12_pointer_alignment,
    "op13_pareto_mix": op13_pareto_mix,
}

#: Operators 3, 4, 5, 7, 10, 12 and 13 learn, tokenize, or draw by checksums and hashes that DuckDB lacks: their tests have brute force.
ORACLE_SQL: dict[str, str] = {
    "op1_ngram_jaccard_join": OP1_SQL,
    "op2_link_graph": OP2_SQL,
    "op6_adaptive_quality": OP6_SQL,
    "op8_substring_dedup": OP8_SQL,
    "op9_benchmark_decontamination": OP9_SQL,
    "op11_l2ap_negatives": OP11_SQL,
}
