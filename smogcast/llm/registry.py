"""Queries of the subpackage: name -> callable (spark, sf_dir), and DuckDB SQL where SQL can express one."""

from __future__ import annotations

import corpus_pipeline
from smogcast.llm.brown import op8_brown
from smogcast.llm.host_rules import op5_host_rules
from smogcast.llm.imatch import op12_imatch
from smogcast.llm.merkle import op11_merkle
from smogcast.llm.mixing import op9_mixing
from smogcast.llm.nbsvm import op4_nbsvm
from smogcast.llm.oracle import SQL
from smogcast.llm.packing import op6_packing
from smogcast.llm.pii_crf import op2_pii_crf
from smogcast.llm.secrets_cnn import op1_secrets_cnn
from smogcast.llm.simhash_golay import op7_simhash_golay
from smogcast.llm.suffix_dedup import op3_suffix_dedup
from smogcast.llm.turns import op13_turns
from smogcast.llm.vector_graph import op10_vector_graph

QUERIES = {
    "op1_secrets_cnn": op1_secrets_cnn,
    "op2_pii_crf": op2_pii_crf,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_nbsvm": op4_nbsvm,
    "op5_host_rules": op5_host_rules,
    "op6_packing": op6_packing,
    "op7_simhash_golay": op7_simhash_golay,
    "op8_brown": op8_brown,
    "op9_mixing": op9_mixing,
    "op10_vector_graph": op10_vector_graph,
    "op11_merkle": op11_merkle,
    "op12_imatch": op12_imatch,
    "op13_turns": op13_turns,
    "pipeline": corpus_pipeline.run,
}

__all__ = ["QUERIES", "SQL"]
