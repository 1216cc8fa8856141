"""The queries of this folder: name -> plan over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from panelwright.llm.byte_bpe import op10_byte_bpe
from panelwright.llm.chat_format import OP4_SQL, op4_chat_format
from panelwright.llm.importance import OP12_SQL, op12_importance
from panelwright.llm.jaccard import op5_ngram_jaccard
from panelwright.llm.mixing import op13_mixing
from panelwright.llm.neighbours import op9_cross_polytope
from panelwright.llm.packing import op8_packing
from panelwright.llm.quality_model import op3_quality_classifier
from panelwright.llm.quality_rules import op2_quality_rules
from panelwright.llm.rans_files import op7_rans_files
from panelwright.llm.substring import OP1_SQL, op1_substring_dedup
from panelwright.llm.toxicity import op6_toxicity
from panelwright.llm.vector_codes import OP11_SQL, op11_vector_codes

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_chat_format": op4_chat_format,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_toxicity": op6_toxicity,
    "op7_rans_files": op7_rans_files,
    "op8_packing": op8_packing,
    "op9_cross_polytope": op9_cross_polytope,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_vector_codes": op11_vector_codes,
    "op12_importance": op12_importance,
    "op13_mixing": op13_mixing,
}

SQL = {
    "op1_substring_dedup": OP1_SQL,
    "op4_chat_format": OP4_SQL,
    "op11_vector_codes": OP11_SQL,
    "op12_importance": OP12_SQL,
}
