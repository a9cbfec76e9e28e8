"""Queries of this package, one per operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from feedloom.llm.chat import OP8_SQL, op8_chat_format
from feedloom.llm.decontamination import OP7_SQL, op7_decontamination
from feedloom.llm.html_extraction import op1_html_extraction
from feedloom.llm.importance import OP13_SQL, op13_importance_resampling
from feedloom.llm.jaccard_join import op3_jaccard_join
from feedloom.llm.language_id import op11_language_id
from feedloom.llm.lm_scoring import op4_lm_scoring
from feedloom.llm.mixing import op6_source_mixing
from feedloom.llm.quality_classifier import op9_quality_classifier
from feedloom.llm.quality_rules import op5_quality_rules
from feedloom.llm.token_ids import op10_token_ids
from feedloom.llm.toxicity import op2_toxicity
from feedloom.llm.vector_codes import OP12_SQL, op12_vector_codes

QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_toxicity": op2_toxicity,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_quality_rules": op5_quality_rules,
    "op6_source_mixing": op6_source_mixing,
    "op7_decontamination": op7_decontamination,
    "op8_chat_format": op8_chat_format,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_token_ids": op10_token_ids,
    "op11_language_id": op11_language_id,
    "op12_vector_codes": op12_vector_codes,
    "op13_importance_resampling": op13_importance_resampling,
}
ORACLES = {
    "op7_decontamination": OP7_SQL,
    "op8_chat_format": OP8_SQL,
    "op12_vector_codes": OP12_SQL,
    "op13_importance_resampling": OP13_SQL,
}
