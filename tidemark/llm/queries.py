"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from tidemark.llm import chat_format, collocations, filter_audit, mixing, warc
from tidemark.llm.byte_bpe import op9_byte_bpe
from tidemark.llm.importance import op4_importance
from tidemark.llm.near_dedup import op10_near_duplicates
from tidemark.llm.private_terms import op6_private_terms
from tidemark.llm.quality_rules import op7_quality_rules
from tidemark.llm.sharding import op11_sharding
from tidemark.llm.token_planes import op5_token_planes
from tidemark.llm.winnowing import op2_winnowing

QUERIES = {
    "op1_warc": warc.op1_warc,
    "op2_winnowing": op2_winnowing,
    "op3_chat_format": chat_format.op3_chat_format,
    "op4_importance": op4_importance,
    "op5_token_planes": op5_token_planes,
    "op6_private_terms": op6_private_terms,
    "op7_quality_rules": op7_quality_rules,
    "op8_mixing": mixing.op8_mixing,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_sharding": op11_sharding,
    "op12_collocations": collocations.op12_collocations,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}
ORACLES = {
    "op1_warc": warc.ORACLE,
    "op3_chat_format": chat_format.ORACLE,
    "op8_mixing": mixing.ORACLE,
    "op12_collocations": collocations.ORACLE,
    "op13_filter_audit": filter_audit.ORACLE,
}
