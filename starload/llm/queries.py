"""Registered queries of the corpus operators and their SQL, by name."""

from __future__ import annotations

from starload.llm import (
    q_brown,
    q_chatformat,
    q_decontam,
    q_exactdedup,
    q_filter_audit,
    q_langid,
    q_lexical,
    q_minhash,
    q_mixing,
    q_sharding,
    q_substrings,
    q_subword,
    q_tokencount,
)

_TABLE = [
    ("op1_minhash", q_minhash.op1_minhash, None),
    ("op2_decontam", q_decontam.op2_decontam, q_decontam.OP2_SQL),
    ("op3_langid", q_langid.op3_langid, None),
    ("op4_tokencount", q_tokencount.op4_tokencount, None),
    ("op5_chatformat", q_chatformat.op5_chatformat, q_chatformat.OP5_SQL),
    ("op6_mixing", q_mixing.op6_mixing, q_mixing.OP6_SQL),
    ("op7_substrings", q_substrings.op7_substrings, q_substrings.OP7_SQL),
    ("op8_exactdedup", q_exactdedup.op8_exactdedup, q_exactdedup.OP8_SQL),
    ("op9_sharding", q_sharding.op9_sharding, q_sharding.OP9_SQL),
    ("op10_brown", q_brown.op10_brown, None),
    ("op11_lexical", q_lexical.op11_lexical, q_lexical.OP11_SQL),
    ("op12_subword", q_subword.op12_subword, None),
    ("op13_filter_audit", q_filter_audit.op13_filter_audit, q_filter_audit.OP13_SQL),
]

QUERIES = {name: query for name, query, _ in _TABLE}
ORACLES = {name: sql for name, _, sql in _TABLE if sql}
