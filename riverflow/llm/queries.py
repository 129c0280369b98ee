"""Registered queries of the training-data operators and their DuckDB SQL.

An operator without SQL here is tested against a brute-force version, an exact
round trip or held-out accuracy in ``tests/llm``.
"""

from __future__ import annotations

from riverflow.llm import (
    convrepair, langid, linedup, periodic, pfair, pu, quotes, simhash, superminhash, tagpath, tokenbin, tokencount,
    winnow,
)

QUERIES = {
    "op1_simhash": simhash.op1_simhash,
    "op2_winnowing": winnow.op2_winnowing,
    "op3_token_ids": tokenbin.op3_token_ids,
    "op4_langid": langid.op4_langid,
    "op5_pfair": pfair.op5_pfair,
    "op6_linedup": linedup.op6_linedup,
    "op7_quotes": quotes.op7_quotes,
    "op8_pu": pu.op8_pu,
    "op9_tagpath": tagpath.op9_tagpath,
    "op10_superminhash": superminhash.op10_superminhash,
    "op11_conversation_repair": convrepair.op11_conversation_repair,
    "op12_periodic_runs": periodic.op12_periodic_runs,
    "op13_token_counts": tokencount.op13_token_counts,
}

ORACLE: dict[str, str] = {}
