"""The queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from concord.llm import chat, decontaminate, exact, licences, mixing, near, negatives, packing, passages, secrets, spelling, tokens, toxicity
from concord.llm.frames import shipped

_QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_secrets": secrets.op3_secrets,
    "op4_ngram_jaccard": near.op4_ngram_jaccard,
    "op5_chat": chat.op5_chat,
    "op6_token_counts": tokens.op6_token_counts,
    "op7_substring_dedup": passages.op7_substring_dedup,
    "op8_decontaminate": decontaminate.op8_decontaminate,
    "op9_exact_dedup": exact.op9_exact_dedup,
    "op10_licences": licences.op10_licences,
    "op11_hard_negatives": negatives.op11_hard_negatives,
    "op12_spelling": spelling.op12_spelling,
    "op13_packing": packing.op13_packing,
}

QUERIES = {name: shipped(query) for name, query in _QUERIES.items()}

ORACLES = {
    "op3_secrets": secrets.OP3_SQL,
    "op4_ngram_jaccard": near.OP4_SQL,
    "op5_chat": chat.OP5_SQL,
    "op8_decontaminate": decontaminate.OP8_SQL,
    "op9_exact_dedup": exact.OP9_SQL,
    "op11_hard_negatives": negatives.OP11_SQL,
    "op12_spelling": spelling.OP12_SQL,
}
