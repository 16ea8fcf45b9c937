"""The registered queries of the subpackage, with SQL where SQL can express them."""

from __future__ import annotations

import importlib

#: query name -> (module, function); modules are imported when their query is built.
_QUERIES = {
    "op1_best_fit_packing": ("packing", "op1_best_fit_packing"),
    "op2_minhash_odd_sketches": ("neardup", "op2_minhash_odd_sketches"),
    "op3_personal_data": ("pii", "op3_personal_data"),
    "op4_exact_dedup": ("exactdup", "op4_exact_dedup"),
    "op5_warc_boundary_chain": ("warc", "op5_warc_boundary_chain"),
    "op6_mix_sources": ("mixing", "op6_mix_sources"),
    "op7_quality_rules": ("quality", "op7_quality_rules"),
    "op8_language_mixture": ("langid", "op8_language_mixture"),
    "op9_toxicity_chain": ("toxicity", "op9_toxicity_chain"),
    "op10_token_counts": ("tokens", "op10_token_counts"),
    "op11_flow_resharding": ("resharding", "op11_flow_resharding"),
    "op12_embedding_whitening": ("whitening", "op12_embedding_whitening"),
    "op13_conversation_trie": ("trie", "op13_conversation_trie"),
}


def _load(module: str, function: str):
    return getattr(importlib.import_module(f"{__package__}.{module}"), function)


def queries() -> dict:
    import corpus_pipeline

    return {name: _load(*at) for name, at in _QUERIES.items()} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op4_exact_dedup": _load("exactdup", "ORACLE_OP4"), "op5_warc_boundary_chain": _load("warc", "ORACLE_OP5"), "op7_quality_rules": _load("quality", "ORACLE_OP7"), "op13_conversation_trie": _load("trie", "ORACLE_OP13")}
