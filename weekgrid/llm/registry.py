"""Queries of this subpackage by name, and SQL for those that SQL can express."""

from __future__ import annotations

import importlib

OPERATORS = {
    "op1_substring_dedup": "substrings",
    "op2_secret_scan": "secret_scan",
    "op3_language_id": "language",
    "op4_packing": "packing",
    "op5_jaccard_join": "jaccard",
    "op6_token_counts": "pieces",
    "op7_embedding_dedup": "embeddings",
    "op8_chat_rotation": "chat",
    "op9_winnowing": "winnowing",
    "op10_byte_bpe": "bpe_tree",
    "op11_merkle_manifest": "merkle",
    "op12_exact_topk": "topk",
    "op13_whitening": "whitening",
}


def _module(name: str):
    return importlib.import_module(f"weekgrid.llm.{OPERATORS[name]}")


def queries() -> dict:
    return {name: getattr(_module(name), name) for name in OPERATORS}


def sql() -> dict[str, str]:
    found = {name: getattr(_module(name), "ORACLE_SQL", None) for name in OPERATORS}
    return {name: text for name, text in found.items() if text}
