"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from importlib import import_module

#: Modules with QUERIES and ORACLES, in the order of the operators.
MODULES = [
    "bpe",
    "warc",
    "token_counts",
    "html_extract",
    "embedding_dedup",
    "url_filter",
    "quality_rules",
    "license_scan",
    "mixing",
    "minhash_dedup",
    "quality_classifier",
    "conversation_repair",
    "token_alignment",
]


def queries() -> dict:
    return {k: f for m in MODULES for k, f in import_module(f"fernweave.llm.{m}").QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in import_module(f"fernweave.llm.{m}").ORACLES.items()}
