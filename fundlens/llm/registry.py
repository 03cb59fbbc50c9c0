"""The llm queries and their SQL."""

from __future__ import annotations

import importlib

MODULES = ("name_queries", "scan_queries", "dedup_queries", "canon_queries", "packing_queries", "leak_queries", "sentence_queries")


def _all(kind: str) -> dict:
    """Of every module whose own imports are there: a missing tokenizer takes its queries away and no others."""
    out: dict = {}
    for m in MODULES:
        try:
            out |= getattr(importlib.import_module(f"fundlens.llm.{m}"), kind)
        except ImportError as e:
            if (e.name or "").startswith("fundlens"):
                raise
    return out


def queries() -> dict:
    return _all("QUERIES")


def oracle_sql() -> dict:
    return _all("ORACLES")
