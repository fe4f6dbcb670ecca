"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = ["rans", "pack", "mixing", "exact_dedup", "audio", "quality", "privacy", "urls", "warc", "near_dedup", "merkle", "count_join", "filter_audit"]


def _all(kind: str) -> dict:
    return {k: v for name in MODULES for k, v in getattr(import_module(f"tessera.llm.{name}"), kind).items()}


def queries() -> dict:
    return _all("QUERIES")


def oracle_sql() -> dict:
    return _all("ORACLE")
