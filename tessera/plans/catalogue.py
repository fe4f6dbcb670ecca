"""All queries over the driver's tables, with the SQL that must give the same rows."""

from __future__ import annotations

from importlib import import_module

MODULES = ["graph", "connectome", "skeletons", "volumes", "chunked"]


def _all(kind: str) -> dict:
    return {k: v for name in MODULES for k, v in getattr(import_module(f"tessera.plans.{name}"), kind).items()}


def queries() -> dict:
    return _all("QUERIES")


def oracle_sql() -> dict:
    return _all("ORACLE")
