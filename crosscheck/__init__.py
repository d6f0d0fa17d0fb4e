"""Queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

MODULES = ["reports", "scalars", "upkeep", "texts", "stages"]


def all_cases() -> tuple[dict[str, Callable], dict[str, str]]:
    """Runnable queries and their SQL, by name."""
    from crosscheck import registry

    for module in MODULES:
        import_module(f"crosscheck.{module}")
    runs = {name: registry.runnable(query) for name, query in registry.QUERIES.items()}
    return runs, dict(registry.ORACLES)
