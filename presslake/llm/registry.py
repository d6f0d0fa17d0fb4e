"""Queries of this package and the SQL that must give the same rows, by name."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from presslake import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
MODULES = [
    "rule_cascade", "power_packing", "id_shards", "pii", "trie_dedup", "simhash", "mixing", "toxicity", "tool_links", "suffix_dedup",
    "periodic_runs", "tile_search", "turn_repair",
]


def query(name: str, oracle: str | None = None):
    """Register ``(spark, sf_dir) -> DataFrame``; ``oracle`` is SQL for the same rows, where SQL can give them."""
    def add(run):
        QUERIES[name] = lambda spark, sf_dir: run(configure(spark), sf_dir)
        if oracle is not None:
            ORACLES[name] = oracle
        return run
    return add


def all_queries():
    for module in MODULES:
        import_module(f"presslake.llm.{module}")
    return dict(QUERIES), dict(ORACLES)
