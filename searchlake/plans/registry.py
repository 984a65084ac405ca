"""Registry of named, runnable queries: one per inventory row, each with its oracle SQL.

A query is ``fn(spark, sf_dir) -> DataFrame`` reading the given tables (or data Spark
derives from them). ``sql`` is the equivalent DuckDB SQL over the same tables, or ``None``
when no SQL twin exists (hash functions without a DuckDB counterpart, streaming, UDFs).
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load_all():
    """Import every catalog module (each registers its queries on import)."""
    import importlib

    for mod in CATALOGS:
        importlib.import_module(f"searchlake.plans.{mod}")
    return QUERIES, ORACLE


CATALOGS = ["catalog_core", "catalog_text", "catalog_ingest", "catalog_functions", "catalog_misc", "catalog_more", "catalog_streams", "catalog_entries"]
