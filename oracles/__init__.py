"""ANSI SQL statements of the same results, for checking with DuckDB."""

from importlib import import_module

from oracles.bindings import bound

MODULES = ["products", "medallion", "incremental", "logs", "finops", "governance", "textual", "intelligence", "generators", "streams", "chained"]


def statements() -> dict[str, str]:
    return {k: bound(v) for m in MODULES for k, v in import_module(f"oracles.{m}").SQL.items()}
