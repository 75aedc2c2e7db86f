"""Every named query of the library, by name."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame

PLANS = ["products", "medallion", "incremental", "logs", "finops", "governance", "textual", "intelligence", "generators", "streams", "chained"]


def approximate() -> dict[str, Callable[..., DataFrame]]:
    """Queries without a SQL statement."""
    return dict(import_module("tallyloom.plans.textual").APPROXIMATE)


def all_queries() -> dict[str, Callable[..., DataFrame]]:
    """Queries with a SQL statement of the same rows."""
    found: dict[str, Callable[..., DataFrame]] = {}
    for name in PLANS:
        for key, build in import_module(f"tallyloom.plans.{name}").QUERIES.items():
            if key in found:
                raise ValueError(f"duplicate query {key}")
            found[key] = build
    return found
