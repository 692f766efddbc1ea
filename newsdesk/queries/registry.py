"""Name -> Spark query, and name -> SQL of the same result."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
MODULES = ("sources", "projections", "relations", "novelty", "aggregates", "ranking", "scalars", "corpus", "documents", "pages", "jobs", "committed")



def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without `sql` only its rows can be checked."""
    def add(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql.strip()
        return build

    return add


def load_all() -> None:
    for module in MODULES:
        import_module(f"newsdesk.queries.{module}")
