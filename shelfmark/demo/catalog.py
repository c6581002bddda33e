"""Registry of demonstration queries and their check SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .views import VIEWS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, views: tuple[str, ...] = (), sql: str | None = None):
    """Registers a query; ``sql`` gives the same rows in DuckDB and may use the ``views``."""
    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ctes = ",\n".join(f"{v} as ({VIEWS[v]})" for v in views)
            CHECKS[name] = f"with {ctes}\n{sql}" if ctes else sql
        return run
    return register


def load() -> None:
    """Imports the modules that register queries."""
    from . import (  # noqa: F401
        change_queries, clean_queries, file_queries, link_queries, page_queries,
        profile_queries, stream_queries, value_queries,
    )
