"""Registry of named queries over the driver tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` calls the library operators on
role tables bound in ``bindings``; ``ORACLE[name]`` is the equivalent SQL
(DuckDB dialect) over the same tables, when one exists.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def load_all() -> None:
    """Import the query modules (they register on import)."""
    from propspark.plans import q_geo, q_listings, q_misc, q_pipeline, q_sales  # noqa: F401
