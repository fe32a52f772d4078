"""Query catalogue: name -> (Spark builder, DuckDB oracle SQL or None).

Each plan module registers its queries with :func:`register`. A builder takes
``(spark, sf_dir)`` and returns a DataFrame over the given tables (or data
Spark derives from them); the oracle SQL runs on the same tables in DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from aurum.plans.oracle_sources import source_ctes

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    name: str
    build: Builder
    sql: str | None  # body after the shared source CTEs; None = rows-only check
    ids: str = ""


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None = None, ids: str = ""):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql, ids)
        return fn
    return deco


def full_sql(body: str) -> str:
    """Prefix an oracle body (which starts with ``name AS (...)`` CTEs or a
    ``SELECT``) with the derived-source CTEs."""
    body = body.strip()
    if body.upper().startswith("SELECT"):
        return "WITH RECURSIVE " + source_ctes() + "\n" + body
    return "WITH RECURSIVE " + source_ctes() + ",\n" + body


def load_all() -> dict[str, Entry]:
    # importing the plan modules fills the registry
    from aurum.plans import queries_sources, ssn_first, pairwise, nrt, reports, damaged, queries_files, streaming_queries  # noqa: F401
    return REGISTRY
