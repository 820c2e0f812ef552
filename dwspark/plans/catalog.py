"""Registered queries: each operator of the inventory run on the driver tables, next to the DuckDB SQL
that computes the same result (the correctness oracle).

Names start with the inventory ID in lower case. Every query reads whole tables (no sampling, no
key subsets); where the SQL needs messy text, it renders the same text from the same columns as
:mod:`dwspark.plans.derive`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from dwspark.session import read_tables

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[dict[str, DataFrame]], DataFrame]
    sql: str | None
    headline: bool = False

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(read_tables(spark, sf_dir))


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None, headline: bool = False):
    def wrap(fn: Callable[[dict[str, DataFrame]], DataFrame]):
        REGISTRY[name] = Query(name, fn, sql.strip() if sql else None, headline)
        return fn

    return wrap


def _load() -> None:
    # Import the modules that register queries (kept apart by topic).
    import importlib

    for mod in ("queries_warehouse", "queries_quality", "queries_pipelines", "queries_changes", "queries_model"):
        importlib.import_module(f"dwspark.plans.{mod}")


def queries() -> dict[str, QueryFn]:
    _load()
    return {name: q.run for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {name: q.sql for name, q in REGISTRY.items() if q.sql}
