"""Pairs every query with its DuckDB oracle."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from annotspark import fixtures

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
_MODULES = ("features", "intervals", "sequences", "hits", "expression", "evaluation", "text", "formats", "hierarchy", "repair", "more", "readers", "statistics", "evidence", "outputs")


def query(name: str, views: str = "", oracle: str | None = None):
    """Register ``f(*views) -> DataFrame`` under ``name``; ``views`` names its inputs, blank separated."""

    def wrap(f):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: f(*[fixtures.table(spark, sf_dir, v) for v in views.split()])
        if oracle:
            ORACLES[name] = fixtures.oracle(oracle)
        return f

    return wrap


def load() -> None:
    for m in _MODULES:
        importlib.import_module(f"annotspark.plans.{m}")
