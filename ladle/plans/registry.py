"""Query registry.

``@query(name, oracle=...)`` registers a callable ``(spark, sf_dir) ->
DataFrame``.  The oracle is the same question asked in plain SQL over the
driver's views (fixtures become CTEs); queries without an oracle get a
rows-only check plus invariant tests.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}

_MODULES = ("ladle.plans.storefront", "ladle.plans.cleaning", "ladle.plans.eda",
            "ladle.plans.features", "ladle.plans.sequence", "ladle.plans.neighbours",
            "ladle.plans.recommend")


def query(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLE[name] = oracle
        return fn
    return deco


def _load() -> None:
    for m in _MODULES:
        importlib.import_module(m)


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLE)
