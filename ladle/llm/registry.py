"""Queries and oracles of the training-data operators.

Every operator module registers its thin ``opN_<name>`` query here.  The
modules are imported eagerly and import errors rise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE_SQL[name] = oracle
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load() -> None:
    from ladle.llm import (decontaminate, exact_dedup, mixing, packing, pii, prefix_trie, quality, secrets,  # noqa: F401
                           simhash, substring_dedup, token_alignment, token_counts, warc)


def queries() -> dict[str, QueryFn]:
    load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load()
    return dict(ORACLE_SQL)
