"""Registered queries: one Spark plan per operator of the inventory, each
paired (where SQL can express it) with an oracle text for DuckDB."""

from ladle.plans.registry import oracle_sql, queries  # noqa: F401
