"""One row of each group where nothing in the rows tells them apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.session import materialize


def one_of_each(rows: DataFrame, keys: list[str], label: str) -> DataFrame:
    """``row.*`` of one of the rows (``row``, ``keys``) of each group: the one
    with the smallest number.

    The unique numbers are written with the rows, so every later read sees the
    same ones.  A group meets as partial minima and the rows by their numbers,
    so a group of any size is spread over all tasks."""
    numbered = materialize(rows.select("row", *keys, F.monotonically_increasing_id().alias("number")), label)
    first = numbered.groupBy(*keys).agg(F.min("number").alias("number")).select("number")
    others = materialize(numbered.select("number").join(first, "number", "left_anti"), f"{label}-others")
    if not others.isEmpty():
        numbered = numbered.join(others, "number", "left_anti")
    return numbered.select("row.*")
