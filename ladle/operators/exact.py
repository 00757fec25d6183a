"""Means and deviations that do not depend on the order of addition.

A sum of doubles changes in its last bits with the partitioning.  Here every
value becomes an integer first (scaled by ``10 ** scale``, halves away from
zero), and counts, sums and sums of squares are exact integers: decimals of 38
digits that merge map-side in any order.  Only the last step divides, so two
runs over any partitioning agree in every bit and no report needs rounding.

The sums of 10^12 values below 10^9 in size have 21 digits, their squares 30;
beyond 38 digits the sum is NULL, never wrong.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WIDE = "decimal(38,0)"


def scaled(c: Column, scale: int = 0) -> Column:
    """The value times ``10 ** scale`` as an integer decimal; NaN and infinities become NULL."""
    return F.round(c.try_cast(f"decimal(38,{min(scale + 6, 18)})") * F.lit(10 ** scale).cast("decimal(19,0)"), 0).try_cast(_WIDE)


def _sums(c: Column, scale: int, name: str) -> list[Column]:
    x = scaled(c, scale)
    return [F.count(x).alias(f"n_{name}"), F.sum(x).alias(f"s_{name}"), F.sum((x * x).cast(_WIDE)).alias(f"q_{name}")]


def sums(df: DataFrame, columns: dict[str, int], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, n_c, s_c, q_c for every column c): count, sum and sum of squares
    of the scaled values, a state that merges by adding (``merged``)."""
    return df.groupBy(*keys).agg(*[a for c, scale in columns.items() for a in _sums(F.col(c), scale, c)])


def merged(states: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """The union of ``sums`` states as one."""
    adds = [F.sum(f"{p}_{c}").cast("long" if p == "n" else _WIDE).alias(f"{p}_{c}") for c in columns for p in "nsq"]
    return states.groupBy(*keys).agg(*adds)


def mean(state_column: str, scale: int = 0) -> Column:
    """The mean of a column of a state; NULL without values."""
    return F.col(f"s_{state_column}").cast("double") / F.col(f"n_{state_column}").cast("double") / F.lit(float(10 ** scale))


def deviation(state_column: str, scale: int = 0) -> Column:
    """The sample standard deviation: n q - s s is an exact integer; NULL below two values."""
    n, s, q = (F.col(f"{p}_{state_column}").cast(_WIDE) for p in "nsq")
    spread = ((n * q).cast(_WIDE) - (s * s).cast(_WIDE)).cast("double")
    pairs = F.col(f"n_{state_column}").cast("double") * (F.col(f"n_{state_column}") - 1).cast("double")
    return F.when(F.col(f"n_{state_column}") > 1, F.sqrt(spread / pairs) / F.lit(float(10 ** scale)))


def describe_exact(df: DataFrame, columns: dict[str, int]) -> DataFrame:
    """A7 unrounded: (column_name, count, mean, stddev) of every column, scaled as given."""
    one = sums(df, columns)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"n_{c}").alias("count"), mean(c, k).alias("mean"),
                     deviation(c, k).alias("stddev")) for c, k in columns.items()]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def means_exact(df: DataFrame, key: str, value: str, scale: int = 0) -> DataFrame:
    """A3 unrounded: (key, n, mean) for every key, NULL a key of its own."""
    return sums(df, {value: scale}, [key]).select(key, F.col(f"n_{value}").alias("n"), mean(value, scale).alias("mean"))
