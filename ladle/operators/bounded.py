"""Broadcast only what has a checked size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladle.session import materialize

# A side whose row count is bounded by a limit parameter is broadcast
# only while the bound stays below this many rows.
MAX_BROADCAST_ROWS = 100_000
# A measured side is broadcast up to this many bytes.
MAX_BROADCAST_BYTES = 64 << 20


def broadcast_bounded(df: DataFrame, bound: int, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when ``bound`` (a limit the caller imposed on
    ``df``) is small enough; otherwise leave the choice to AQE, which
    picks a shuffled join from runtime sizes."""
    return F.broadcast(df) if bound <= max_rows else df


def _bytes(name: str, kind: T.DataType) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        held = F.octet_length(c)
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.NumericType, T.BooleanType)):
        held = F.when(c.isNotNull(), 8 * F.size(c))
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        held = F.octet_length(F.to_json(F.struct(c)))
    else:
        held = F.lit(8)
    return F.coalesce(held, F.lit(0))


def size_in_bytes(df: DataFrame) -> int:
    """Bytes of ``df``'s rows (one distributed aggregate): the length of texts,
    eight a number, the JSON text of nested values, and a row header."""
    row = sum((_bytes(f.name, f.dataType) for f in df.schema.fields), F.lit(16))
    return df.agg(F.sum(row.cast("long"))).first()[0] or 0


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES, pin: bool = False) -> DataFrame:
    """Broadcast ``df`` only after measuring its bytes; beyond the bound the
    join shuffles (AQE splits skewed partitions there), also where its files
    are so well compressed that Spark's estimate would broadcast it.

    ``pin=True`` is for a ``df`` that is expensive to compute: it is written
    once, and the check and the join both read that table."""
    if pin:
        df = materialize(df, "pinned")
    return F.broadcast(df) if size_in_bytes(df) <= max_bytes else df.hint("merge")
