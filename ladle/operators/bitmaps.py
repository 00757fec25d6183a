"""Exact distinct ids by mergeable bitmaps.

An integer id is one bit of a bucket's bitmap (32,768 ids a bucket, 4 KB), so
a set of ids is a small table (group, bucket, bits).  Two states of the same
groups merge by OR-ing the bitmaps bucket by bucket, in any order and as often
as one likes: the distinct count of a week is read off the states of its days,
without its log.  NULL is a member of its own (as ``distinct().count()`` has
it), kept as bucket NULL.

Bits are set map-side, so what is shuffled is at most one bitmap per task,
group and bucket, whatever the rows; a hot id is one bit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def id_state(rows: DataFrame, id_column: str, groups: Sequence[str] = ()) -> DataFrame:
    """(groups..., bucket, bits): the ids of ``id_column`` (any integer type,
    negative ones too).  Rows without an id set the bitmap of bucket NULL."""
    known = F.col(id_column).cast("long")
    # Spark's buckets count from 1 for positive ids and from 0 downwards for the rest: no two ids share a bit.
    return (rows.select(*groups, F.bitmap_bucket_number(known).alias("bucket"),
                        F.coalesce(F.bitmap_bit_position(known), F.lit(0)).alias("bit"))
            .groupBy(*groups, "bucket").agg(F.bitmap_construct_agg("bit").alias("bits")))


def merged(states: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """States of the same shape (one union of them) as one; finer groups than
    ``groups`` are merged away."""
    return states.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_count(state: DataFrame, groups: Sequence[str] = (), name: str = "value") -> DataFrame:
    """(groups..., name): the number of distinct ids, NULL as one of them."""
    return state.groupBy(*groups).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias(name))


def first_seen(state: DataFrame, period: str) -> DataFrame:
    """(bucket, bit, period): every id once, with the first period that holds it."""
    # A byte of the bitmap holds eight ids; only set bits leave it.
    size = 4096
    byte = F.conv(F.hex(F.substring("bits", F.col("at") + 1, F.lit(1))), 16, 10).cast("int")
    bytes_ = (state.select(period, "bucket", "bits", F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("at"))
              .select(period, "bucket", "at", byte.alias("byte")).where("byte > 0"))
    bits = F.filter(F.sequence(F.lit(0), F.lit(7)), lambda i: F.expr("byte").bitwiseAND(F.call_function("shiftleft", F.lit(1), i)) != 0)
    return (bytes_.select(period, "bucket", (F.col("at") * 8).alias("base"), F.explode(bits).alias("i"))
            .groupBy("bucket", (F.col("base") + F.col("i")).alias("bit")).agg(F.min(period).alias(period)))


def new_per_period(state: DataFrame, period: str, name: str = "new_ids") -> DataFrame:
    """(period, name): how many ids each period is the first to hold, from the
    periods' states alone; periods without a new id are left out."""
    return first_seen(state, period).groupBy(period).agg(F.count(F.lit(1)).alias(name))
