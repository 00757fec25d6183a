"""Scalar column functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ISO-8601 duration parts read by the catalog cleaner.
HOURS_PATTERN = r"(\d+)H"
MINUTES_PATTERN = r"(\d+)M"
# Fixed value: marker of an image URL.
IMAGE_PREFIX = "http"
# Fixed value: text written for a missing value in the compatible writer.
NONE_TEXT = "None"

# Similarities are rounded to this many places before ranking so that
# engines summing in a different order still agree on ranks.
SIM_SCALE = 9


def _part(c: Column, pattern: str) -> Column:
    # An empty match is '' and casts to NULL with try_cast (a plain cast
    # raises under ANSI mode); a missing part then counts as 0.
    return F.coalesce(F.regexp_extract(c, pattern, 1).try_cast("int"), F.lit(0))


def duration_minutes(c: Column | str) -> Column:
    """``PT1H30M`` → 90.  Missing part or missing text is 0; days and
    seconds are ignored.  A total beyond the int range is NULL rather than
    an ANSI overflow error (the catalog cleaner then fills it with 0)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.try_add(F.try_multiply(_part(c, HOURS_PATTERN), F.lit(60)),
                     _part(c, MINUTES_PATTERN)).alias("time")


def array_size_or_zero(c: Column | str) -> Column:
    """Number of elements, 0 for a NULL array."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNull(), F.lit(0)).otherwise(F.size(c))


def text_length(c: Column | str) -> Column:
    """Character length; NULL stays NULL."""
    return F.length(c)


def first_element(c: Column | str) -> Column:
    """First element of an array; NULL when the array is NULL or empty."""
    c = F.col(c) if isinstance(c, str) else c
    return F.get(c, 0)


def has_image(c: Column | str) -> Column:
    """P10: true when the value is a URL text."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.startswith(IMAGE_PREFIX), F.lit(False))


def is_ascii_digits(c: Column | str) -> Column:
    """Text made only of ASCII digits (blank and NULL are not)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.rlike(r"^[0-9]+\z"), F.lit(False))


def dot(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Dot product of two equally long coordinate lists.

    Written as a flat sum of products (left to right) so it compiles into
    the surrounding codegen stage instead of a higher-order function.
    """
    if len(a) != len(b):
        raise ValueError("dot: length mismatch")
    terms = [x * y for x, y in zip(a, b)]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def round_sim(c: Column) -> Column:
    return F.round(c, SIM_SCALE)


def missing_flag(c: str, dtype: T.DataType) -> Column:
    """NULL, or NaN for floating types (``isnan`` of text raises, D8)."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.col(c).isNull() | F.isnan(F.col(c))
    return F.col(c).isNull()


def as_text(c: Column | str) -> Column:
    """Text form with NULL written as ``None``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit(NONE_TEXT))
