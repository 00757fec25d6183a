"""Exploratory report over the review log and the catalog (Q1–Q3).

Each report line is its own DataFrame.  Counts and sums are computed per
key with partial (map-side) aggregation, so hot keys never gather in one
task; joined reports aggregate reviews per recipe first and join only the
per-recipe totals with the catalog.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.functions.columns import missing_flag


def _top(df: DataFrame, key: str, value: str, n: int) -> DataFrame:
    return df.orderBy(F.desc(value), F.asc_nulls_first(key)).limit(n)


def rating_hist(reviews: DataFrame) -> DataFrame:
    """A2 + L2: reviews per rating value, ordered by rating."""
    return reviews.groupBy("rating").agg(F.count(F.lit(1)).alias("count")).orderBy("rating")


def key_counts(df: DataFrame, key: str, n: int = 20) -> DataFrame:
    """A2 + L1: the ``n`` keys with most rows (NULL is a key of its own)."""
    return _top(df.groupBy(key).agg(F.count(F.lit(1)).alias("count")), key, "count", n)


def describe_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample stddev, min, max per column, one row each,
    typed as doubles (``describe`` returns text).  One aggregation pass
    computes all of them; ``stack`` turns the single row into one row per
    column."""
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    # Mean and stddev are reported to 6 places (engines differ in the last bits).
    args = ", ".join(f"'{c}', n{i}, round(m{i}, 6), round(s{i}, 6), lo{i}, hi{i}"
                     for i, c in enumerate(columns))
    return df.agg(*aggs).selectExpr(
        f"stack({len(columns)}, {args}) as (column_name, count, mean, stddev, min, max)")


def distinct_counts(reviews: DataFrame) -> DataFrame:
    """A4 + A5: number of ratings, rated recipes and authors.

    Like ``distinct().count()``, NULL counts as one value: ``groupBy`` keeps
    the NULL group.  Each distinct count is its own grouped aggregate
    (map-side de-duplication per partition) rather than one Expand-based
    multi-distinct aggregate.
    """
    n_rows = reviews.agg(F.count(F.lit(1)).alias("value")).select(F.lit("n_ratings").alias("metric"), "value")

    def n_distinct(key: str, label: str) -> DataFrame:
        return (reviews.groupBy(key).agg(F.lit(1).alias("_one"))
                .agg(F.count(F.lit(1)).alias("value"))
                .select(F.lit(label).alias("metric"), "value"))

    return n_rows.unionByName(n_distinct("recipeid", "n_recipes")).unionByName(
        n_distinct("authorid", "n_authors"))


def missing_counts(df: DataFrame, nan_only: bool = False) -> DataFrame:
    """Per column, rows that are NULL (or NaN for floating types);
    one pass, one row.

    ``nan_only=True`` gives the numbers of the original report, which
    counted ``when(missing, c)``: ``count`` skips the NULL that expression
    returns for a NULL cell, so only NaN cells were ever counted."""
    def flag(f):
        if nan_only:
            return missing_flag(f.name, f.dataType) & F.col(f.name).isNotNull()
        return missing_flag(f.name, f.dataType)
    return df.select([F.count(F.when(flag(f), F.lit(1))).alias(f.name) for f in df.schema.fields])


def _per_recipe(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("recipeid").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("rating").alias("_sum"),
        F.count("rating").alias("_nr"))


def joined_counts(reviews: DataFrame, recipes: DataFrame, key: str, n: int = 5) -> DataFrame:
    """Q3 (J1 A2 L1): reviews per category / name after a left join with
    the catalog; orphan reviews form the NULL group."""
    j = _per_recipe(reviews).join(recipes.select("recipeid", key), "recipeid", "left")
    agg = j.groupBy(key).agg(F.sum("_n").alias("count"))
    return _top(agg, key, "count", n)


def joined_means(reviews: DataFrame, recipes: DataFrame, key: str, n: int = 5) -> DataFrame:
    """Q3 (J1 A3 L1): mean rating per category / name, best first."""
    j = _per_recipe(reviews).join(recipes.select("recipeid", key), "recipeid", "left")
    agg = j.groupBy(key).agg(
        (F.sum("_sum").cast("double") / F.sum("_nr")).alias("average_rating"))
    # Ranked on the exact mean, reported to 6 places.
    return _top(agg, key, "average_rating", n).withColumn(
        "average_rating", F.round("average_rating", 6))
