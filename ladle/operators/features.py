"""Feature vectors (M1–M6) and the author profile (A1).

Vectors are built with MLlib's ``VectorAssembler`` → ``StandardScaler``
(mean and sample std) → ``Normalizer(p=2)``.  Fitting the scaler is one
distributed summary pass; the fitted model is two short vectors the
transform ships to every task.  Vectors leave this module as
``array<double>`` so SQL functions can read them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Normalizer, StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.session import materialize

# Attribute order of the recipe vector.
RECIPE_VECTOR_COLUMNS = ["reviewcount", "calories", "fatcontent", "sodiumcontent",
                         "carbohydratecontent", "proteincontent", "instructionstep", "time"]
# Attributes of the author vector in order, each with the column
# it averages (None: the number of reviews).
AUTHOR_ATTRIBUTES = {
    "avg_rating": "rating", "avg_reviewlength": "reviewlength", "review_count": None,
    "avg_instructionlength": "instructionstep", "avg_time": "time", "avg_calories": "calories",
    "avg_fatcontent": "fatcontent", "avg_sodiumcontent": "sodiumcontent",
    "avg_carbohydratecontent": "carbohydratecontent", "avg_proteincontent": "proteincontent"}
AUTHOR_VECTOR_COLUMNS = list(AUTHOR_ATTRIBUTES)


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> StandardScalerModel:
    """M1 + M2 fit: mean and sample standard deviation of each column."""
    assembled = VectorAssembler(inputCols=list(columns), outputCol="_features").transform(
        df.select(*columns))
    return StandardScaler(inputCol="_features", outputCol="_scaled",
                          withMean=True, withStd=True).fit(assembled)


def apply_scaler(df: DataFrame, columns: Sequence[str], model: StandardScalerModel,
                 out: str = "normfeatures") -> DataFrame:
    """M1 → M2 → M3 with a fitted scaler; ``out`` is a unit (or zero)
    ``array<double>``.  A constant column scales to 0."""
    assembled = VectorAssembler(inputCols=list(columns), outputCol="_features").transform(df)
    scaled = model.transform(assembled)
    normed = Normalizer(inputCol="_scaled", outputCol="_norm", p=2.0).transform(scaled)
    return normed.withColumn(out, vector_to_array("_norm")).drop("_features", "_scaled", "_norm")


def unit_vectors(df: DataFrame, columns: Sequence[str], out: str = "normfeatures",
                 fit_on: DataFrame | None = None) -> DataFrame:
    """Fit the scaler on ``fit_on`` (default ``df``) and return ``df`` with
    standardised unit vectors."""
    model = fit_scaler(fit_on if fit_on is not None else df, columns)
    return apply_scaler(df, columns, model, out)


def author_profile(features: DataFrame) -> DataFrame:
    """A1: nine averages and the review count per author.  Partial
    aggregation per task first, so a prolific author is one row per task
    before the shuffle."""
    return features.groupBy("authorid").agg(*[
        (F.avg(source) if source else F.count(F.lit(1))).alias(name) for name, source in AUTHOR_ATTRIBUTES.items()])


def author_vectors(profile: DataFrame) -> DataFrame:
    """M6: author vectors from the profile.  An author none of whose reviews
    has text has a NULL mean length; it enters the vector as 0 (the
    assembler would reject a NULL)."""
    # The profile is read twice (scaler fit, transform) and costs a shuffle
    # of the review log to build: written once under the checkpoint dir.
    filled = materialize(profile.fillna(0, subset=["avg_reviewlength"]), "author-profile")
    return unit_vectors(filled, AUTHOR_VECTOR_COLUMNS, out="authorfeatures")


def explode_vector(df: DataFrame, vec: str, size: int, prefix: str = "v",
                   scale: int | None = 6) -> DataFrame:
    """Vector elements as columns ``v0 … v{size-1}`` (rounded for reports)."""
    cols = []
    for i in range(size):
        c = F.col(vec)[i]
        cols.append((F.round(c, scale) if scale is not None else c).alias(f"{prefix}{i}"))
    return df.select(*[c for c in df.columns if c != vec], *cols)
