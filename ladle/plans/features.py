"""Feature queries: author profile (A1), vectors (M1–M6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladle.operators import clean as C
from ladle.operators import features as FT
from ladle.plans.registry import query
from ladle.plans.sql_shapes import features_sql, round_cols, unit_vector_sql
from ladle.sources.tables import fixture, with_fixtures

def _profile_sql() -> str:
    parts = []
    for name, src in FT.AUTHOR_ATTRIBUTES.items():
        parts.append("count(*) as review_count" if src is None else f"avg({src}) as {name}")
    return f", profile as (select authorid, {', '.join(parts)} from features group by authorid)\n"


def _features(spark, sf, reviews="reviews"):
    return C.review_features(fixture(spark, sf, reviews), fixture(spark, sf, "recipes"))


def _rounded(df, keep):
    return df.select(*[F.round(c, 6).alias(c) if c not in keep else F.col(c) for c in df.columns])


@query("author_profile", oracle=with_fixtures(features_sql("reviews") + _profile_sql() + "select "
       + ", ".join(["authorid", "review_count"]
                   + [f"round({c}, 6) as {c}" for c in FT.AUTHOR_VECTOR_COLUMNS if c != "review_count"])
       + " from profile", "recipes", "reviews"))
def author_profile(spark, sf):
    return _rounded(FT.author_profile(_features(spark, sf)), {"authorid", "review_count"})


@query("author_vectors", oracle=with_fixtures(
    features_sql("reviews") + _profile_sql()
    + ", profile0 as (select * replace (coalesce(avg_reviewlength, 0) as avg_reviewlength) from profile)\n"
    + unit_vector_sql("av", "profile0", ["authorid"], FT.AUTHOR_VECTOR_COLUMNS)
    + f"select authorid, {round_cols('u', 10)} from av", "recipes", "reviews"))
def author_vectors(spark, sf):
    vec = FT.author_vectors(FT.author_profile(_features(spark, sf)))
    return FT.explode_vector(vec.select("authorid", "authorfeatures"), "authorfeatures", 10)


@query("recipe_vectors", oracle=with_fixtures(
    features_sql("reviews")
    + unit_vector_sql("cv", "clean_recipes", ["recipeid"], FT.RECIPE_VECTOR_COLUMNS)
    + f"select recipeid, {round_cols('u', 8)} from cv", "recipes", "reviews"))
def recipe_vectors(spark, sf):
    rec = C.clean_recipes(fixture(spark, sf, "recipes"))
    vec = FT.unit_vectors(rec, FT.RECIPE_VECTOR_COLUMNS)
    return FT.explode_vector(vec.select("recipeid", "normfeatures"), "normfeatures", 8)


def _review_vectors_sql(reviews):
    return with_fixtures(features_sql(reviews) + unit_vector_sql("qv", "features", ["review_id"], FT.RECIPE_VECTOR_COLUMNS)
                         + f"select review_id, {round_cols('u', 8)} from qv", "recipes", reviews)


def _review_vectors(spark, sf, reviews):
    vec = FT.unit_vectors(_features(spark, sf, reviews), FT.RECIPE_VECTOR_COLUMNS)
    return FT.explode_vector(vec.select("review_id", "normfeatures"), "normfeatures", 8)


@query("review_vectors", oracle=_review_vectors_sql("review_log"))
def review_vectors(spark, sf):
    return _review_vectors(spark, sf, "review_log")


@query("review_vectors_reviews", oracle=_review_vectors_sql("reviews"))
def review_vectors_reviews(spark, sf):
    return _review_vectors(spark, sf, "reviews")
