"""Next-recipe test-set queries."""

from __future__ import annotations

from ladle.operators import clean as C
from ladle.operators import sequence as SQ
from ladle.plans.registry import query
from ladle.plans.sql_shapes import features_sql, next_recipe_sql
from ladle.session import materialize
from ladle.sources.tables import fixture, with_fixtures

_COLS = ["review_id", "authorid", "recipeid", "datesubmitted", "rating"]


def _features(spark, sf, reviews):
    return C.review_features(fixture(spark, sf, reviews), fixture(spark, sf, "recipes"))


def _sampled(spark, sf, reviews, n):
    # Read by several passes of the sample: the log meets the catalog once,
    # and the columns that the passes need are written to the shared folder.
    feats = materialize(_features(spark, sf, reviews).select(*_COLS), "review-features")
    return SQ.next_item_sample(feats, n).select(*_COLS, "nextrecipeid")


def _sel(cols):
    return ", ".join(cols)


@query("frequent_authors", oracle=with_fixtures(features_sql("reviews") + next_recipe_sql("features")
                                                 + f"select {_sel(_COLS)} from freq_rows",
                                                 "recipes", "reviews"))
def frequent_authors(spark, sf):
    return SQ.frequent_key_rows(_features(spark, sf, "reviews")).select(*_COLS)


@query("drop_latest", oracle=with_fixtures(features_sql("reviews") + next_recipe_sql("features")
                                            + f"select {_sel(_COLS)} from kept",
                                            "recipes", "reviews"))
def drop_latest(spark, sf):
    feats = _features(spark, sf, "reviews")
    counts = SQ.key_counts(feats)
    return SQ.drop_latest(SQ.frequent_key_rows(feats, counts=counts), counts=counts).select(*_COLS)


@query("next_recipe", oracle=with_fixtures(features_sql("reviews") + next_recipe_sql("features")
                                            + f"select {_sel(_COLS)}, nextrecipeid from seq",
                                            "recipes", "reviews"))
def next_recipe(spark, sf):
    feats = _features(spark, sf, "reviews")
    counts = SQ.key_counts(feats)  # one author count feeds both filters
    f = SQ.frequent_key_rows(feats, counts=counts)
    return SQ.next_item(f, counts=counts).select(*_COLS, "nextrecipeid")


@query("next_recipe_holdout", oracle=with_fixtures(
    features_sql("reviews") + next_recipe_sql("features", holdout=True)
    + f"select {_sel(_COLS)}, nextrecipeid from seq", "recipes", "reviews"))
def next_recipe_holdout(spark, sf):
    feats = _features(spark, sf, "reviews")
    counts = SQ.key_counts(feats)
    f = SQ.frequent_key_rows(feats, counts=counts)
    return SQ.next_item(f, holdout=True, counts=counts).select(*_COLS, "nextrecipeid")


@query("next_recipe_log", oracle=with_fixtures(features_sql("review_log") + next_recipe_sql("features")
                                                + f"select {_sel(_COLS)}, nextrecipeid from seq",
                                                "recipes", "review_log"))
def next_recipe_log(spark, sf):
    feats = _features(spark, sf, "review_log")
    counts = SQ.key_counts(feats)
    f = SQ.frequent_key_rows(feats, counts=counts)
    return SQ.next_item(f, counts=counts).select(*_COLS, "nextrecipeid")


@query("next_recipe_sample", oracle=with_fixtures(
    features_sql("review_log") + next_recipe_sql("features")
    + f"""select {_sel(_COLS)}, nextrecipeid from seq
order by md5('7-' || cast(review_id as varchar)), review_id limit 50""", "recipes", "review_log"))
def next_recipe_sample(spark, sf):
    return _sampled(spark, sf, "review_log", 50)


# A sample too large to be paired with all later rows: next items by sorted ranges.
LARGE_SAMPLE = 5_000


@query("next_recipe_sample_large", oracle=with_fixtures(
    features_sql("reviews") + next_recipe_sql("features")
    + f"""select {_sel(_COLS)}, nextrecipeid from seq
order by md5('7-' || cast(review_id as varchar)), review_id limit {LARGE_SAMPLE}""", "recipes", "reviews"))
def next_recipe_sample_large(spark, sf):
    return _sampled(spark, sf, "reviews", LARGE_SAMPLE)
