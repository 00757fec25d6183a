"""Cleaning queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ladle.functions.columns import duration_minutes as dm
from ladle.functions.columns import first_element
from ladle.operators import clean as C
from ladle.plans.registry import query
from ladle.sources import files as IO
from ladle.sources.csv_ranges import read_csv_ranges
from ladle.session import ensure_checkpoint_dir
from ladle.sources.tables import fixture, with_fixtures

_TIME_SQL = """(coalesce(try_cast(nullif(regexp_extract(totaltime, '(\\d+)H', 1), '') as int), 0) * 60
  + coalesce(try_cast(nullif(regexp_extract(totaltime, '(\\d+)M', 1), '') as int), 0))"""

_CLEAN_RECIPES_SQL = f"""
, clean_recipes as (
  select coalesce(recipeid, 0) as recipeid, name,
         coalesce(reviewcount, 0) as reviewcount, coalesce(calories, 0) as calories,
         coalesce(fatcontent, 0) as fatcontent, coalesce(sodiumcontent, 0) as sodiumcontent,
         coalesce(carbohydratecontent, 0) as carbohydratecontent,
         coalesce(proteincontent, 0) as proteincontent,
         cast(coalesce(len(recipeinstructions), 0) as int) as instructionstep,
         cast({_TIME_SQL} as int) as time
  from recipes)
"""

_FEATURES_SQL = _CLEAN_RECIPES_SQL + """
, features as (
  select r.recipeid, r.review_id, r.authorid, r.rating, r.datesubmitted,
         cast(length(r.review) as int) as reviewlength,
         c.name, c.reviewcount, c.calories, c.fatcontent, c.sodiumcontent,
         c.carbohydratecontent, c.proteincontent, c.instructionstep, c.time
  from reviews r join clean_recipes c on r.recipeid = c.recipeid)
"""


@query("duration_minutes", oracle=with_fixtures(f"""
select recipeid, totaltime, cast({_TIME_SQL} as int) as time from recipes
""", "recipes"))
def duration_minutes(spark, sf):
    r = fixture(spark, sf, "recipes")
    return r.select("recipeid", "totaltime", dm("totaltime").alias("time"))


@query("fill_missing", oracle=with_fixtures(_CLEAN_RECIPES_SQL + "select * from clean_recipes",
                                             "recipes"))
def fill_missing(spark, sf):
    return C.clean_recipes(fixture(spark, sf, "recipes"))


@query("review_features", oracle=with_fixtures(_FEATURES_SQL + "select * from features",
                                                "recipes", "reviews"))
def review_features(spark, sf):
    return C.review_features(fixture(spark, sf, "reviews"), fixture(spark, sf, "recipes"))


@query("source_profile", oracle="""
select 'part' as table_name, count(*) as row_count, cast(6 as bigint) as column_count from part
union all
select 'lineitem', count(*), cast(11 as bigint) from lineitem
""")
def source_profile(spark, sf):
    # S1 + S5 + S7 over the raw driver files.
    part = IO.read_parquet(spark, f"{sf}/part.parquet")
    line = IO.read_parquet(spark, f"{sf}/lineitem.parquet")
    return IO.source_profile(part, "part").unionByName(IO.source_profile(line, "lineitem"))


@query("rating_columns", oracle=with_fixtures("select recipeid, authorid, rating from reviews", "reviews"))
def rating_columns(spark, sf):
    # The rating job's load-time projection of the review log.
    return IO.project(fixture(spark, sf, "reviews"), [c.upper() for c in IO.RATING_COLUMNS])


@query("label_columns", oracle=with_fixtures("select recipeid, name, recipecategory from recipes", "recipes"))
def label_columns(spark, sf):
    # The rating job's projection of the catalog.
    return IO.project(fixture(spark, sf, "recipes"), IO.RECIPE_LABEL_COLUMNS)


@query("load_projection", oracle="""
select cast(p_partkey as int) as p_partkey, p_name, p_type from part
""")
def load_projection(spark, sf):
    # S4 + S5 + S6: upper-case request, lower-case result, integer key.
    return IO.read_parquet(spark, f"{sf}/part.parquet", ["P_PARTKEY", "P_Name", "p_type"],
                           key="p_partkey")


_ARRAYS = {"images": "Images", "recipeingredientparts": "RecipeIngredientParts",
           "recipeingredientquantities": "RecipeIngredientQuantities", "recipeinstructions": "RecipeInstructions"}


def _r_vector(name):
    """An array as the app's CSV export holds it: ``c("a", NA)``,
    ``character(0)`` when empty.  The element "1" is written as NA, so that
    missing elements are part of the test."""
    arr = F.col(name)
    each = F.transform(arr, lambda x: F.when(x == "1", F.lit("NA")).otherwise(F.concat(F.lit('"'), x, F.lit('"'))))
    return (F.when(arr.isNull(), F.lit(None).cast("string"))
            .when(F.size(arr) == 0, F.lit("character(0)"))
            .otherwise(F.concat(F.lit("c("), F.array_join(each, ", "), F.lit(")"))))


def _export(spark, df, label) -> str:
    """A header CSV with RFC 4180 quoting under the checkpoint directory."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ladle-tables/{label}-csv-{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def _listed(name):
    """An array as text, missing elements shown."""
    return F.array_join(F.transform(name, lambda x: F.coalesce(x, F.lit("<NA>"))), "|").alias(name)


def _listed_sql(name):
    return (f"array_to_string(list_transform({name}, lambda x: case when x = '1' then '<NA>' else x end), '|') "
            f"as {name}")


@query("csv_catalog", oracle=with_fixtures(f"""
select recipeid, name, recipecategory, images[1] as first_image, {', '.join(map(_listed_sql, _ARRAYS))} from recipes
""", "recipes"))
def csv_catalog(spark, sf):
    # S2 + S5 + S6 + P6 + D10: header CSV scan with an explicit schema,
    # lower-cased names, array texts with NA elements parsed on the executors.
    r = fixture(spark, sf, "recipes")
    path = _export(spark, r.select(F.col("recipeid").alias("RecipeId"), F.col("name").alias("Name"),
                                   F.col("recipecategory").alias("RecipeCategory"),
                                   *[_r_vector(c).alias(n) for c, n in _ARRAYS.items()]), "recipes")
    schema = "RecipeId int, Name string, RecipeCategory string, " + ", ".join(f"{n} string" for n in _ARRAYS.values())
    df = IO.read_csv(spark, path, schema, list(_ARRAYS.values()))
    return df.select("recipeid", "name", "recipecategory", first_element("images").alias("first_image"),
                     *map(_listed, _ARRAYS))


@query("csv_reviews", oracle=with_fixtures("""
select review_id, recipeid, authorid, rating, review, cast(datesubmitted as timestamp) as datesubmitted from reviews
""", "reviews"))
def csv_reviews(spark, sf):
    # S2 on the review log: written as CSV and read back with its types.
    r = fixture(spark, sf, "reviews").withColumn("datesubmitted", F.col("datesubmitted").cast("timestamp"))
    cols = {"review_id": "ReviewId", "recipeid": "RecipeId", "authorid": "AuthorId", "rating": "Rating",
            "review": "Review", "datesubmitted": "DateSubmitted"}
    path = _export(spark, r.select(*[F.col(c).alias(n) for c, n in cols.items()]), "reviews")
    df = IO.read_csv(spark, path, "ReviewId string, RecipeId int, AuthorId int, Rating int, Review string, "
                                  "DateSubmitted timestamp")
    return df.withColumnRenamed("reviewid", "review_id").select(*cols)


@query("csv_reviews_ranges", oracle=with_fixtures("""
select review_id, recipeid, authorid, rating, replace(review, 'a', 'a"' || chr(10) || 'b') as review,
       cast(datesubmitted as timestamp) as datesubmitted from reviews
""", "reviews"))
def csv_reviews_ranges(spark, sf):
    # S2 with quotes and line breaks inside the review cells, read by byte ranges.
    r = fixture(spark, sf, "reviews").withColumn("datesubmitted", F.col("datesubmitted").cast("timestamp"))
    cols = {"review_id": "ReviewId", "recipeid": "RecipeId", "authorid": "AuthorId", "rating": "Rating",
            "review": "Review", "datesubmitted": "DateSubmitted"}
    broken = r.withColumn("review", F.replace("review", F.lit("a"), F.lit('a"\nb')))
    path = _export(spark, broken.select(*[F.col(c).alias(n) for c, n in cols.items()]), "reviews")
    df = read_csv_ranges(spark, path, "ReviewId string, RecipeId int, AuthorId int, Rating int, Review string, "
                                      "DateSubmitted timestamp")
    return df.withColumnRenamed("reviewid", "review_id").select(*cols)
