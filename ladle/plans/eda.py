"""EDA report queries (Q1–Q3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladle.operators import bitmaps as B
from ladle.operators import eda as E
from ladle.operators import exact as X
from ladle.plans.registry import query
from ladle.session import materialize
from ladle.sources.tables import fixture, with_fixtures


def _reviews(spark, sf):
    return fixture(spark, sf, "reviews").select("recipeid", "authorid", "rating")


def _recipes(spark, sf):
    return fixture(spark, sf, "recipes").select("recipeid", "name", "recipecategory")


@query("rating_hist", oracle=with_fixtures("""
select rating, count(*) as count from reviews group by rating
""", "reviews"))
def rating_hist(spark, sf):
    return E.rating_hist(_reviews(spark, sf))


def _top_sql(table: str, key: str, n: int) -> str:
    return f"""
select {key}, count(*) as count from {table} group by {key}
order by count desc, {key} asc nulls first limit {n}
"""


@query("author_counts", oracle=with_fixtures(_top_sql("reviews", "authorid", 20), "reviews"))
def author_counts(spark, sf):
    return E.key_counts(_reviews(spark, sf), "authorid", 20)


@query("item_counts", oracle=with_fixtures(_top_sql("reviews", "recipeid", 20), "reviews"))
def item_counts(spark, sf):
    return E.key_counts(_reviews(spark, sf), "recipeid", 20)


@query("category_counts", oracle=with_fixtures(_top_sql("recipes", "recipecategory", 5), "recipes"))
def category_counts(spark, sf):
    return E.key_counts(_recipes(spark, sf), "recipecategory", 5)


@query("name_counts", oracle=with_fixtures(_top_sql("recipes", "name", 5), "recipes"))
def name_counts(spark, sf):
    return E.key_counts(_recipes(spark, sf), "name", 5)


_FULL = """
, full_reviews as (
  select r.recipeid, r.authorid, r.rating, c.name, c.recipecategory
  from reviews r left join recipes c on r.recipeid = c.recipeid)
"""


@query("category_reviews", oracle=with_fixtures(_FULL + _top_sql("full_reviews", "recipecategory", 5),
                                                 "recipes", "reviews"))
def category_reviews(spark, sf):
    return E.joined_counts(_reviews(spark, sf), _recipes(spark, sf), "recipecategory", 5)


@query("name_reviews", oracle=with_fixtures(_FULL + _top_sql("full_reviews", "name", 5),
                                             "recipes", "reviews"))
def name_reviews(spark, sf):
    return E.joined_counts(_reviews(spark, sf), _recipes(spark, sf), "name", 5)


def _mean_sql(key: str) -> str:
    return f"""
select {key}, round(average_rating, 6) as average_rating from (
  select {key}, avg(rating) as average_rating from full_reviews group by {key}
  order by average_rating desc nulls last, {key} asc nulls first limit 5) t
"""


@query("category_mean", oracle=with_fixtures(_FULL + _mean_sql("recipecategory"), "recipes", "reviews"))
def category_mean(spark, sf):
    return E.joined_means(_reviews(spark, sf), _recipes(spark, sf), "recipecategory", 5)


@query("name_mean", oracle=with_fixtures(_FULL + _mean_sql("name"), "recipes", "reviews"))
def name_mean(spark, sf):
    return E.joined_means(_reviews(spark, sf), _recipes(spark, sf), "name", 5)


@query("describe_reviews", oracle=with_fixtures("""
select 'recipeid' as column_name, count(recipeid) as count, round(avg(recipeid), 6) as mean,
       round(stddev_samp(recipeid), 6) as stddev, cast(min(recipeid) as double) as min,
       cast(max(recipeid) as double) as max from reviews
union all
select 'authorid', count(authorid), round(avg(authorid), 6), round(stddev_samp(authorid), 6),
       cast(min(authorid) as double), cast(max(authorid) as double) from reviews
union all
select 'rating', count(rating), round(avg(rating), 6), round(stddev_samp(rating), 6),
       cast(min(rating) as double), cast(max(rating) as double) from reviews
""", "reviews"))
def describe_reviews(spark, sf):
    return E.describe_columns(_reviews(spark, sf), ["recipeid", "authorid", "rating"])


def _exact_sql(column: str) -> str:
    x = f"cast({column} as hugeint)"
    n, s, q = f"count({column})", f"sum({x})", f"sum({x} * {x})"
    return (f"select '{column}' as column_name, {n} as count, cast({s} as double) / cast({n} as double) as mean, "
            f"sqrt(cast({n} * {q} - {s} * {s} as double) / (cast({n} as double) * cast({n} - 1 as double))) as stddev from reviews")


@query("describe_exact", oracle=with_fixtures(" union all ".join(map(_exact_sql, ["recipeid", "authorid", "rating"])), "reviews"))
def describe_exact(spark, sf):
    # A7 from exact integer sums: no rounding, the same bits for any partitioning.
    return X.describe_exact(_reviews(spark, sf), {"recipeid": 0, "authorid": 0, "rating": 0})


@query("author_means_exact", oracle=with_fixtures("""
select authorid, count(rating) as n, cast(sum(rating) as double) / cast(count(rating) as double) as mean
from reviews group by authorid
""", "reviews"))
def author_means_exact(spark, sf):
    return X.means_exact(_reviews(spark, sf), "authorid", "rating")


@query("distinct_counts", oracle=with_fixtures("""
select 'n_ratings' as metric, count(*) as value from reviews
union all
select 'n_recipes', count(*) from (select distinct recipeid from reviews)
union all
select 'n_authors', count(*) from (select distinct authorid from reviews)
""", "reviews"))
def distinct_counts(spark, sf):
    return E.distinct_counts(_reviews(spark, sf))


# Ids as they are, negated for every third row and missing for every seventh.
_SIGNED = """case when recipeid % 7 = 0 then null when recipeid % 3 = 0 then -recipeid else recipeid end"""


@query("distinct_by_bitmap", oracle=with_fixtures(f"""
select 'n_recipes' as metric, (select count(*) from (select distinct recipeid from reviews)) as value
union all select 'n_authors', (select count(*) from (select distinct authorid from reviews))
union all select 'n_signed', (select count(*) from (select distinct {_SIGNED} from reviews))
""", "reviews"))
def distinct_by_bitmap(spark, sf):
    # A5 + A6 as bitmaps; NULL is one value and negative ids have bits of their own.
    r = _reviews(spark, sf).withColumn("signed", F.expr(_SIGNED))
    parts = [B.distinct_count(B.id_state(r, c)).select(F.lit(n).alias("metric"), "value")
             for c, n in (("recipeid", "n_recipes"), ("authorid", "n_authors"), ("signed", "n_signed"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _by_month(spark, sf):
    r = fixture(spark, sf, "reviews").select("authorid", F.date_format("datesubmitted", "yyyy-MM").alias("month"))
    return materialize(B.id_state(r, "authorid", ["month"]), "author-bitmaps")


@query("authors_by_quarter", oracle=with_fixtures("""
select concat(strftime(datesubmitted, '%Y'), '-', quarter(datesubmitted)) as quarter, count(distinct authorid) as authors
from reviews group by 1
""", "reviews"))
def authors_by_quarter(spark, sf):
    # Quarters from the saved states of their months: the log is not read again.
    quarter = F.concat(F.substring("month", 1, 4), F.lit("-"), F.ceil(F.substring("month", 6, 2).cast("int") / 3).cast("string"))
    months = _by_month(spark, sf).withColumn("quarter", quarter)
    return B.distinct_count(B.merged(months, ["quarter"]), ["quarter"], "authors")


@query("new_authors_by_month", oracle=with_fixtures("""
select month, count(*) as new_authors from (
  select authorid, min(strftime(datesubmitted, '%Y-%m')) as month from reviews group by authorid) t
group by month
""", "reviews"))
def new_authors_by_month(spark, sf):
    return B.new_per_period(_by_month(spark, sf), "month", "new_authors")


@query("missing_counts", oracle=with_fixtures("""
select count(*) filter (where recipeid is null) as recipeid,
       count(*) filter (where authorid is null) as authorid,
       count(*) filter (where rating is null) as rating
from reviews
""", "reviews"))
def missing_counts(spark, sf):
    return E.missing_counts(_reviews(spark, sf))


@query("missing_counts_catalog", oracle=with_fixtures("""
select count(*) filter (where recipeid is null) as recipeid,
       count(*) filter (where name is null) as name,
       count(*) filter (where totaltime is null) as totaltime,
       count(*) filter (where calories is null or isnan(calories)) as calories
from recipes
""", "recipes"))
def missing_counts_catalog(spark, sf):
    r = fixture(spark, sf, "recipes").select("recipeid", "name", "totaltime", "calories")
    return E.missing_counts(r)
