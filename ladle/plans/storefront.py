"""Storefront queries (Q11–Q15) over the fixture catalog and review log."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladle.operators import storefront as S
from ladle.plans.registry import query
from ladle.sources.tables import base_table, fixture, with_fixtures

# The oracle's catalog: first image, whole-row distinct.
_CATALOG = """, catalog as (
  select distinct recipeid, name, recipecategory, images[1] as images from recipes)
, merged as (
  select r.recipeid, r.authorid, k.recipecategory
  from reviews r left join catalog k on r.recipeid = k.recipeid)
"""


def _catalog(spark, sf):
    return S.storefront_catalog(fixture(spark, sf, "recipes"))


@query("top_categories", oracle=with_fixtures("", "recipes", "reviews") + _CATALOG + """
select recipecategory, count(authorid) as review_count
from merged where recipecategory is not null
group by recipecategory order by review_count desc, recipecategory limit 5
""")
def top_categories(spark, sf):
    return S.top_categories(fixture(spark, sf, "reviews"), _catalog(spark, sf), 5)


@query("top_per_category", oracle=with_fixtures("", "recipes", "reviews") + _CATALOG + """
select recipeid, recipecategory, review_count, n from (
  select recipeid, recipecategory, count(authorid) as review_count,
         cast(row_number() over (partition by recipecategory
                                 order by count(authorid) desc, recipeid) as int) as n
  from merged where recipecategory is not null and recipeid is not null
  group by recipeid, recipecategory) t
where n <= 5
""")
def top_per_category(spark, sf):
    return S.top_per_category(fixture(spark, sf, "reviews"), _catalog(spark, sf), 5)


SHELVES_SQL = """
, cats as (
  select recipecategory, count(authorid) as review_count
  from merged where recipecategory is not null
  group by recipecategory order by review_count desc, recipecategory limit 5)
, ranked as (
  select recipeid, recipecategory, count(authorid) as review_count,
         cast(row_number() over (partition by recipecategory
                                 order by count(authorid) desc, recipeid) as int) as n
  from merged where recipecategory is not null and recipeid is not null
  group by recipeid, recipecategory)
select r.recipecategory, r.n, r.recipeid, k.name, k.images, r.review_count
from ranked r join cats c on r.recipecategory = c.recipecategory
left join catalog k on r.recipeid = k.recipeid
where r.n <= 5
"""


@query("shelves_top5", oracle=with_fixtures("", "recipes", "reviews") + _CATALOG + SHELVES_SQL)
def shelves_top5(spark, sf):
    return S.shelves(fixture(spark, sf, "reviews"), _catalog(spark, sf), 5, 5)


@query("recipe_lookup", oracle=with_fixtures("""
select k.recipeid, f.name, f.recipecategory from (select cast(c_custkey as int) as recipeid from customer) k
left join (
  select recipeid, name, recipecategory,
         row_number() over (partition by recipeid order by name nulls last) as rn from recipes) f
  on f.recipeid = k.recipeid and f.rn = 1
""", "recipes"))
def recipe_lookup(spark, sf):
    # a table of typed ids (customer keys; some name no recipe) looked up in the catalog.
    ids = base_table(spark, sf, "customer").select(F.col("c_custkey").cast("int").alias("recipeid"))
    return S.recipes_by_ids(fixture(spark, sf, "recipes").select("recipeid", "name", "recipecategory"), ids)


@query("category_options", oracle=with_fixtures("""
select distinct recipecategory from recipes where recipecategory is not null
""", "recipes"))
def category_options(spark, sf):
    return S.category_options(_catalog(spark, sf))


# Fixed parameters of the registered listing: one category, one search word.
LISTING_CATEGORY = "STANDARD"
LISTING_SEARCH = "  Red "


@query("catalog_listing", oracle=with_fixtures(f"""
select distinct recipeid, name, recipecategory, images[1] as images from recipes
where recipecategory = '{LISTING_CATEGORY}'
  and regexp_matches(name, '{LISTING_SEARCH.strip()}', 'i')
""", "recipes"))
def catalog_listing(spark, sf):
    return S.catalog_listing(_catalog(spark, sf), LISTING_CATEGORY, LISTING_SEARCH)


@query("catalog_search", oracle=with_fixtures(f"""
select distinct recipeid, name, recipecategory, images[1] as images from recipes
where regexp_matches(name, 'PLATE|ro?d', 'i')
""", "recipes"))
def catalog_search(spark, sf):
    return S.catalog_listing(_catalog(spark, sf), S.ALL_CATEGORIES, "PLATE|ro?d")


@query("random_shelf", oracle=with_fixtures("""
select recipeid, name, recipecategory, images,
       coalesce(starts_with(images, 'http'), false) as has_image
from (select distinct recipeid, name, recipecategory, images[1] as images from recipes) c
order by md5('14-' || cast(recipeid as varchar)), recipeid limit 5
""", "recipes"))
def random_shelf(spark, sf):
    return S.random_shelf(_catalog(spark, sf), 5)


def _attempts(spark, sf):
    # Login texts derived from the customer table: the numeric key as typed,
    # the display name (not digits), and the key padded with blanks.
    c = base_table(spark, sf, "customer")
    return (c.select(F.col("c_custkey").cast("string").alias("user_input"))
            .unionByName(c.select(F.col("c_name").alias("user_input")))
            .unionByName(c.select(F.concat(F.lit(" "), F.col("c_custkey").cast("string"))
                                  .alias("user_input"))))


_ATTEMPTS_SQL = """
, attempts as (
  select cast(c_custkey as varchar) as user_input from customer
  union all select c_name from customer
  union all select ' ' || cast(c_custkey as varchar) from customer)
"""


@query("author_check", oracle=with_fixtures("", "reviews") + _ATTEMPTS_SQL + """
select a.user_input,
       coalesce(regexp_full_match(a.user_input, '[0-9]+'), false) as is_digit,
       case when regexp_full_match(a.user_input, '[0-9]+')
            then try_cast(a.user_input as int) end as user_id,
       coalesce(regexp_full_match(a.user_input, '[0-9]+')
                and try_cast(a.user_input as bigint) in (select authorid from reviews), false) as accepted
from attempts a
""")
def author_check(spark, sf):
    return S.author_check(_attempts(spark, sf), fixture(spark, sf, "reviews"))


@query("ingredient_rows", oracle=with_fixtures("""
, padded as (
  select recipeid,
         coalesce(recipeingredientparts, []) as p,
         coalesce(recipeingredientquantities, []) as q
  from recipes)
, full_lists as (
  select recipeid,
         list_concat(p, list_resize([]::varchar[], greatest(len(p), len(q)) - len(p), 'not have information')) as p,
         list_concat(q, list_resize([]::varchar[], greatest(len(p), len(q)) - len(q), 'not have information')) as q
  from padded)
select recipeid, cast(i - 1 as int) as pos, p[i] as ingredient, q[i] as quantity
from full_lists, range(1, len(p) + 1) t(i)
""", "recipes"))
def ingredient_rows(spark, sf):
    return S.ingredient_rows(fixture(spark, sf, "recipes"))


@query("instruction_rows", oracle=with_fixtures("""
select recipeid, cast(pos as int) as pos, step from (
  select recipeid, generate_subscripts(recipeinstructions, 1) - 1 as pos,
         unnest(recipeinstructions) as step
  from recipes where len(recipeinstructions) > 0)
union all
select recipeid, null as pos, null as step from recipes
where recipeinstructions is null or len(recipeinstructions) = 0
""", "recipes"))
def instruction_rows(spark, sf):
    return S.instruction_rows(fixture(spark, sf, "recipes"))
