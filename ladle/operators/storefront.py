"""Storefront listings: catalog, shelves, random picks, detail view (Q11–Q15).

The app this mirrors did its merges in one pandas process.  Here every
listing is a plan over the full review log and catalog:

* reviews are counted per recipe first (partial aggregation, so a hot
  recipe or author costs nothing extra), and only the per-recipe counts
  meet the catalog in a join;
* ranked top-k lists use ``row_number`` with a full tie-breaker, which
  Spark turns into a partial ``WindowGroupLimit`` before the shuffle;
* sides bounded by a limit (top categories, ranked shelves) or measured in
  bytes (id lists) are broadcast; the catalog is cut to the ids a listing
  shows by a semi-join before anything is looked up in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ladle.functions.columns import first_element, has_image, is_ascii_digits
from ladle.operators.bounded import broadcast_if_small
from ladle.session import materialize

# Fixed value: padding for the shorter of the ingredient / quantity lists.
PAD_TEXT = "not have information"
# Fixed value: the "no filter" category choice.
ALL_CATEGORIES = "All"


def storefront_catalog(recipes: DataFrame, restrict: DataFrame | None = None) -> DataFrame:
    """J6 + A11 + P6: (recipeid, name, recipecategory, images) with the
    first image, restricted to recipes present in ``restrict`` (e.g. the
    neighbour results) by a semi-join, whole-row duplicates removed."""
    cat = recipes.select("recipeid", "name", "recipecategory",
                         first_element("images").alias("images"))
    if restrict is not None:
        cat = cat.join(broadcast_if_small(restrict.select("recipeid").distinct()), "recipeid", "left_semi")
    return cat.dropDuplicates()


def review_counts(reviews: DataFrame) -> DataFrame:
    """Non-null author count per recipe (pandas ``count`` skips NULLs)."""
    return (reviews.groupBy("recipeid")
            .agg(F.count("authorid").alias("review_count")))


def recipe_category_counts(reviews: DataFrame, catalog: DataFrame) -> DataFrame:
    """A10: reviews per (recipe, category); NULL keys and orphan reviews drop
    out.  Counting before the join equals counting after it: each catalog
    row a recipe matches receives that recipe's whole count."""
    cat = catalog.select("recipeid", "recipecategory").filter(F.col("recipecategory").isNotNull())
    return (review_counts(reviews).join(cat, "recipeid")
            .groupBy("recipeid", "recipecategory")
            .agg(F.sum("review_count").alias("review_count")))


def _top_categories(counts: DataFrame, n: int) -> DataFrame:
    return (counts.groupBy("recipecategory").agg(F.sum("review_count").alias("review_count"))
            .orderBy(F.desc("review_count"), F.asc("recipecategory"))
            .limit(n))


def _top_per_category(counts: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("recipecategory").orderBy(F.desc("review_count"), F.asc("recipeid"))
    return counts.withColumn("n", F.row_number().over(w)).filter(F.col("n") <= k)


def top_categories(reviews: DataFrame, catalog: DataFrame, n: int = 5) -> DataFrame:
    """A9 + L3: the ``n`` categories with most reviews (ties by name)."""
    return _top_categories(recipe_category_counts(reviews, catalog), n)


def top_per_category(reviews: DataFrame, catalog: DataFrame, k: int = 5) -> DataFrame:
    """A10 + W3: rank recipes within each category by review count; keep
    rank ``n`` ≤ ``k``.  Ties break on recipe id (D12)."""
    return _top_per_category(recipe_category_counts(reviews, catalog), k)


def shelves(reviews: DataFrame, catalog: DataFrame, n_categories: int = 5, k: int = 5) -> DataFrame:
    """Q12: top ``k`` recipes in each of the top ``n_categories`` categories
    with name and cover image (J7 A9 L3 A10 W3 J8 J9 L5).  The per-(recipe,
    category) counts are built once and feed both rankings."""
    counts = recipe_category_counts(reviews, catalog)
    tops = _top_categories(counts, n_categories).select("recipecategory")
    ranked = materialize(_top_per_category(counts, k)
                         .join(F.broadcast(tops), "recipecategory", "left_semi"), "shelves")
    # At most n_categories * k rows remain: the catalog is cut to their ids
    # (the semi-join goes below its duplicate removal), and the few rows left
    # are the build side of the lookup.
    attrs = (catalog.join(F.broadcast(ranked.select("recipeid")), "recipeid", "left_semi")
             .select("recipeid", "name", "images"))
    out = ranked.join(F.broadcast(attrs), "recipeid", "left")
    # Shelf order, n descending within a category (at most n_categories * k rows).
    return (out.select("recipecategory", "n", "recipeid", "name", "images", "review_count")
            .orderBy("recipecategory", F.desc("n")))


def category_options(catalog: DataFrame) -> DataFrame:
    """F8: distinct non-null categories."""
    return (catalog.select("recipecategory")
            .filter(F.col("recipecategory").isNotNull()).distinct())


def catalog_listing(catalog: DataFrame, category: str = ALL_CATEGORIES,
                    search: str = "") -> DataFrame:
    """Q11 (F2 F3): category equality unless ``All``; name search is a
    case-insensitive regular expression on the trimmed text (the pandas
    default), blank means no search, NULL names never match."""
    out = catalog
    if category != ALL_CATEGORIES:
        out = out.filter(F.col("recipecategory") == F.lit(category))
    q = search.strip()
    if q:
        out = out.filter(F.col("name").rlike("(?i)" + q))
    return out


def random_shelf(catalog: DataFrame, n: int = 5, seed: int | None = None,
                 salt: str = "14-") -> DataFrame:
    """Q14 (L4 P10): ``n`` random catalog rows with an image flag.

    With ``seed`` the order is ``rand(seed)``; without, a reproducible md5
    order keyed on the recipe id.  Either way Spark runs a per-partition
    top-n and merges ``n`` rows per task, never a full sort.
    """
    order = (F.rand(seed) if seed is not None
             else F.md5(F.concat(F.lit(salt), F.col("recipeid").cast("string"))))
    return (catalog.orderBy(order, F.asc("recipeid")).limit(n)
            .withColumn("has_image", has_image("images")))


def author_check(attempts: DataFrame, reviews: DataFrame, text_col: str = "user_input") -> DataFrame:
    """Q15 (P11 F10): a login text is accepted when it is ASCII digits and
    names a known author.  Membership is one left join against the
    distinct author ids (a set, so no row multiplies), not a driver list."""
    authors = reviews.select(F.col("authorid").cast("bigint").alias("_known")).distinct()
    parsed = attempts.withColumn("is_digit", is_ascii_digits(text_col)).withColumn(
        "_aid", F.when(F.col("is_digit"), F.col(text_col).try_cast("bigint")))
    return (parsed.join(authors, F.col("_aid") == F.col("_known"), "left")
            .select(text_col, "is_digit",
                    F.col("_aid").try_cast("int").alias("user_id"),
                    F.col("_known").isNotNull().alias("accepted")))


def recipe_by_id(recipes: DataFrame, recipe_id: int, key: str = "recipeid") -> DataFrame:
    """the first catalog row of one id (ordered by name for a stable
    pick), or no row; the filter is pushed into the Parquet scan."""
    return recipes.filter(F.col(key) == F.lit(recipe_id)).orderBy(F.asc_nulls_last("name")).limit(1)


def recipes_by_ids(recipes: DataFrame, ids: DataFrame, key: str = "recipeid") -> DataFrame:
    """F9 for a table of ids: each id with its first catalog row (by name),
    NULLs where there is none.  The catalog is cut to the ids first."""
    wanted = broadcast_if_small(ids.select(key).distinct(), pin=True)
    w = Window.partitionBy(key).orderBy(F.asc_nulls_last("name"))
    first = (recipes.join(wanted, key, "left_semi").withColumn("_rn", F.row_number().over(w))
             .filter(F.col("_rn") == 1).drop("_rn"))
    return ids.select(key).join(first, key, "left")


def users_without_recs(authors: DataFrame, recs: DataFrame) -> DataFrame:
    """authors with no recommendation row (anti-join)."""
    return authors.select("authorid").distinct().join(recs.select("authorid"), "authorid", "left_anti")


def ingredient_rows(recipes: DataFrame) -> DataFrame:
    """Ingredient and quantity lists side by side, the shorter padded
    with ``not have information``.  A NULL list counts as empty; real NULL
    elements stay NULL and are not confused with padding."""
    parts = F.coalesce(F.col("recipeingredientparts"), F.array().cast("array<string>"))
    qty = F.coalesce(F.col("recipeingredientquantities"), F.array().cast("array<string>"))
    longest = F.greatest(F.size(parts), F.size(qty))
    pad = lambda a: F.concat(a, F.array_repeat(F.lit(PAD_TEXT), longest - F.size(a)))
    zipped = F.arrays_zip(pad(parts).alias("ingredient"), pad(qty).alias("quantity"))
    return (recipes.select("recipeid", F.posexplode(zipped).alias("pos", "item"))
            .select("recipeid", "pos", F.col("item.ingredient").alias("ingredient"),
                    F.col("item.quantity").alias("quantity")))


def instruction_rows(recipes: DataFrame) -> DataFrame:
    """One row per instruction step; a NULL or empty list gives one
    row with NULL position and step."""
    return recipes.select("recipeid", F.posexplode_outer("recipeinstructions").alias("pos", "step"))


# The lists a detail page shows beside name, category and image.
DETAIL_LISTS = ["recipeingredientparts", "recipeingredientquantities", "recipeinstructions"]


def _entry(catalog: DataFrame, key: str, prefix: str = "") -> DataFrame:
    """A detail page's entry: key, category, image and lists, named with a prefix."""
    shown = ["recipecategory", "images", *DETAIL_LISTS]
    return catalog.select(F.col("recipeid").alias(key), *[F.col(c).alias(prefix + c) for c in shown])


def detail_view(suggestions: DataFrame, recipes: DataFrame, picks: DataFrame | None = None) -> DataFrame:
    """Q13 (F9 J10 P6 P8 P9 P10): for each reviewed recipe in the neighbour
    result its own catalog entry, that of its first suggestion (``suggest_``)
    and, with ``picks`` (reviewerid, pickid), that of the reviewer's own pick
    (``pick_``), each with its ingredient, quantity and instruction lists.
    Missing matches stay NULL (D13) instead of raising.

    The catalog is first cut to the ids the page mentions (a semi-join
    against them, broadcast after its bytes are measured), so the lookups
    join small tables whatever the catalog size."""
    keep = ["recipeid", "firstsuggestid", "firstsuggestname"] + (["reviewerid"] if picks is not None else [])
    base = suggestions.select(*keep).dropDuplicates()
    if picks is not None:
        base = base.join(picks.select("reviewerid", "pickid"), "reviewerid", "left")
    base = materialize(base, "detail-base")
    named = ["recipeid", "firstsuggestid"] + (["pickid"] if picks is not None else [])
    ids = (base.select(F.explode(F.array(*[F.col(c) for c in named])).alias("recipeid"))
           .filter(F.col("recipeid").isNotNull()).distinct())
    cut = materialize(recipes.join(broadcast_if_small(ids), "recipeid", "left_semi").select(
        "recipeid", "name", "recipecategory", first_element("images").alias("images"), *DETAIL_LISTS), "detail-catalog")
    out = (base.join(cut, "recipeid", "left")
           .join(_entry(cut, "firstsuggestid", "suggest_"), "firstsuggestid", "left")
           .withColumn("has_image", has_image("images"))
           .withColumn("suggest_has_image", has_image("suggest_images")))
    if picks is not None:
        out = (out.join(_entry(cut, "pickid", "pick_"), "pickid", "left")
               .withColumn("pick_has_image", has_image("pick_images")))
    return out


def pick_detail(picks: DataFrame, recipes: DataFrame, pick_col: str = "recipeid1") -> DataFrame:
    """A per-user pick (e.g. the first ALS recommendation) joined to the
    catalog entry of the picked recipe (inner, as in the app).  The catalog is
    broadcast only after its bytes are measured."""
    cat = recipes.select(F.col("recipeid").alias(pick_col), "recipecategory",
                         first_element("images").alias("images"),
                         "recipeingredientparts", "recipeingredientquantities",
                         "recipeinstructions")
    return picks.join(broadcast_if_small(cat), pick_col, "inner").withColumn("has_image", has_image("images"))
