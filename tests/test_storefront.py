"""Storefront operators on small hand-made inputs."""

from ladle.operators import storefront as S


def test_ingredient_padding(spark):
    df = spark.createDataFrame(
        [(1, ["a", "b", "c"], ["1"]), (2, ["a"], ["1", "2"]), (3, None, ["1"]), (4, ["x", None], ["1", "2"])],
        "recipeid int, recipeingredientparts array<string>, recipeingredientquantities array<string>")
    rows = {(r.recipeid, r.pos): (r.ingredient, r.quantity) for r in S.ingredient_rows(df).collect()}
    pad = S.PAD_TEXT
    assert rows[(1, 2)] == ("c", pad) and rows[(1, 0)] == ("a", "1")
    assert rows[(2, 1)] == (pad, "2")
    assert rows[(3, 0)] == (pad, "1")
    assert rows[(4, 1)] == (None, "2")  # a real NULL element is not padding


def test_instruction_rows_keep_empty(spark):
    df = spark.createDataFrame([(1, ["s1", "s2"]), (2, None), (3, [])], "recipeid int, recipeinstructions array<string>")
    got = sorted((r.recipeid, r.pos, r.step) for r in S.instruction_rows(df).collect())
    assert got == [(1, 0, "s1"), (1, 1, "s2"), (2, None, None), (3, None, None)]


def test_listing_filters(spark):
    cat = spark.createDataFrame(
        [(1, "Thai Rice", "A", None), (2, "rice bowl", "B", None), (3, None, "A", None), (4, "Soup", "A", None)],
        "recipeid int, name string, recipecategory string, images string")
    assert {r.recipeid for r in S.catalog_listing(cat, "All", "  RICE ").collect()} == {1, 2}
    assert {r.recipeid for r in S.catalog_listing(cat, "A", "rice").collect()} == {1}
    assert {r.recipeid for r in S.catalog_listing(cat, "A", "   ").collect()} == {1, 3, 4}
    assert {r.recipeid for r in S.catalog_listing(cat, "All", "s.up").collect()} == {4}  # regex


def test_shelves_ties_and_limits(spark):
    cat = spark.createDataFrame(
        [(i, f"r{i}", "A" if i <= 7 else "B", "http://i") for i in range(1, 10)],
        "recipeid int, name string, recipecategory string, images string")
    reviews = spark.createDataFrame([(i, 100 + j) for i in range(1, 10) for j in range(1 + (i % 2))],
                                    "recipeid int, authorid int")
    got = S.shelves(reviews, cat, 5, 5).collect()
    a = sorted((r.n, r.recipeid) for r in got if r.recipecategory == "A")
    # counts: odd ids have 2 reviews; ties break on recipe id
    assert a == [(1, 1), (2, 3), (3, 5), (4, 7), (5, 2)]
    assert all(r.n <= 5 for r in got)


def test_author_check(spark):
    attempts = spark.createDataFrame([("7",), ("x7",), ("8",), ("",), ("7",)], "user_input string")
    reviews = spark.createDataFrame([(7, 1)], "authorid int, recipeid int")
    got = sorted((r.user_input, r.accepted) for r in S.author_check(attempts, reviews).collect())
    assert got == [("", False), ("7", True), ("7", True), ("8", False), ("x7", False)]


def test_recipe_by_id(spark):
    cat = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "recipeid int, name string")
    assert [tuple(r) for r in S.recipe_by_id(cat, 1).collect()] == [(1, "a")]
    assert S.recipe_by_id(cat, 9).count() == 0


def test_recipes_by_ids(spark):
    cat = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "recipeid int, name string")
    ids = spark.createDataFrame([(1,), (9,), (2,), (1,), (None,)], "recipeid int")
    got = sorted(map(str, (tuple(r) for r in S.recipes_by_ids(cat, ids).collect())))
    assert got == sorted(map(str, [(1, "a"), (1, "a"), (2, "c"), (9, None), (None, None)]))


def test_random_shelf_with_seed(spark):
    cat = spark.createDataFrame([(i, f"r{i}", "A", "http://x" if i % 2 else None) for i in range(30)],
                                "recipeid int, name string, recipecategory string, images string")
    a = [r.recipeid for r in S.random_shelf(cat, 5, seed=3).collect()]
    b = [r.recipeid for r in S.random_shelf(cat, 5, seed=3).collect()]
    assert len(a) == 5 and len(set(a)) == 5 and a == b
    flags = {r.recipeid: r.has_image for r in S.random_shelf(cat, 30, seed=3).collect()}
    assert all(flags[i] == bool(i % 2) for i in range(30))


def test_pick_detail_inner_join(spark):
    picks = spark.createDataFrame([(1, 10, "a"), (2, 99, "z")], "authorid int, recipeid1 int, name1 string")
    recipes = spark.createDataFrame(
        [(10, "C", ["http://i"], ["p"], ["1"], ["s"])],
        "recipeid int, recipecategory string, images array<string>, recipeingredientparts array<string>, "
        "recipeingredientquantities array<string>, recipeinstructions array<string>")
    rows = S.pick_detail(picks, recipes).collect()
    assert [(r.authorid, r.recipeid1, r.has_image) for r in rows] == [(1, 10, True)]
