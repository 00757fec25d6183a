"""Scalar functions and cleaning edge cases."""

from ladle.functions.columns import (array_size_or_zero, as_text, duration_minutes, first_element,
                                     has_image, is_ascii_digits)


def test_duration_minutes(spark):
    rows = [("PT1H30M",), ("PT45M",), ("PT2H",), ("P1DT2H",), ("",), (None,), ("PT",), ("PT10H5M",),
            ("PT999999999H",), ("PT99999999999M",)]
    df = spark.createDataFrame(rows, "t string")
    got = [r[0] for r in df.select(duration_minutes("t")).collect()]
    # an int overflow is NULL, a part beyond int is a missing part (0)
    assert got == [90, 45, 120, 120, 0, 0, 0, 605, None, 0]


def test_array_size_null_is_zero(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],), (None,)], "a array<string>")
    assert [r[0] for r in df.select(array_size_or_zero("a")).collect()] == [2, 0, 0]


def test_first_element_and_image_flag(spark):
    df = spark.createDataFrame([(["http://x/1", "y"],), ([],), (None,), (["none"],)], "a array<string>")
    got = df.select(first_element("a").alias("f")).select("f", has_image("f").alias("h")).collect()
    assert [(r.f, r.h) for r in got] == [("http://x/1", True), (None, False), (None, False), ("none", False)]


def test_ascii_digits(spark):
    df = spark.createDataFrame([("123",), (" 12",), ("12a",), ("",), (None,), ("12\n",), ("٣",)], "s string")
    assert [r[0] for r in df.select(is_ascii_digits("s")).collect()] == [True, False, False, False, False, False, False]


def test_as_text(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    assert [r[0] for r in df.select(as_text("x")).collect()] == ["1", "None"]


def test_clean_recipes_fill(spark):
    from ladle.operators.clean import clean_recipes
    df = spark.createDataFrame(
        [(1, "a", "PT1H", None, 2.0, None, 1.0, 1.0, 1.0, None)],
        "recipeid int, name string, totaltime string, reviewcount double, calories double, "
        "fatcontent double, sodiumcontent double, carbohydratecontent double, proteincontent double, "
        "recipeinstructions array<string>")
    r = clean_recipes(df).first()
    assert r.reviewcount == 0 and r.fatcontent == 0 and r.instructionstep == 0 and r.time == 60
    assert r.calories == 2.0 and r.name == "a"


def test_review_length_null_stays_null(spark):
    from ladle.operators.clean import clean_reviews
    df = spark.createDataFrame([(1, "abc"), (2, None)], "recipeid int, review string")
    assert [r.reviewlength for r in clean_reviews(df).orderBy("recipeid").collect()] == [3, None]


def test_missing_counts_both_modes(spark):
    from ladle.operators.eda import missing_counts
    df = spark.createDataFrame([(1, 1.0), (None, float("nan")), (3, None)], "a int, b double")
    assert tuple(missing_counts(df).first()) == (1, 2)
    assert tuple(missing_counts(df, nan_only=True).first()) == (0, 1)
