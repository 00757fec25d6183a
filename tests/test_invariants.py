"""Invariants of the registered outputs."""

import math

from pyspark.sql import functions as F

from ladle.plans import queries
from ladle.plans.neighbours import suggestions_for
from tests.conftest import SMALL


def _check_suggestions(df):
    rows = df.collect()
    assert rows
    for r in rows:
        assert r.firstsuggestid != r.recipeid
        assert r.score == 0 or 0.001 <= r.score <= 1
        ids = [x for x in (r.firstsuggestid, r.secondsuggestid, r.thirdsuggestid) if x is not None]
        assert len(ids) == len(set(ids))
        if r.expect_id is None:
            assert r.score == 0


def test_suggestion_invariants(spark):
    _check_suggestions(queries()["suggestions"](spark, SMALL))


def test_shared_scaler_variant(spark):
    _check_suggestions(suggestions_for(spark, SMALL, "review_log", n=20, shared_scaler=True))


def test_vectors_are_unit_or_zero(spark):
    df = queries()["recipe_vectors"](spark, SMALL)
    norm = F.sqrt(sum(F.col(f"v{i}") * F.col(f"v{i}") for i in range(8)))
    for (n,) in df.select(norm).collect():
        assert abs(n - 1) < 1e-5 or n < 1e-9


def test_top5_shelves_bounded(spark):
    rows = queries()["shelves_top5"](spark, SMALL).collect()
    cats = {r.recipecategory for r in rows}
    assert len(cats) <= 5 and all(1 <= r.n <= 5 for r in rows)
    assert len(rows) <= 25


def test_rmse_is_finite(spark):
    from ladle.operators import recommend as R
    from ladle.sources.tables import fixture
    train, test = R.md5_split(fixture(spark, SMALL, "reviews"), "review_id", "als-")
    r = R.rmse(R.predict(R.fit_als(train, max_iter=3), test.select("authorid", "recipeid", "rating"))).first()
    assert r.n > 0 and math.isfinite(r.rmse)
