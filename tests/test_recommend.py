"""ALS invariants, save/load, tuning, wide layouts."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ladle.operators import recommend as R
from ladle.operators.bounded import broadcast_if_small
from ladle.plans import recommend as plans
from ladle.sources.tables import fixture
from tests.conftest import SMALL


def _ratings(spark):
    return fixture(spark, SMALL, "reviews").select("review_id", "authorid", "recipeid", "rating")


def test_als_fit_predict_save_load(spark):
    train, test = R.md5_split(_ratings(spark), "review_id", "als-")
    model = R.fit_als(train, max_iter=5)
    pred = R.predict(model, test)
    assert pred.filter(F.isnan("prediction")).count() == 0
    row = R.rmse(pred).first()
    assert row.n == pred.count() and row.rmse > 0
    assert abs(row.rmse - R.rmse_value(pred)) < 1e-9
    path = os.path.join(tempfile.mkdtemp(prefix="ladle-model-"), "als")
    R.save_model(model, path)
    R.save_model(model, path)  # overwrite works (D1)
    again = R.load_model(path)
    a = sorted(map(tuple, model.transform(test).na.drop().select("review_id", "prediction").collect()))
    b = sorted(map(tuple, again.transform(test).na.drop().select("review_id", "prediction").collect()))
    assert a == b


def test_user_recommendations_invariants(spark):
    ratings = _ratings(spark)
    model = R.fit_als(ratings, max_iter=3)
    recs = R.recommend_for_users(model, ratings, 5)
    n_users = ratings.select("authorid").distinct().count()
    assert recs.count() <= n_users
    for r in recs.limit(20).collect():
        ids = [x.recipeid for x in r.recommendations]
        scores = [x.rating for x in r.recommendations]
        assert len(ids) == len(set(ids)) <= 5
        assert scores == sorted(scores, reverse=True)
    unknown = spark.createDataFrame([(-5,)], "authorid int")
    assert R.recommend_for_users(model, unknown, 5).count() == 0
    wide = R.wide_recommendations(recs, fixture(spark, SMALL, "recipes"), 5)
    assert wide.columns[:4] == ["authorid", "recipeid1", "name1", "rating1"]
    assert wide.count() == recs.count()
    items = R.wide_item_recommendations(R.recommend_for_items(model, ratings, 3),
                                        fixture(spark, SMALL, "recipes"), 3)
    assert items.columns == ["recipeid", "name", "recipecategory", "authorid1", "rating1",
                             "authorid2", "rating2", "authorid3", "rating3"]


def test_tuning_small_grid(spark):
    train, _ = R.md5_split(_ratings(spark), "review_id", "als-")
    best, metrics = R.tune_als(train, ranks=[2, 4], reg_params=[0.1], max_iters=[3])
    rows = metrics.collect()
    assert len(rows) == 2
    assert rows[0].rmse <= rows[1].rmse
    assert best.rank == rows[0].rank


def test_blocks_are_bounded():
    assert [R.blocks_for(n) for n in (0, 10**6, 10**9, 10**12)] == [10, 10, 50, R.MAX_ALS_BLOCKS]


@pytest.mark.parametrize("name", ["als_rmse", "als_tuning"])
def test_fitted_blocks_follow_the_ratings(spark, monkeypatch, name):
    fitted, fit = [], R.ALS.fit
    monkeypatch.setattr(R.ALS, "fit", lambda self, *a: fitted.append(self) or fit(self, *a))
    monkeypatch.setattr(plans, "TUNE_RANKS", [2])
    monkeypatch.setattr(plans, "TUNE_REGS", [0.1])
    monkeypatch.setattr(plans, "TUNE_ITERS", [1])
    train, _ = plans._split(plans._ratings(spark, SMALL))
    monkeypatch.setattr(R, "RATINGS_PER_BLOCK", -(-train.count() // 13))
    getattr(plans, name)(spark, SMALL).collect()
    assert fitted and {(e.getNumUserBlocks(), e.getNumItemBlocks()) for e in fitted} == {(13, 13)}


def test_random_split_fractions(spark):
    train, test = R.random_split(_ratings(spark), 0.9, 42)
    total = _ratings(spark).count()
    assert train.count() + test.count() == total
    assert 0.05 < test.count() / total < 0.15


def test_all_users_equals_every_author(spark):
    ratings = _ratings(spark)
    model = R.fit_als(ratings, max_iter=3)
    a = R.recommend_for_users(model, ratings, 3)
    b = R.recommend_for_users(model, None, 3)
    key = lambda df: sorted((r.authorid, tuple(x.recipeid for x in r.recommendations)) for r in df.collect())
    assert key(a) == key(b)
    ia = R.recommend_for_items(model, ratings, 2)
    ib = R.recommend_for_items(model, None, 2)
    ikey = lambda df: sorted((r.recipeid, tuple(x.authorid for x in r.recommendations)) for r in df.collect())
    assert ikey(ia) == ikey(ib)


def test_training_rows_are_written_without_review_ids(spark, monkeypatch):
    written, write = [], plans.materialize
    keep = lambda df, label="table": written.append((label, write(df, label))) or written[-1][1]
    for module in (plans, R):
        monkeypatch.setattr(module, "materialize", keep, raising=False)
    assert plans.als_rmse(spark, SMALL).first().agrees
    rows = next(df for label, df in written if label == "ratings")
    test = R.md5_split(_ratings(spark), "review_id", "als-")[1].count()
    assert rows.count() == _ratings(spark).count() and rows.where("review_id is not null").count() == test


def test_written_split_has_the_rows_of_md5_split(spark):
    rows = [(None if i % 11 == 0 else f"r{i % 70}", i % 7, None if i % 13 == 0 else i) for i in range(200)]  # nulls and repeats
    df = spark.createDataFrame(rows, "review_id string, authorid int, rating int")
    key = lambda df: sorted(map(str, df.collect()))
    train, test = R.md5_split(df, "review_id", "x-", 5, 2)
    narrow, held = R.md5_split_written(df, "review_id", "x-", 5, 2)
    assert held.columns == df.columns and key(held) == key(test) and held.count()
    assert key(narrow) == key(train.drop("review_id")) and narrow.count()


def test_more_iterations_leave_no_more_shuffles(spark):
    ratings = _ratings(spark)
    shuffles = lambda n: R.fit_als(ratings, rank=2, max_iter=n).userFactors.rdd.toDebugString().decode().count("ShuffledRDD")
    assert shuffles(9) == shuffles(3)


def test_fits_hold_nothing_in_memory(spark, monkeypatch):
    fitted, fit = [], R.ALS.fit
    monkeypatch.setattr(R.ALS, "fit", lambda self, *a: fitted.append(self) or fit(self, *a))
    train, _ = R.md5_split(_ratings(spark), "review_id", "als-")
    best, _ = R.tune_als(train, ranks=[2], reg_params=[0.1, 0.3], max_iters=[1])
    assert best.userFactors.count() and fitted
    levels = {x for e in fitted for x in (e.getIntermediateStorageLevel(), e.getFinalStorageLevel())}
    assert all("MEMORY" not in x for x in levels)
    held = [x for x in spark.sparkContext._jsc.getPersistentRDDs().values() if str(x.name()) in ("userFactors", "itemFactors")]
    assert held and not any(x.getStorageLevel().useMemory() for x in held)


def test_a_large_catalog_is_not_broadcast(spark, monkeypatch):
    for module in (plans, R, plans.S):
        monkeypatch.setattr(module, "broadcast_if_small", lambda df, pin=False: broadcast_if_small(df, 0))
    found = plans.als_pick_detail(spark, SMALL)
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == found.where("shown_if_known").count() > 0
