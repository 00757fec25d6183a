import collections
import random

import numpy as np

from ladle.operators import factorize as A
from ladle.operators import recommend as R


def low_rank(rng, users, items, n, rank=3):
    u = np.array([[rng.gauss(0, 1) for _ in range(rank)] for _ in range(users)])
    v = np.array([[rng.gauss(0, 1) for _ in range(rank)] for _ in range(items)])
    return [(a, b, float(3 + u[a] @ v[b] + rng.gauss(0, 0.3))) for a, b in
            ((rng.randrange(users) if rng.random() < 0.67 else 0, rng.randrange(items)) for _ in range(n))]  # user 0 has a third


def frame(spark, rows):
    return spark.createDataFrame(rows, "authorid int, recipeid int, rating double").repartition(6)


def test_a_side_equals_mllibs_last_step(spark):
    ratings = frame(spark, low_rank(random.Random(5), 80, 120, 4000))
    model = R.fit_als(ratings, rank=4, max_iter=4, reg_param=0.2)
    got = {r.id: np.array(r.features) for r in A.solve_side(ratings, model.itemFactors, "authorid", "recipeid", 4, 0.2).collect()}
    want = {r.id: np.array(r.features) for r in model.userFactors.collect()}
    assert got.keys() == want.keys()
    assert max(np.abs(got[k] - want[k]).max() for k in want) < 2e-3


def test_a_hot_user_is_summed_in_every_task(spark):
    rows = low_rank(random.Random(6), 50, 60, 3000)
    ratings = frame(spark, rows)
    start = A.start_factors(ratings, "recipeid", 3, 1)
    sums = A.partial_sums(ratings, start, "authorid", "recipeid", 3).where("id = 0").collect()
    assert len(sums) == 6 and sum(r.n for r in sums) == sum(a == 0 for a, *_ in rows) > len(rows) / 3
    few = A.partial_sums(ratings, start, "authorid", "recipeid", 3, held=7)  # sums leave early and meet again
    a = {r.id: np.array(r.features) for r in A.solved(few, 3, 0.1).collect()}
    b = {r.id: np.array(r.features) for r in A.solve_side(ratings, start, "authorid", "recipeid", 3, 0.1).collect()}
    assert a.keys() == b.keys() and all(np.allclose(a[k], b[k], atol=1e-4) for k in a)


def test_held_out_error_like_mllibs(spark):
    rows = low_rank(random.Random(7), 60, 80, 5000)
    train, test = frame(spark, rows[:4500]), frame(spark, rows[4500:])
    users, items = A.fit_factors(train, rank=5, iterations=8, reg=0.05)
    ours = R.rmse(A.predicted(test, users, items)).first()
    theirs = R.rmse(R.predict(R.fit_als(train, rank=5, max_iter=8, reg_param=0.05), test)).first()
    assert ours.n == theirs.n and abs(ours.rmse - theirs.rmse) < 0.02 * theirs.rmse


def test_nulls_repeats_and_nothing(spark):
    rows = [(1, 1, 5.0), (1, 1, 5.0), (1, None, 3.0), (None, 2, 1.0), (2, 3, None)]
    users, items = A.fit_factors(frame(spark, rows), rank=2, iterations=2)
    assert [r.id for r in users.collect()] == [1] == [r.id for r in items.collect()]
    users, items = A.fit_factors(frame(spark, rows).limit(0), rank=2, iterations=1)
    assert users.collect() == [] == items.collect()


def test_one_run_scores_every_prefix(spark):
    rows = low_rank(random.Random(8), 40, 50, 1500)
    train, test = frame(spark, rows[:1300]), frame(spark, rows[1300:])
    metrics, best = A.tune_factors(train, test, [2], [0.05, 5.0], [1, 3])
    got = {(r.regParam, r.maxIter): r.rmse for r in metrics.collect()}
    assert len(got) == 4 and list(got.values()) == sorted(got.values())
    for (reg, i), rmse in got.items():
        alone = R.rmse(A.predicted(test, *A.fit_factors(train, rank=2, iterations=i, reg=reg))).first().rmse
        assert abs(alone - rmse) < 1e-4
    assert abs(R.rmse(A.predicted(test, *best)).first().rmse - min(got.values())) < 1e-6


def test_many_users_leave_one_sum_each(spark):
    rows = low_rank(random.Random(9), 400, 30, 6000)
    ratings = frame(spark, rows)
    start = A.start_factors(ratings, "recipeid", 3, 1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small parts would meet in one task
    try:
        sums = A.partial_sums(ratings, start, "authorid", "recipeid", 3, held=50, hot=500).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    count = collections.Counter(a for a, *_ in rows)
    found = collections.Counter(r.id for r in sums)
    assert all(found[a] == 1 for a, n in count.items() if n <= 500) and 1 < found[0] <= -(-count[0] // 500)
    assert {a: sum(r.n for r in sums if r.id == a) for a in count} == count
    few = A.solved(A.partial_sums(ratings, start, "authorid", "recipeid", 3, held=50, hot=500), 3, 0.1)
    a, b = ({r.id: np.array(r.features) for r in df.collect()} for df in (few, A.solve_side(ratings, start, "authorid", "recipeid", 3, 0.1)))
    assert a.keys() == b.keys() and all(np.allclose(a[k], b[k], atol=1e-4) for k in a)


def test_the_grid_is_split_scored_and_the_best_fitted_again(spark):
    ratings = frame(spark, low_rank(random.Random(10), 40, 50, 1500))
    metrics, best, (train, held) = A.tune_split(ratings, [2], [0.05, 5.0], [1, 3])
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(train.unionByName(held)) == key(ratings) and 0.05 < held.count() / ratings.count() < 0.15
    first = metrics.first()
    alone = A.fit_factors(train, rank=2, iterations=first.maxIter, reg=first.regParam)
    assert metrics.count() == 4 and abs(R.rmse(A.predicted(held, *alone)).first().rmse - first.rmse) < 1e-4
    again = A.fit_factors(ratings, rank=2, iterations=first.maxIter, reg=first.regParam)
    for a, b in zip(best, again):
        got, want = ({r.id: r.features for r in x.collect()} for x in (a, b))
        assert got.keys() == want.keys() and all(np.allclose(got[k], want[k], atol=1e-3) for k in want)
    none, unfitted, _ = A.tune_split(ratings.limit(0), [2], [0.1], [1])
    assert [r.rmse for r in none.collect()] == [None] and unfitted is None


def test_every_prefix_is_compared_with_its_own_fit(spark, monkeypatch):
    from ladle.plans import recommend as plans
    from tests.conftest import SMALL

    fits, fit = [], A.fit_factors
    monkeypatch.setattr(A, "fit_factors", lambda rows, rank, iterations, reg, *a: fits.append((rank, iterations, reg, rows.count())) or fit(rows, rank, iterations, reg, *a))
    found = plans.als_tuning_prefixes(spark, SMALL).collect()
    train = plans._fitted_on(spark, SMALL)[0].count()
    assert len(found) == 4 and all(r.as_fitted_alone for r in found)
    fitted = {(r.rank, r.maxIter, r.regParam) for r in found}
    assert {f[:3] for f in fits if f[3] < train} == fitted and sum(f[3] == train for f in fits) == 1
