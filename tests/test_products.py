import random

import numpy as np
import pytest

from ladle.operators import products as P
from ladle.operators import recommend as R


def factors(spark, vectors):
    return spark.createDataFrame([(i, [float(x) for x in v] if v is not None else None) for i, v in vectors],
                                 "id int, features array<float>").repartition(3)


def brute(queries, items, n):
    out = {}
    for q, u in queries:
        scored = sorted((-float(np.dot(np.float32(u).astype(float), np.float32(v).astype(float))), i) for i, v in items)
        out[q] = [i for _, i in scored[:n]]
    return out


@pytest.mark.parametrize("chunk_bytes,block", [(1 << 20, 2048), (3000, 16), (800, 4)])
def test_same_items_as_all_products(spark, chunk_bytes, block):
    rng = random.Random(block)
    items = [(i, [rng.gauss(0, 1) * 1.01 ** i for _ in range(4)]) for i in range(500)]
    items += [(i, items[0][1]) for i in range(500, 560)] + [(600, [0.0] * 4)]  # one norm for many, and none
    queries = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(40)] + [(41, [0.0] * 4)]
    found = P.top_products(factors(spark, queries), factors(spark, items), 7, chunk_bytes=chunk_bytes, block=block).collect()
    want = brute(queries, items, 7)
    assert {r.id: list(r.best_ids) for r in found} == want
    blocks = -(-len(items) // block)
    if block < 2048:
        assert sum(r.blocks for r in found if r.id != 41) < 0.6 * len(queries) * blocks
    assert all(list(r.best) == sorted(r.best, reverse=True) for r in found)


def test_few_items_none_and_missing_vectors(spark):
    queries, items = [(1, [1.0, 2.0]), (2, None)], [(7, [1.0, 0.0]), (8, None)]
    found = P.top_products(factors(spark, queries), factors(spark, items), 5).collect()
    assert [(r.id, r.best_ids, r.best) for r in found] == [(1, [7], [1.0])]
    empty = P.top_products(factors(spark, queries), factors(spark, items).limit(0), 5).collect()
    assert [(r.id, r.best_ids) for r in empty] == [(1, [])]
    assert P.top_products(factors(spark, queries).limit(0), factors(spark, items), 5).collect() == []


def test_chunks_are_bounded(spark):
    items = factors(spark, [(i, [1.0, 0.0]) for i in range(300)] + [(i, [float(i), 0.0]) for i in range(300, 400)])
    _, chunks = P.norm_chunks(P._plain(items, "id", "features"), 32 * 40)
    assert sum(n for *_, n in chunks) == 400 and max(n for *_, n in chunks) <= 60
    assert [norm for _, norm, _ in chunks] == sorted((norm for _, norm, _ in chunks), reverse=True)


def test_a_model_recommends_the_same(spark):
    rng = random.Random(1)
    ratings = spark.createDataFrame([(rng.randrange(60), rng.randrange(90), float(rng.randint(1, 5))) for _ in range(900)],
                                    "authorid int, recipeid int, rating double")
    model = R.fit_als(ratings, rank=4, max_iter=3)
    for items in (False, True):
        want = model.recommendForAllItems(5) if items else model.recommendForAllUsers(5)
        key = "recipeid" if items else "authorid"
        got = {r[0]: r[1] for r in R.recommend_bounded(model, 5, items).select(key, "recommendations").collect()}
        want = {r[0]: r[1] for r in want.select(key, "recommendations").collect()}
        assert got.keys() == want.keys()
        for k in want:
            assert np.allclose([x[1] for x in got[k]], [x[1] for x in want[k]], atol=1e-5)
            assert [x[0] for x in got[k]] == [x[0] for x in want[k]]


def test_near_items_of_one_norm_are_skipped_together(spark):
    rng = np.random.default_rng(3)
    around = [np.array(c, float) for c in ((1, 0, 0), (0, 1, 0), (0, 0, 1), (-1, 0, 0))]
    vectors = [around[i % 4] + rng.normal(0, 0.01, 3) for i in range(800)]
    items = [(i, (v / np.linalg.norm(v)).tolist()) for i, v in enumerate(vectors)]
    queries = [(i, around[i % 3].tolist()) for i in range(30)]
    found = P.top_products(factors(spark, queries), factors(spark, items), 5, block=50).collect()
    assert {r.id: list(r.best_ids) for r in found} == brute(queries, items, 5)
    assert max(r.blocks for r in found) <= 10  # of 16


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 4000])
def test_every_product_without_bounds(spark, chunk_bytes):
    rng = random.Random(4)
    items = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(300)] + [(i, [1.0] * 4) for i in range(300, 310)]
    queries = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(20)] + [(20, [0.0] * 4)]
    found = P.all_products(factors(spark, queries), factors(spark, items), 6, chunk_bytes=chunk_bytes).collect()
    assert {r.id: list(r.best_ids) for r in found} == brute(queries, items, 6)
    few = P.all_products(factors(spark, queries), factors(spark, items[:2] + [(9, None)]), 6).collect()
    assert {r.id: list(r.best_ids) for r in few} == brute(queries, items[:2], 6)
    assert [r.best_ids for r in P.all_products(factors(spark, queries[:1]), factors(spark, items).limit(0), 6).collect()] == [[]]


def test_recommendations_need_no_cross_join(spark, monkeypatch):
    rng = random.Random(2)
    ratings = spark.createDataFrame([(rng.randrange(40), rng.randrange(70), float(rng.randint(1, 5))) for _ in range(600)],
                                    "authorid int, recipeid int, rating double")
    model = R.fit_als(ratings, rank=3, max_iter=2)
    calls = {name: getattr(model, name) for name in ("recommendForAllUsers", "recommendForAllItems")}
    want = {name: {r[0]: [x[1] for x in r[1]] for r in f(4).collect()} for name, f in calls.items()}
    for name in (*calls, "recommendForUserSubset", "recommendForItemSubset"):
        monkeypatch.setattr(type(model), name, None)
    for name, found in (("recommendForAllUsers", (R.recommend_for_users(model, None, 4), R.recommend_for_users(model, ratings, 4), R.recommend_all_pairs(model, 4))),
                        ("recommendForAllItems", (R.recommend_for_items(model, None, 4), R.recommend_all_pairs(model, 4, for_items=True)))):
        for f in found:
            got = {r[0]: [x[1] for x in r[1]] for r in f.collect()}
            assert got.keys() == want[name].keys() and all(np.allclose(got[k], v, atol=1e-5) for k, v in want[name].items())


def test_rounds_take_several_chunks(spark, monkeypatch):
    rng = random.Random(6)
    items = [(i, [rng.gauss(0, 1) * 1.01 ** (i % 300) for _ in range(4)]) for i in range(500)]
    queries = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(300)] + [(300, [0.0] * 4)]
    written, write = [], P.materialize
    monkeypatch.setattr(P, "materialize", lambda df, label="table": written.append(label) or write(df, label))
    q, i = factors(spark, queries), factors(spark, items)
    for most, rounds in ((1 << 20, 1), (8000, 3)):  # 500 items of 48 bytes in chunks of at most 16
        monkeypatch.setattr(P, "ROUND_BYTES", most)
        for search in (P.top_products, P.all_products):
            written.clear()
            found = search(q, i, 5, chunk_bytes=800).collect()
            assert {r.id: list(r.best_ids) for r in found} == brute(queries, items, 5)
            assert rounds <= written.count("product-round") <= 2 * rounds
