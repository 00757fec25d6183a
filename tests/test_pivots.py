import random

import pytest

from ladle.operators import pivots as PV
from ladle.operators.neighbours import ranked_neighbours


def vectors(rng, n, dim, centres=8, spread=0.05):
    out, around = [], [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(centres)]
    for _ in range(n):
        v = [x + rng.gauss(0, spread) for x in rng.choice(around)]
        size = sum(x * x for x in v) ** 0.5
        out.append([x / size for x in v])
    return out


def frames(spark, items, asked):
    c = spark.createDataFrame([(i, v) for i, v in items], "cand_id int, c_vec array<double>").repartition(4)
    q = spark.createDataFrame([(f"r{i}", i, v, i + 1) for i, v in asked],
                              "review_id string, recipeid int, q_vec array<double>, nextrecipeid int")
    return q, c


def rows(df):
    return sorted((r.review_id, r.nextrecipeid, r.cand_id, r.sim, r.rn) for r in df.collect())


@pytest.mark.parametrize("dim,k", [(5, 7), (5, 1), (None, 20)])
def test_same_rows_as_all_pairs(spark, dim, k):
    rng = random.Random(k)
    found = vectors(rng, 1500, dim or 9)
    found += [found[0]] * 200 + [found[1]] * 5 + [[0.0] * len(found[0])] * 3  # a hot vector, ties at the k-th place, zeros
    items = list(enumerate(found))
    asked = rng.sample(items, 25) + [items[0], items[1600], items[-1]]
    q, c = frames(spark, items, asked)
    index = PV.pivot_index(c, dim)
    got, visits = PV.pruned_neighbours(q, index, k, keep=["nextrecipeid"])
    assert rows(got) == rows(ranked_neighbours(q, c, dim, k, keep=["nextrecipeid"]))
    seen = {r.review_id: r for r in visits.collect()}
    assert len(seen) == len({i for i, _ in asked}) and all(r.candidates == len(items) for r in seen.values())
    pairs = [r.pairs for i, r in seen.items() if i != f"r{items[-1][0]}"]
    assert sum(pairs) < 0.4 * len(pairs) * len(items)  # the zero query is at a right angle to all


def test_an_index_serves_several_calls_and_few_candidates(spark):
    rng = random.Random(3)
    items = list(enumerate(vectors(rng, 12, 3)))
    q, c = frames(spark, items, items[:4])
    index = PV.pivot_index(c, 3, pivots=4, rings=2)
    for k in (3, 11, 50):
        assert rows(PV.pruned_neighbours(q, index, k, keep=["nextrecipeid"])[0]) == rows(ranked_neighbours(q, c, 3, k, keep=["nextrecipeid"]))


def test_no_vectors(spark):
    q, c = frames(spark, [(1, [1.0, 0.0]), (2, None)], [(1, [1.0, 0.0]), (7, None)])
    assert [r[2] for r in rows(PV.pruned(q, c, 2, 3, keep=["nextrecipeid"]))] == []
    assert PV.pruned(q.limit(0), c, 2, 3).collect() == []
    assert PV.pruned(q, c.limit(0), 2, 3).collect() == []
    q, c = frames(spark, [(1, [0.0, 0.0]), (2, [0.0, 0.0])], [(1, [1.0, 0.0])])
    assert [r[2:4] for r in rows(PV.pruned(q, c, 2, 3, keep=["nextrecipeid"]))] == [(2, 0.0)]
