"""Blocks of products against every pair, on odd vectors, copies and ties."""

import random

import pytest
from pyspark.sql import functions as F

from ladle.operators import neighbours as NB
from ladle.operators import paired as P
from ladle.operators import pivots as PV

_Q = "review_id string, recipeid long, q_vec array<double>, nextrecipeid int"


def _frames(spark, items, asked):
    c = spark.createDataFrame(items, "cand_id int, c_vec array<double>").repartition(3)
    return spark.createDataFrame([(f"r{i}", i, v, n) for n, (i, v) in enumerate(asked)], _Q), c


def _rows(df):
    return sorted((r.review_id, r.rn, r.cand_id, r.nextrecipeid, repr(r.sim)) for r in df.collect())


def _vectors(rng, n, width):
    return [[rng.gauss(0, 0.4) for _ in range(width)] for _ in range(n)]


def _unit(v):
    size = sum(x * x for x in v) ** 0.5
    return [x / size for x in v]


@pytest.mark.parametrize("k", [1, 3, 40])
def test_same_rows_as_every_pair(spark, monkeypatch, k):
    monkeypatch.setattr(P, "CANDIDATES", 64)
    monkeypatch.setattr(P, "QUERIES", 7)
    rng = random.Random(k)
    found = _vectors(rng, 700, 6)
    found += [found[0]] * 90 + [[x + 1e-10 for x in found[0]]] * 5 + [[0.0] * 6] * 4
    items = list(enumerate(found)) + [(3, found[9]), (3, found[9]), (None, found[0]), (800, None), (801, found[0][:3]),
                                      (802, [None, *found[1][1:]]), (803, [float("inf"), *found[1][1:]]), (804, [float("nan")] * 6)]
    # One row a key and id: rows of equal rank would carry any of their kept columns.
    asked = [items[i] for i in (*range(0, 60, 3), 702, 795, 798)] + [(None, found[5]), (900, None), (901, found[2][:2])]
    q, c = _frames(spark, items, asked)
    columns = ("q_vec", "c_vec", "recipeid", "cand_id", ["review_id", "nextrecipeid"])
    want = NB.ranked(NB._all_pairs(q, c, None, *columns), "review_id", "cand_id", k)
    assert _rows(NB.ranked_neighbours(q, c, None, k, keep=["nextrecipeid"])) == _rows(want)
    whole, dense = q.where(P.plain("q_vec", 6)), c.where(P.plain("c_vec", 6))
    few = P.best_pairs(whole, dense, 6, k, *columns, query_bytes=2000).withColumn("sim", F.round("sim", 9))
    every = NB._all_pairs(whole, dense, None, *columns)
    assert _rows(NB.ranked(few, "review_id", "cand_id", k)) == _rows(NB.ranked(every, "review_id", "cand_id", k))


def test_only_the_best_leave_the_pairing(spark, monkeypatch):
    left, ranked = [], NB.ranked
    monkeypatch.setattr(NB, "ranked", lambda pairs, *a: left.append(pairs) or ranked(pairs, *a))
    rng = random.Random(4)
    items = list(enumerate(_vectors(rng, 600, 5) + [[0.5] * 5] * 300))
    q, c = _frames(spark, items, items[:20] + items[-5:])
    assert len(_rows(NB.ranked_neighbours(q, c, None, 3, keep=["nextrecipeid"]))) == 25 * 3
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert left[0].count() <= 25 * 2 * 3 * tasks  # of 25 x 899 pairs; copies may tie with the third


def test_ids_are_integers_or_every_pair_is_made(spark):
    c = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.6, 0.8])], "cand_id string, c_vec array<double>")
    q = spark.createDataFrame([("r", "a", [1.0, 0.0])], "review_id string, recipeid string, q_vec array<double>")
    assert [(r.cand_id, r.sim) for r in NB.ranked_neighbours(q, c, None, 3).collect()] == [("b", 0.6)]
    empty = spark.createDataFrame([], _Q)
    assert NB.ranked_neighbours(empty, spark.createDataFrame([(1, [1.0])], "cand_id int, c_vec array<double>"), None, 3).collect() == []


def test_visited_cells_leave_only_what_may_be_best(spark, monkeypatch):
    monkeypatch.setattr(P, "CANDIDATES", 50)
    left, ranked = [], NB.ranked
    monkeypatch.setattr(PV, "ranked", lambda pairs, *a: left.append(pairs) or ranked(pairs, *a))
    items = list(enumerate(_vectors(random.Random(5), 300, 5) + [[0.5] * 5] * 200))
    q, c = _frames(spark, [(i, _unit(v)) for i, v in items], [(i, _unit(v)) for i, v in items[:15] + items[-5:]])
    index = PV.pivot_index(c, None, pivots=2, cell_size=400)  # one cell
    got = PV.pruned_neighbours(q, index, 3, keep=["nextrecipeid"])[0]
    assert _rows(got) == _rows(NB.ranked_neighbours(q, c, None, 3, keep=["nextrecipeid"]))
    assert left[0].count() < 20 * 499 / 3  # of all pairs
