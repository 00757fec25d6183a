import random

import pytest

from ladle.operators import bitmaps as B


@pytest.fixture
def log(spark):
    rng = random.Random(4)
    ids = [0, 1, -1, 32_767, 32_768, 32_769, -32_767, -32_768, -32_769, 2 ** 31, -(2 ** 31), 2 ** 40, None]
    ids += [rng.randint(-200_000, 200_000) for _ in range(2000)] + [7] * 3000  # a hot id
    rows = [(i, rng.choice("abc"), rng.randint(1, 5)) for i in ids]
    return rows, spark.createDataFrame(rows, "id long, g string, day int").repartition(5)


def test_exact_with_negative_ids_and_null(spark, log):
    rows, df = log
    assert B.distinct_count(B.id_state(df, "id")).first().value == len({r[0] for r in rows})
    by = {r.g: r.n for r in B.distinct_count(B.id_state(df, "id", ["g"]), ["g"], "n").collect()}
    assert by == {g: len({r[0] for r in rows if r[1] == g}) for g in "abc"}


def test_states_merge_in_any_order_and_twice(spark, log):
    rows, df = log
    days = [B.id_state(df.where(f"day = {d}"), "id") for d in range(1, 6)]
    state = B.merged(days[4].unionByName(days[0]))
    for d in (1, 2, 3, 0):
        state = B.merged(days[d].unionByName(state))
    assert B.distinct_count(state).first().value == len({r[0] for r in rows})
    daily = B.id_state(df, "id", ["g", "day"])
    by = {r.g: r.value for r in B.distinct_count(B.merged(daily, ["g"]), ["g"]).collect()}
    assert by == {g: len({r[0] for r in rows if r[1] == g}) for g in "abc"}


def test_new_ids_per_period(spark, log):
    rows, df = log
    first = {}
    for i, _, day in rows:
        first[i] = min(first.get(i, 9), day)
    got = {r.day: r.new_ids for r in B.new_per_period(B.id_state(df, "id", ["day"]), "day").collect()}
    assert got == {d: sum(x == d for x in first.values()) for d in set(first.values())}


def test_empty(spark, log):
    none = log[1].limit(0)
    assert B.distinct_count(B.id_state(none, "id")).first().value == 0
    assert B.new_per_period(B.id_state(none, "id", ["day"]), "day").collect() == []


def test_bits_are_set_before_the_shuffle(spark, log):
    plan = B.id_state(log[1], "id")._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan and "Python" not in plan
