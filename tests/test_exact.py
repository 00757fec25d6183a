import random
import statistics
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ladle.operators import exact as E


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(9)
    rows = [(rng.choice("abc") if rng.random() < 0.9 else None, rng.choice([None, rng.randint(1, 5)]), round(rng.uniform(-1e6, 1e6), 2))
            for _ in range(4000)] + [("lone", 3, 1.5), ("none", None, None), ("a", 1, float("nan"))]
    return rows, spark.createDataFrame(rows, "k string, rating int, price double")


def bits(df):
    return sorted((r[0] or "", *[float(x).hex() if isinstance(x, float) else x for x in r[1:]]) for r in df.collect())


def test_the_same_bits_for_any_partitioning(log):
    _, df = log
    for f in (lambda d: E.describe_exact(d, {"rating": 0, "price": 2}), lambda d: E.means_exact(d, "k", "price", 2)):
        runs = [bits(f(df.repartition(n, F.rand(n)))) for n in (1, 7, 211)]
        assert runs[0] == runs[1] == runs[2]


def test_values(log):
    rows, df = log
    found = {r.column_name: r for r in E.describe_exact(df, {"rating": 0, "price": 2}).collect()}
    for name, i in (("rating", 1), ("price", 2)):
        values = [Fraction(str(r[i])) for r in rows if r[i] is not None and r[i] == r[i]]
        assert found[name]["count"] == len(values)
        assert found[name]["mean"] == pytest.approx(float(statistics.mean(values)), rel=1e-15)
        assert found[name]["stddev"] == pytest.approx(float(statistics.stdev(values)), rel=1e-13)
    by = {r.k: (r.n, r.mean) for r in E.means_exact(df, "k", "rating").collect()}
    assert by["lone"] == (1, 3.0) and by["none"] == (0, None) and None in by


def test_states_merge(log):
    _, df = log
    parts = [E.sums(df.where(F.col("price") > 0), {"price": 2}, ["k"]), E.sums(df.where(~(F.col("price") > 0)), {"price": 2}, ["k"])]
    both = E.merged(parts[0].unionByName(parts[1]), ["price"], ["k"])
    whole = E.sums(df.where("price is not null"), {"price": 2}, ["k"])
    show = lambda d: sorted(map(str, d.select("k", "n_price", "s_price", "q_price").collect()))
    assert show(both) == show(whole)
    assert E.describe_exact(df.limit(0), {"rating": 0}).first()["mean"] is None
