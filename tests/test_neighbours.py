"""Neighbour ranking and score invariants."""

import math

from pyspark.sql import functions as F

from ladle.operators import features as FT
from ladle.operators import neighbours as NB


def _unit(v):
    n = math.sqrt(sum(x * x for x in v))
    return [x / n for x in v] if n else v


def _catalog(spark, n):
    # Candidate i sits at angle i * 0.001 from the x axis: similarity to the
    # x axis falls with i, so candidate i has rank i for a query on the axis.
    rows = [(i, f"c{i}", [math.cos(i * 1e-3), math.sin(i * 1e-3)]) for i in range(1, n + 1)]
    return spark.createDataFrame(rows, "recipeid int, name string, normfeatures array<double>")


def _sample(spark, target):
    return spark.createDataFrame([("q1", 7, 0, "query", target, [1.0, 0.0])],
                                 "review_id string, authorid int, recipeid int, name string, "
                                 "nextrecipeid int, normfeatures array<double>")


def test_score_at_rank_1_1000_1001(spark):
    cat = _catalog(spark, 1200)
    names = cat.select("recipeid", "name")
    for target, score in [(1, 1.0), (1000, 0.001), (1001, 0.0), (None, 0.0)]:
        r = NB.suggestions(_sample(spark, target), cat, names, 2, n_queries=1).first()
        assert r.score == score, (target, r.score)
        assert (r.firstsuggestid, r.secondsuggestid, r.thirdsuggestid) == (1, 2, 3)
        assert r.firstsuggestname == "c1"


def test_self_is_never_suggested(spark):
    cat = _catalog(spark, 10)
    sample = spark.createDataFrame([("q", 1, 1, "c1", 1, [math.cos(1e-3), math.sin(1e-3)])],
                                   "review_id string, authorid int, recipeid int, name string, "
                                   "nextrecipeid int, normfeatures array<double>")
    r = NB.suggestions(sample, cat, cat.select("recipeid", "name"), 2, n_queries=1).first()
    assert r.firstsuggestid == 2 and r.score == 0.0  # target equals the query: excluded (F4)


def test_fewer_than_three_candidates(spark):
    cat = _catalog(spark, 2)
    r = NB.suggestions(_sample(spark, 2), cat, cat.select("recipeid", "name"), 2, n_queries=1).first()
    assert (r.firstsuggestid, r.secondsuggestid, r.thirdsuggestid) == (1, 2, None)
    assert r.thirdsuggestname is None and r.score == 0.999


def test_unit_vectors_and_zero_vector(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 2.0, 5.0), (3, 3.0, 5.0), (4, 2.0, 5.0)],
                               "id int, a double, b double")
    out = FT.unit_vectors(df, ["a", "b"]).orderBy("id").collect()
    norms = [round(math.sqrt(sum(x * x for x in r.normfeatures)), 12) for r in out]
    # constant column scales to 0; the mean row becomes the zero vector
    assert norms == [1.0, 0.0, 1.0, 0.0]
    assert all(r.normfeatures[1] == 0.0 for r in out)


def test_similarities_bounded(spark):
    import random
    random.seed(3)
    rows = [(i, f"n{i}", _unit([random.uniform(-1, 1) for _ in range(4)])) for i in range(300)]
    cat = spark.createDataFrame(rows, "recipeid int, name string, normfeatures array<double>")
    q = cat.limit(5).select(F.concat(F.lit("q"), F.col("recipeid").cast("string")).alias("review_id"),
                            "recipeid", F.col("normfeatures").alias("q_vec"))
    c = cat.select(F.col("recipeid").alias("cand_id"), F.col("normfeatures").alias("c_vec"))
    ranked = NB.ranked_neighbours(q, c, 4, k=1000, keep=["recipeid"])
    stats = ranked.agg(F.min("sim"), F.max("sim"), F.max("rn"), F.count(F.lit(1))).first()
    assert -1 - 1e-9 <= stats[0] and stats[1] <= 1 + 1e-9
    assert stats[2] == 299 and stats[3] == 5 * 299
    assert ranked.filter(F.col("recipeid") == F.col("cand_id")).count() == 0


def test_chunked_broadcast_equals_single(spark, monkeypatch):
    import random
    random.seed(5)
    rows = [(i, f"n{i}", _unit([random.uniform(-1, 1) for _ in range(3)])) for i in range(120)]
    cat = spark.createDataFrame(rows, "recipeid int, name string, normfeatures array<double>")
    q = cat.limit(30).select(F.concat(F.lit("q"), F.col("recipeid").cast("string")).alias("review_id"),
                             "recipeid", F.col("normfeatures").alias("q_vec"))
    c = cat.select(F.col("recipeid").alias("cand_id"), F.col("normfeatures").alias("c_vec"))
    single = NB.ranked_neighbours(q, c, 3, k=7)
    monkeypatch.setattr(NB, "MAX_BROADCAST_BYTES", 800)
    chunked = NB.ranked_neighbours(q, c, 3, k=7)
    assert chunked._jdf.queryExecution().optimizedPlan().toString().count("Join") > 3
    cols = ["review_id", "cand_id", "rn", "sim"]
    a = sorted(map(tuple, single.select(cols).collect()))
    b = sorted(map(tuple, chunked.select(cols).collect()))
    assert a == b and len(a) == 30 * 7


def test_a_task_ranks_a_query_in_one_bucket(spark):
    """at most k pairs of a query leave a task, whatever the number of candidates."""
    pairs = spark.range(0, 4000, numPartitions=5).selectExpr("id % 2 as q", "id as c", "pmod(id * 7919, 4001) / 4001d as sim")
    dealt = NB._bucketed(pairs).withColumn("task", F.spark_partition_id())
    assert dealt.select("task", "q", "_bucket").distinct().count() == 5 * 2
    got = {(r.q, r.rn): r.c for r in NB.ranked(pairs, "q", "c", 30).collect()}
    rows = sorted(((r.q, -r.sim, r.c) for r in pairs.collect()))
    want = {(q, i + 1): c for q in (0, 1) for i, (_, _, c) in enumerate([r for r in rows if r[0] == q][:30])}
    assert got == want
