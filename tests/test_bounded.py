from ladle.operators.bounded import broadcast_if_small, size_in_bytes


def test_sizes_follow_the_bytes(spark):
    df = spark.createDataFrame([(1, "é" * 10, [1.0, 2.0], None), (2, None, None, {"a": "b"})],
                               "i int, `odd name` string, v array<double>, m map<string, string>")
    assert size_in_bytes(df) == 2 * 16 + 2 * 8 + 20 + 16 + len("{}") + len('{"m":{"a":"b"}}')
    assert size_in_bytes(df.limit(0)) == 0
    wide = spark.range(1000).selectExpr("id", "repeat('x', 1000) as t")
    assert 1_000_000 < size_in_bytes(wide) < 1_100_000


def test_only_small_sides_are_broadcast(spark):
    side, big = spark.range(100).selectExpr("id", "repeat('x', 100) as t"), spark.range(1000)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan(big.join(broadcast_if_small(side, 100_000), "id"))
    assert "strategy=broadcast" not in plan(big.join(broadcast_if_small(side, 1_000), "id"))


def test_a_large_side_is_not_broadcast_by_its_estimate(spark):
    side, big = spark.range(100).selectExpr("id", "repeat('x', 100) as t"), spark.range(1000)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(big.join(side, "id", "left"))  # some KB by Spark's estimate
    assert "BroadcastHashJoin" not in plan(big.join(broadcast_if_small(side, 1_000), "id", "left"))
