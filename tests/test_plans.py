"""Plan shapes: per-group top-k limits, semi-joins, no Python UDFs."""

from ladle.plans import queries
from tests.conftest import SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_per_group_topk_uses_window_group_limit(spark):
    df = queries()["top_per_category"](spark, SMALL)
    assert "WindowGroupLimit" in _plan(df)


def test_semi_joins(spark):
    assert "LeftSemi" in _optimized(queries()["shelves_top5"](spark, SMALL))
    assert "LeftSemi" in _optimized(queries()["frequent_authors"](spark, SMALL))


def test_neighbour_pairing_broadcasts_queries(spark):
    from ladle.operators import neighbours as NB
    c = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(20)], "cand_id int, c_vec array<double>")
    q = spark.createDataFrame([("a", 0, [1.0, 0.0])], "review_id string, recipeid int, q_vec array<double>")
    r = NB.ranked_neighbours(q, c, 2, k=5)
    p = _plan(r)
    assert "BroadcastNestedLoopJoin" in p and "WindowGroupLimit" in p


def test_no_python_udf_in_registered_plans(spark):
    qs = queries()
    fits = [n for n in qs if n.startswith("als_")]  # plans of a fitted model; not planned here
    for name in sorted(set(qs) - set(fits)):
        p = _plan(qs[name](spark, SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "Pandas" not in p, name


def test_scan_prunes_columns(spark):
    from ladle.sources import files as IO
    df = IO.read_parquet(spark, f"{SMALL}/lineitem.parquet", ["L_ORDERKEY", "l_quantity"], key="l_orderkey")
    text = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    schema = next(line for line in text.splitlines() if line.startswith("ReadSchema"))
    assert "l_orderkey" in schema and "l_quantity" in schema and "l_partkey" not in schema


def test_review_features_streams_reviews(spark):
    from ladle.operators import clean as C
    from ladle.sources.tables import fixture
    df = C.review_features(fixture(spark, SMALL, "reviews"), fixture(spark, SMALL, "recipes"))
    p = df._jdf.queryExecution().sparkPlan().toString()
    # the cleaned catalog passed the size check: broadcast, no sort-merge join
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_sample_first_next_item_never_sort_merges_the_log(spark):
    from pyspark.sql import functions as F
    from ladle.operators import sequence as SQ
    df = spark.range(0, 5000).select(
        (F.col("id") % 50).cast("int").alias("authorid"), (F.col("id") % 7).alias("datesubmitted"),
        F.col("id").cast("string").alias("review_id"), (F.col("id") % 90).cast("int").alias("recipeid"))
    out = SQ.next_item_sample(df, 10, salt="p-")
    assert out.count() == 10
    # the result is a checkpointed, bounded table; its lineage was cut
    assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()


def test_shelves_never_shuffle_the_whole_catalog(spark):
    from ladle.operators import storefront as S
    from ladle.sources.tables import fixture
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        catalog = S.storefront_catalog(fixture(spark, SMALL, "recipes"))
        p = _plan(S.shelves(fixture(spark, SMALL, "reviews"), catalog, 5, 5))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)
    assert "SortMergeJoin" not in p and "LeftSemi" in p
    # the semi-join stands below the duplicate removal, so only the shown ids are shuffled
    assert p.index("HashAggregate") < p.index("LeftSemi")


def test_one_join_of_log_and_catalog_per_run(spark, monkeypatch):
    from ladle.operators import clean as C
    from ladle.plans import neighbours as PN
    calls = []
    real = C.review_features
    monkeypatch.setattr(PN.C, "review_features", lambda *a: calls.append(1) or real(*a))
    df = PN.suggestions_for(spark, SMALL, "review_log")
    assert calls == [1] and "events" not in _plan(df)


def test_hot_path_only_for_hot_keys(spark):
    from pyspark.sql import functions as F
    from ladle.operators import sequence as SQ
    df = spark.range(0, 3000).select(
        (F.col("id") % 30).cast("int").alias("authorid"), F.col("id").alias("datesubmitted"),
        F.col("id").cast("string").alias("review_id"), F.col("id").cast("int").alias("recipeid"))
    plain = SQ.leads(df, "authorid", ["datesubmitted", "review_id"], "recipeid")
    assert "rangepartitioning" not in plain._jdf.queryExecution().executedPlan().toString()
