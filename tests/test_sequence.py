"""Next-item sequences: skew-safe leads equal a plain window."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ladle.operators import sequence as SQ


def _hot(spark, n=20000):
    # Author 1 holds a third of all rows; many ties on the date.
    return spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise((F.col("id") % 211).cast("int")).alias("authorid"),
        (F.col("id") % 40).alias("datesubmitted"),
        F.format_string("r%06d", F.col("id")).alias("review_id"),
        (F.col("id") * 7 % 500).cast("int").alias("recipeid"))


def _plain(df):
    w = Window.partitionBy("authorid").orderBy("datesubmitted", "review_id")
    nxt = F.struct(F.lit(True).alias("ok"), F.col("recipeid").alias("v"))
    return df.withColumn("_lead1", F.lead(nxt, 1).over(w)).withColumn("_lead2", F.lead(nxt, 2).over(w))


def test_leads_equal_window_under_skew(spark):
    # author 1 (a third of the rows) is hot, the others take the plain window
    df = _hot(spark)
    exp = _plain(df)
    for threshold in (1000, 0):  # mixed hot/cold keys, then every key hot
        got = SQ.leads(df, "authorid", ["datesubmitted", "review_id"], "recipeid",
                       partitions=12, hot_key_rows=threshold)
        assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_hot_key_is_split_over_fragments(spark, monkeypatch):
    # fragments as the operator makes them, AQE on: none above twice the threshold
    df, seen, real, threshold = _hot(spark, 60000), [], SQ.fragments, 1000
    monkeypatch.setattr(SQ, "fragments", lambda *a: seen.append(real(*a)) or seen[-1])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        out = SQ.leads(df, "authorid", ["datesubmitted", "review_id"], "recipeid", hot_key_rows=threshold)
        assert out.count() == df.count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    sizes = [r["count"] for r in seen[0].groupBy("_frag").count().collect()]
    assert sum(sizes) >= 20000 and max(sizes) <= 2 * threshold


def test_review_ids_shared_by_authors_lose_no_row(spark):
    rows = [(a, i, "z" if (a, i) in ((1, 3), (2, 0)) else f"{a}-{i}", 10 * a + i) for a in (1, 2) for i in range(4)]
    rows += [(3, None, f"3-{i}", i) for i in range(4)]
    df = spark.createDataFrame(rows, "authorid int, datesubmitted int, review_id string, recipeid int")
    a = SQ.next_item_sample(df, 50, salt="s-").select("authorid", "review_id", "nextrecipeid")
    b = SQ.next_item(SQ.frequent_key_rows(df)).select("authorid", "review_id", "nextrecipeid")
    full = {tuple(r) for r in b.collect()}
    assert {tuple(r)[:2] for r in a.collect()} == {r[:2] for r in full}
    assert {tuple(r) for r in a.where("authorid < 3").collect()} == {r for r in full if r[0] < 3}


def test_leads_null_key_and_tiny_fragments(spark):
    rows = [(None, i, f"a{i}", i) for i in range(5)] + [(2, 0, "b0", 9)]
    df = spark.createDataFrame(rows, "authorid int, datesubmitted int, review_id string, recipeid int")
    got = SQ.leads(df, "authorid", ["datesubmitted", "review_id"], "recipeid", partitions=7,
                   hot_key_rows=0)
    m = {r.review_id: (r._lead1.v if r._lead1 else None, r._lead2.v if r._lead2 else None) for r in got.collect()}
    assert m["a0"] == (1, 2) and m["a3"] == (4, None) and m["a4"] == (None, None) and m["b0"] == (None, None)


def _seq(spark, counts):
    rows = []
    for a, n in counts.items():
        for i in range(n):
            rows.append((a, i, f"{a}-{i}", 100 * a + i))
    return spark.createDataFrame(rows, "authorid int, datesubmitted int, review_id string, recipeid int")


def test_frequent_needs_three_reviews(spark):
    df = _seq(spark, {1: 2, 2: 3})
    assert {r.authorid for r in SQ.frequent_key_rows(df).collect()} == {2}


def test_next_item_drops_latest_then_leads(spark):
    df = _seq(spark, {2: 3})
    got = sorted((r.review_id, r.nextrecipeid) for r in SQ.next_item(df).collect())
    # latest (2-2) removed first; the last kept row has no target
    assert got == [("2-0", 201), ("2-1", None)]
    hold = sorted((r.review_id, r.nextrecipeid) for r in SQ.next_item(df, holdout=True).collect())
    assert hold == [("2-0", 201), ("2-1", 202)]


def test_sample_first_equals_full_then_sample(spark):
    df = _hot(spark, 6000)
    a = SQ.next_item_sample(df, 40, salt="t-")
    b = SQ.sample_rows(SQ.next_item(SQ.frequent_key_rows(df)), 40, "review_id", "t-")
    cols = ["review_id", "nextrecipeid"]
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))
    hold_a = SQ.next_item_sample(df, 40, salt="t-", holdout=True)
    hold_b = SQ.sample_rows(SQ.next_item(SQ.frequent_key_rows(df), holdout=True), 40, "review_id", "t-")
    assert sorted(map(tuple, hold_a.select(cols).collect())) == sorted(map(tuple, hold_b.select(cols).collect()))


def test_random_sample_with_seed_is_valid(spark):
    df = _seq(spark, {1: 6, 2: 5, 3: 2})
    out = SQ.next_item_sample(df, 4, seed=11).collect()
    assert len(out) == 4
    full = {r.review_id: r.nextrecipeid for r in SQ.next_item(SQ.frequent_key_rows(df)).collect()}
    assert all(full[r.review_id] == r.nextrecipeid for r in out)


def test_shared_counts_give_same_result(spark):
    df = _hot(spark, 6000)
    counts = SQ.key_counts(df)
    a = SQ.next_item(SQ.frequent_key_rows(df, counts=counts), counts=counts)
    b = SQ.next_item(SQ.frequent_key_rows(df))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # and with a threshold that makes author 1 hot, counts drive the split
    c = SQ.leads(df, "authorid", ["datesubmitted", "review_id"], "recipeid", hot_key_rows=1000, counts=counts)
    d = SQ.leads(df, "authorid", ["datesubmitted", "review_id"], "recipeid", hot_key_rows=1000)
    assert c.exceptAll(d).count() == 0 and d.exceptAll(c).count() == 0


def test_leads_with_date_key_and_null(spark):
    import datetime as dt
    day = dt.date(2024, 1, 1)
    rows = [(day, i, f"a{i}", i) for i in range(4)] + [(None, 0, "n0", 7), (None, 1, "n1", 8)]
    df = spark.createDataFrame(rows, "k date, datesubmitted int, review_id string, recipeid int")
    got = SQ.leads(df, "k", ["datesubmitted", "review_id"], "recipeid", partitions=3, hot_key_rows=1)
    m = {r.review_id: (r._lead1.v if r._lead1 else None) for r in got.collect()}
    assert m == {"a0": 1, "a1": 2, "a2": 3, "a3": None, "n0": 8, "n1": None}


@pytest.mark.parametrize("holdout", [False, True])
def test_sampled_next_items_by_ranges(spark, holdout):
    """The same rows as pairing every sampled row with all later ones, one author holding a third of the log."""
    import random
    rng = random.Random(11)
    rows = [(i, 1 if rng.random() < 0.34 else rng.randint(2, 40), rng.randint(1, 500), f"2024-01-{rng.randint(1, 28):02d}") for i in range(3000)]
    log = spark.createDataFrame(rows, "review_id long, authorid int, recipeid int, datesubmitted string").repartition(6)
    show = lambda df: sorted(map(tuple, df.select("review_id", "nextrecipeid").collect()))
    joined = show(SQ.next_item_sample(log, 700, holdout=holdout, by_ranges=False))
    assert len(joined) == 700 and sum(r[1] is not None for r in joined) > 600
    assert show(SQ.next_item_sample(log, 700, holdout=holdout, by_ranges=True)) == joined
    assert show(SQ.next_item_sample(log, 700, holdout=holdout, by_ranges=True, hot_key_rows=200)) == joined  # author 1 over many ranges


def test_sample_is_drawn_without_shuffling_the_log(spark, monkeypatch):
    """The latest rows are looked up for the rows taken, never for the whole log."""
    asked, real = [], SQ._latest
    monkeypatch.setattr(SQ, "_latest", lambda *a: asked.append(a[1].count()) or real(*a))
    log = _seq(spark, {a: 5 for a in range(1, 301)})
    got = SQ.next_item_sample(log, 10, salt="t-").collect()
    want = SQ.sample_rows(SQ.next_item(SQ.frequent_key_rows(log)), 10, "review_id", "t-").collect()
    assert sorted((r.review_id, r.nextrecipeid) for r in got) == sorted((r.review_id, r.nextrecipeid) for r in want)
    assert asked and max(asked) <= SQ.TAKEN * 10


@pytest.mark.parametrize("most", [100_000, 50])
def test_sample_among_few_frequent_authors(spark, monkeypatch, most):
    """Rows taken first may hold too few of frequent authors: more are taken, in the end all rows."""
    monkeypatch.setattr(SQ, "MAX_BROADCAST_ROWS", most)
    log = _seq(spark, {a: 2 for a in range(1, 801)} | {900: 40})
    got = SQ.next_item_sample(log, 12, salt="t-").collect()
    want = SQ.sample_rows(SQ.next_item(SQ.frequent_key_rows(log)), 12, "review_id", "t-").collect()
    assert len(got) == 12
    assert sorted((r.review_id, r.nextrecipeid) for r in got) == sorted((r.review_id, r.nextrecipeid) for r in want)


def test_sampled_queries_write_the_log_once(spark, monkeypatch):
    """the log meets the catalog once, in a written table of the columns the passes read."""
    from ladle.plans import sequence as plans
    from tests.conftest import SMALL

    seen = []
    monkeypatch.setattr(plans.SQ, "next_item_sample", lambda df, n: seen.append(df) or df.withColumn("nextrecipeid", df.recipeid))
    plans.next_recipe_sample_large(spark, SMALL)
    assert seen[0].columns == plans._COLS
    assert "Join" not in seen[0]._jdf.queryExecution().executedPlan().toString()
