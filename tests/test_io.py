"""Sources and sinks: CSV with array text, result scan, parquet sink, profile."""

import os
import tempfile

from pyspark.sql import functions as F

from ladle.sources import files as IO


def test_csv_with_array_text(spark):
    d = tempfile.mkdtemp(prefix="ladle-csv-")
    p = os.path.join(d, "recipes.csv")
    with open(p, "w") as f:
        f.write('RecipeId,Name,Images\n')
        f.write('1,"Pad, Thai","c(""http://a/1.jpg"", ""http://a/2.jpg"")"\n')
        f.write('2,"Soup","character(0)"\n')
        f.write('3,"Rice","[""x""]"\n')
        f.write('4,"Multi\nline",\n')
    df = IO.read_csv(spark, p, "RecipeId int, Name string, Images string", ["Images"], multi_line=True)
    rows = {r.recipeid: (r.name, r.images) for r in df.collect()}
    assert rows[1] == ("Pad, Thai", ["http://a/1.jpg", "http://a/2.jpg"])
    assert rows[2][1] == [] and rows[3][1] == ["x"] and rows[4] == ("Multi\nline", None)


def test_array_texts(spark):
    cases = {'c("1", NA, "2")': ["1", None, "2"], "c(NA, NA)": [None, None], 'c("x,NA,y", "NA")': ["x,NA,y", "NA"],
             "1:3": ["1", "2", "3"], 'c("a", 2:4, NA)': ["a", "2", "3", "4", None], "NA": None, "character(0)": [],
             '"one"': ["one"], '["a", null, "b"]': ["a", None, "b"], 'c("say \\"hi\\"", "c(1)")': ['say "hi"', "c(1)"],
             "c(1, 2.5)": ["1", "2.5"], "": None}
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "t string")
    got = {r.t: r.a for r in df.select("t", IO.parse_text_array(df.t).alias("a")).collect()}
    assert got == cases | {None: None}


def test_text_keys_and_text_results(spark):
    df = spark.createDataFrame([("7", "x"), ("None", "y"), ("1.5x", "z")], "RecipeId string, Name string")
    assert [r.recipeid for r in IO.project(df, ["recipeid"]).collect()] == [7, None, None]
    d = os.path.join(tempfile.mkdtemp(prefix="ladle-text-"), "res")
    row = ("3", "7", "Soup", "None", "None", 0.5)
    IO.write_parquet(spark.createDataFrame([row], "reviewerid string, recipeid string, recipe_name string, "
                                                  "firstsuggestid string, firstsuggestname string, score double"), d)
    back = IO.read_text_results(spark, d)
    assert tuple(back.first()) == (3, 7, "Soup", None, None, 0.5)
    assert dict(back.dtypes)["firstsuggestid"] == "int"


def test_sink_and_result_scan(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="ladle-out-"), "res")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "recipeid int, name string")
    IO.write_parquet(df, d)
    IO.write_parquet(df, d)  # overwrite
    back = IO.read_results(spark, d)
    assert sorted(map(tuple, back.collect())) == [(1, "a"), (2, "b")]


def test_projection_and_profile(spark):
    df = spark.createDataFrame([("7", "x", 1.0)], "RecipeId string, Name string, Calories double")
    out = IO.project(df, ["recipeid", "NAME"])
    assert out.columns == ["recipeid", "name"] and out.schema["recipeid"].dataType.simpleString() == "int"
    prof = IO.source_profile(df, "t").first()
    assert (prof.table_name, prof.row_count, prof.column_count) == ("t", 1, 3)
    keys = IO.keys_frame(spark, [3, 4], "authorid")
    assert [r.authorid for r in keys.collect()] == [3, 4]


def test_checkpoint_dir_comes_from_session(spark):
    from ladle.session import ensure_checkpoint_dir, materialize
    d = ensure_checkpoint_dir(spark)
    assert d == spark.sparkContext.getCheckpointDir()
    df = spark.range(10)
    back = materialize(df, "t")
    assert sorted(r.id for r in back.collect()) == list(range(10))
    assert "ladle-tables" in back.inputFiles()[0]


def test_broadcast_if_small_checks_size(spark):
    from ladle.operators.bounded import broadcast_if_small
    small = spark.range(5)
    big = spark.range(50)
    fact = spark.range(1000)
    p1 = fact.join(broadcast_if_small(small, 400), "id")._jdf.queryExecution().sparkPlan().toString()
    p2 = fact.join(broadcast_if_small(big, 400), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "BroadcastHashJoin" in p1
    assert "broadcast" not in p2.lower()


def test_a_materialized_table_leaves_no_shuffle_files(spark):
    from ladle.session import DROP_SHUFFLES, materialize

    keep = [spark.range(1000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count()]
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager()
    files = lambda: {str(b.name()) for b in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(manager.diskBlockManager().getAllBlocks()) if str(b.name()).startswith("shuffle_")}
    before = files()
    table = materialize(keep[0])
    assert not files() - before and spark.conf.get(DROP_SHUFFLES, None) is None
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, keep[0].collect()))
