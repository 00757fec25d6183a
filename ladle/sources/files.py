"""Scans and sinks for the catalog, the review log and produced results.

S1 parquet scan, S2 CSV scan, S3 result scan, S4 load-time projection,
S5 lower-cased names, S6 integer key, S7 source profile, S8 parquet sink.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column sets the jobs project right after loading (fixed values).
REVIEW_FEATURE_COLUMNS = ["recipeid", "authorid", "rating", "review", "datesubmitted"]
RECIPE_FEATURE_COLUMNS = ["recipeid", "name", "totaltime", "reviewcount", "calories",
                          "fatcontent", "sodiumcontent", "carbohydratecontent",
                          "proteincontent", "recipeinstructions"]
RATING_COLUMNS = ["recipeid", "authorid", "rating"]
RECIPE_LABEL_COLUMNS = ["recipeid", "name", "recipecategory"]
# The ids of the text result; "None" stands for a missing one.
RESULT_ID_COLUMNS = ["reviewerid", "recipeid", "firstsuggestid", "secondsuggestid", "thirdsuggestid",
                     "expect_id"]

# Array-valued catalog columns; in CSV exports they arrive as text.
RECIPE_ARRAY_COLUMNS = ["recipeinstructions", "recipeingredientparts",
                        "recipeingredientquantities", "images"]


def lowercase_columns(df: DataFrame) -> DataFrame:
    """One projection renaming every column to lower case."""
    return df.toDF(*[c.lower() for c in df.columns])


def project(df: DataFrame, columns: Sequence[str], key: str | None = "recipeid") -> DataFrame:
    """S4 + S6: lower-case, keep ``columns`` (case-insensitive), cast the key
    to int; a text key that is no number (``None``) becomes NULL.

    Applied directly over a scan this becomes the Parquet ``ReadSchema``.
    """
    df = lowercase_columns(df)
    cols = [c.lower() for c in columns]
    out = df.select(*cols)
    if key and key in cols:
        out = out.withColumn(key, int_key(out, key))
    return out


def int_key(df: DataFrame, key: str) -> Column:
    """An id column as int; text that is no number becomes NULL."""
    c = F.col(key)
    return c.try_cast("int") if isinstance(df.schema[key].dataType, T.StringType) else c.cast("int")


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                 key: str | None = "recipeid") -> DataFrame:
    """Parquet scan with the load-time projection of S4–S6."""
    df = spark.read.parquet(path)
    return project(df, columns, key) if columns else lowercase_columns(df)


def parse_text_array(c: Column) -> Column:
    """Parse array text from a CSV cell.

    Accepts a JSON list ``["a", "b"]`` or an R vector ``c("a", NA, "b")``;
    ``character(0)`` is the empty array, a bare quoted string a one-element
    array and a bare ``NA`` a missing array.  Unquoted ``NA``, ``NULL`` and
    ``null`` elements are NULL, ``1:3`` is a range, other unquoted elements
    are their text.
    """
    s = F.trim(c)
    inner = (F.when(s.startswith("c("), F.regexp_replace(s, r"^c\(|\)$", ""))
             .when(s.startswith("["), F.regexp_replace(s, r"^\[|\]$", "")).otherwise(s))
    # Quoted strings are taken whole, so an NA or a comma inside them is text.
    parts = F.regexp_extract_all(inner, F.lit(r'"(?:[^"\\]|\\.)*+"|[^,\s]+'), F.lit(0))
    bound = lambda p, i: F.regexp_extract(p, r"^(-?\d{1,9}):(-?\d{1,9})$", i).try_cast("int")
    texts = F.transform(parts, lambda p: (
        F.when(p.startswith('"'), F.array(p))
        .when(p.isin("NA", "NULL", "null"), F.array(F.lit("null")))
        .when(p.rlike(r"^-?\d{1,9}:-?\d{1,9}$"),
              F.transform(F.sequence(bound(p, 1), bound(p, 2)), lambda n: F.concat(F.lit('"'), n.cast("string"), F.lit('"'))))
        .otherwise(F.array(F.concat(F.lit('"'), p, F.lit('"'))))))
    json = F.concat(F.lit("["), F.array_join(F.flatten(texts), ","), F.lit("]"))
    return (F.when(s.isin("NA", ""), F.lit(None)).when(s == F.lit("character(0)"), F.array().cast("array<string>"))
            .otherwise(F.from_json(json, T.ArrayType(T.StringType()))))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str,
             array_columns: Sequence[str] = (), multi_line: bool = False) -> DataFrame:
    """CSV scan with a header and quoted cells.

    An explicit schema avoids the inference pass over the whole file;
    array columns are read as text and parsed on the executors.
    ``multi_line`` allows line ends inside cells; such a file cannot be
    split, so each file is one task (project before any shuffle).
    """
    df = (spark.read.schema(schema).option("header", True).option("multiLine", multi_line)
          .option("escape", '"').csv(path))
    df = lowercase_columns(df)
    for c in array_columns:
        if c.lower() in df.columns:
            df = df.withColumn(c.lower(), parse_text_array(F.col(c.lower())))
    return df


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """S3: scan a directory of materialised results."""
    return spark.read.parquet(path)


def read_text_results(spark: SparkSession, path: str) -> DataFrame:
    """S3 + S6: the text layout of the neighbour result with its types back:
    ids as int, every ``"None"`` as NULL."""
    df = lowercase_columns(spark.read.parquet(path))
    out = df.select(*[F.when(F.col(c) != "None", F.col(c)).alias(c) if t == "string" else F.col(c)
                      for c, t in df.dtypes])
    return out.withColumns({c: int_key(out, c) for c in RESULT_ID_COLUMNS if c in out.columns})


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a Parquet result.  Each task writes its own file, so the
    sink is as parallel as the plan feeding it; nothing passes the driver."""
    w = df.write.mode("overwrite").format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def source_profile(df: DataFrame, table: str) -> DataFrame:
    """Row and column count of a source as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(table).alias("table_name"), "row_count",
        F.lit(len(df.columns)).cast("bigint").alias("column_count"))


def keys_frame(spark: SparkSession, keys: Sequence[int], name: str) -> DataFrame:
    """A small ad-hoc key list (e.g. one user typed at a prompt).

    Batch jobs pass a DataFrame of keys instead and never build one here.
    """
    return spark.createDataFrame([(int(k),) for k in keys], T.StructType(
        [T.StructField(name, T.IntegerType(), False)]))
