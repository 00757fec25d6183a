"""Driver tables and the recommendation-shaped fixtures derived from them.

The fixture texts are plain SQL that runs unchanged in Spark SQL and in
DuckDB.  Table references are written as ``{part}`` placeholders: Spark
binds them to DataFrames through ``spark.sql(text, part=df)`` (no global
temp views, so two scale factors can live in one session), and the
oracle renders them to the plain view names.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events", "documents", "embeddings", "pages",
               "benchmark", "labels", "conversations")

# Fixed fixture texts (the repository's own test inputs, see FIXTURES.md).
RECIPES_SQL = """
select cast(p_partkey as int) as recipeid,
       p_name as name,
       case when p_partkey % 29 = 0 then null else p_type end as recipecategory,
       case when p_partkey % 5 = 0 then concat('PT', cast(p_size as string), 'M')
            when p_partkey % 5 = 1 then concat('PT', cast(p_size % 5 + 1 as string), 'H')
            when p_partkey % 5 = 2 then null
            else concat('PT', cast(p_size % 3 + 1 as string), 'H', cast(p_size as string), 'M')
       end as totaltime,
       cast(p_partkey % 37 as double) as reviewcount,
       case when p_partkey % 31 = 0 then null else p_retailprice end as calories,
       cast(p_size as double) as fatcontent,
       cast((p_partkey * 7) % 101 as double) as sodiumcontent,
       cast((p_partkey * 13) % 89 as double) as carbohydratecontent,
       cast((p_partkey * 3) % 53 as double) as proteincontent,
       case when p_partkey % 23 = 0 then null
            when p_size % 2 = 0 then split(concat(p_name, ' mix serve'), ' ')
            else split(p_name, ' ') end as recipeinstructions,
       split(p_name, ' ') as recipeingredientparts,
       case when p_size % 3 = 0 then split(cast(p_size as string), ' ')
            when p_size % 3 = 1 then split(concat(cast(p_size as string), ' 1'), ' ')
            else split(concat(cast(p_size as string), ' 1 2'), ' ') end as recipeingredientquantities,
       case when p_partkey % 43 = 0 then null
            when p_partkey % 11 = 0 then split('none', ' ')
            else split(concat('http://img.example.com/', cast(p_partkey as string), ' x'), ' ') end as images
from {part}
"""

REVIEWS_SQL = """
select concat(cast(l_orderkey as string), '-', cast(l_linenumber as string), '-',
              cast(l_partkey as string), '-', cast(l_suppkey as string), '-',
              cast(cast(round(l_extendedprice * 100) as bigint) as string)) as review_id,
       cast(case when l_quantity = 50 then l_partkey + 1000000 else l_partkey end as int) as recipeid,
       cast(o_custkey as int) as authorid,
       cast(ceil(l_quantity / 10) as int) as rating,
       case when l_linenumber % 5 = 0 then null
            else concat(o_orderpriority, ' ', l_returnflag) end as review,
       o_orderdate as datesubmitted
from {lineitem} join {orders} on l_orderkey = o_orderkey
"""

REVIEW_LOG_SQL = """
select event_id as review_id,
       cast(regexp_extract(props, '([0-9]+)', 1) as int) as recipeid,
       cast(user_id as int) as authorid,
       cast(floor(value) as int) % 5 + 1 as rating,
       event_type as review,
       ts as datesubmitted
from {events}
"""

FIXTURES = {
    "recipes": (RECIPES_SQL, ("part",)),
    "reviews": (REVIEWS_SQL, ("lineitem", "orders")),
    "review_log": (REVIEW_LOG_SQL, ("events",)),
}


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table; projections and filters above it are pushed
    into the Parquet reader by Catalyst."""
    return spark.read.parquet(table_path(sf_dir, name))


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of ``recipes``, ``reviews``, ``review_log`` as a DataFrame."""
    text, deps = FIXTURES[name]
    frames = {d: base_table(spark, sf_dir, d) for d in deps}
    return spark.sql(text, **frames)


def fixture_sql(name: str) -> str:
    """The same fixture rendered for an engine with registered views."""
    text, deps = FIXTURES[name]
    return text.format(**{d: d for d in deps})


def with_fixtures(body: str, *names: str) -> str:
    """Prefix ``body`` with the named fixtures as CTEs (oracle side)."""
    ctes = ",\n".join(f"{n} as ({fixture_sql(n)})" for n in names)
    return f"with {ctes}\n{body}"
