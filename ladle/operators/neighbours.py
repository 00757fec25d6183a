"""Cosine neighbours of sampled reviews and the next-recipe score (Q7).

Set-based, with no per-query driver loop and no query vector baked into
the plan as literals:

* the sample is measured and broadcast — in chunks if its bytes are above
  the broadcast bound — and the catalog streams past it (dealt over
  ``spark.sql.shuffle.partitions`` tasks): every catalog row
  meets every query vector in the task that read it, and the catalog is
  never shuffled for the pairing;
* the similarity is a flat sum of products (codegen, no UDF), rounded to
  ``SIM_SCALE`` places so ranks do not depend on summation order; only
  ``(query, candidate, sim)`` leaves the pairing;
* vectors of unknown width are multiplied in blocks (``paired``), and only
  what may be among a query's best leaves a task;
* candidates are ranked in two levels: the best ``k`` of each of
  ``RANK_BUCKETS`` buckets of pairing tasks (with a partial
  ``WindowGroupLimit``, so at most ``k`` pairs of a query leave a task), then
  the best ``k`` of a query's at most ``k * RANK_BUCKETS``;
* one ``groupBy(query)`` reads the top three and the rank of the expected
  next recipe from the ranked rows; names are looked up afterwards for the
  few ids the (bounded, checkpointed) result mentions.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladle.functions.columns import as_text, dot, round_sim
from ladle.session import ensure_checkpoint_dir, materialize
from ladle.operators.bounded import MAX_BROADCAST_BYTES, broadcast_bounded, size_in_bytes
from ladle.operators.paired import best_pairs, plain

# Fixed value: length of the ranked list the score is read from.
TOP_K = 1000
# Buckets of tasks in the first ranking level.
RANK_BUCKETS = 64
# Fixed value: number of suggestions reported per query.
N_SUGGEST = 3


def _pair_scores(queries: DataFrame, candidates: DataFrame, dim: int | None, q_vec: str,
                 c_vec: str, q_item: str, c_item: str, keep: list[str]) -> DataFrame:
    if dim is not None:
        # Known width: a flat sum of products, compiled into the stage.
        sim = dot([F.col(q_vec)[i] for i in range(dim)], [F.col(c_vec)[i] for i in range(dim)])
    else:
        # Any width: higher-order array functions (still JVM-side).
        sim = F.aggregate(F.zip_with(q_vec, c_vec, lambda a, b: a * b), F.lit(0.0),
                          lambda acc, x: acc + x)
    # Only narrow columns leave the pairing: the vectors are consumed here.
    return (candidates.join(F.broadcast(queries), F.col(q_item) != F.col(c_item), "inner")
            .select(*keep, c_item, round_sim(sim).alias("sim")))


def ranked_neighbours(queries: DataFrame, candidates: DataFrame, dim: int | None, k: int = TOP_K,
                      query_key: str = "review_id", q_vec: str = "q_vec", c_vec: str = "c_vec",
                      q_item: str = "recipeid", c_item: str = "cand_id",
                      keep: list[str] | None = None) -> DataFrame:
    """J13 + P13 + W4: the ``k`` most similar candidates per query, ranked by
    rounded similarity then candidate id; the query's own item is excluded (F4).

    Output: ``query_key``, ``keep`` columns, ``c_item``, ``sim``, ``rn``.
    The queries' bytes are measured; above ``MAX_BROADCAST_BYTES`` they are
    split into chunks by a hash of their key and each chunk is broadcast on
    its own; the union is exact.  The pairing itself is |queries| x
    |candidates| products, as the task asks for.  Without a ``dim`` it is
    done in blocks, where items are integers and vectors complete.
    """
    keep = [query_key] + [c for c in (keep or []) if c != query_key]
    candidates = spread(candidates, c_item)
    integral = all(isinstance(df.schema[c].dataType, (T.IntegerType, T.LongType)) for df, c in ((queries, q_item), (candidates, c_item)))
    if dim is None and integral:
        return ranked(_block_pairs(queries, candidates, k, q_vec, c_vec, q_item, c_item, keep), query_key, c_item, k)
    return ranked(_all_pairs(queries, candidates, dim, q_vec, c_vec, q_item, c_item, keep), query_key, c_item, k)


def _all_pairs(queries: DataFrame, candidates: DataFrame, dim: int | None, q_vec: str, c_vec: str,
               q_item: str, c_item: str, keep: list[str]) -> DataFrame:
    size = size_in_bytes(queries)
    chunks = math.ceil(2 * size / MAX_BROADCAST_BYTES) if size > MAX_BROADCAST_BYTES else 1
    parts = []
    for c in range(chunks):
        q = queries if chunks == 1 else queries.filter(
            F.pmod(F.xxhash64(F.col(keep[0])), F.lit(chunks)) == c)
        parts.append(_pair_scores(q, candidates, dim, q_vec, c_vec, q_item, c_item, keep))
    pairs = parts[0]
    for p in parts[1:]:
        pairs = pairs.unionByName(p)
    return pairs


def _block_pairs(queries: DataFrame, candidates: DataFrame, k: int, q_vec: str, c_vec: str,
                 q_item: str, c_item: str, keep: list[str]) -> DataFrame:
    """The pairs that hold every query's best: blocks of products for the
    vectors of the queries' width, every pair with any other (missing values,
    another width)."""
    queries = materialize(queries.select(*dict.fromkeys([*keep, q_item, q_vec])), "paired-queries")
    width = queries.where(plain(q_vec, F.size(q_vec))).agg(F.max(F.size(q_vec))).first()[0]
    if not width:
        return _all_pairs(queries, candidates, None, q_vec, c_vec, q_item, c_item, keep)
    candidates = materialize(candidates.select(c_item, c_vec), "paired-candidates")
    whole, other = queries.where(plain(q_vec, width)), queries.where(~plain(q_vec, width))
    pairs = best_pairs(whole, candidates.where(plain(c_vec, width)), width, k, q_vec, c_vec, q_item, c_item, keep)
    pairs = pairs.withColumn("sim", round_sim(F.col("sim")))
    odd = candidates.where(~plain(c_vec, width))
    for q, c in ((other, candidates), (whole, odd)):
        if not (other if q is other else odd).isEmpty():
            pairs = pairs.unionByName(_all_pairs(q, c, None, q_vec, c_vec, q_item, c_item, keep))
    return pairs


def ranked(pairs: DataFrame, query_key: str, c_item: str, k: int) -> DataFrame:
    """The best ``k`` of each query's pairs with their rank ``rn``, in two levels."""
    bucketed = _bucketed(pairs)
    best = [F.desc("sim"), F.asc(c_item)]
    first = Window.partitionBy(query_key, "_bucket").orderBy(*best)
    some = bucketed.withColumn("_rb", F.row_number().over(first)).filter(F.col("_rb") <= k).drop("_rb", "_bucket")
    w = Window.partitionBy(query_key).orderBy(*best)
    return some.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= k)


def _bucketed(pairs: DataFrame) -> DataFrame:
    """All pairs of a task are of one bucket: its partial limit then holds for a query's whole list there."""
    return pairs.withColumn("_bucket", F.spark_partition_id() % RANK_BUCKETS)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal ``df`` over ``spark.sql.shuffle.partitions`` tasks by ``key`` (a
    catalog in one file would otherwise pair in a single task).  The pairing
    does |queries| times the work of this one shuffle."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


_WORDS = ["first", "second", "third"]


def score_suggestions(ranked: DataFrame, query_key: str = "review_id", c_item: str = "cand_id",
                      target: str = "nextrecipeid", k: int = TOP_K) -> DataFrame:
    """P16 + W5: top three ids (NULL when fewer) and the score
    ``(k + 1 - rank) / k`` of the expected next item, 0 if it is not ranked."""
    aggs = [F.max(F.when(F.col("rn") == i, F.col(c_item))).alias(f"{w}suggestid")
            for i, w in enumerate(_WORDS[:N_SUGGEST], start=1)]
    hit = F.when(F.col(c_item) == F.col(target), (F.lit(k + 1) - F.col("rn")) / F.lit(k))
    aggs.append(F.coalesce(F.max(hit), F.lit(0.0)).alias("score"))
    return ranked.groupBy(query_key).agg(*aggs)


def suggestions(sample: DataFrame, candidates: DataFrame, names: DataFrame, dim: int,
                n_queries: int, k: int = TOP_K, neighbours=ranked_neighbours) -> DataFrame:
    """Q7: neighbour suggestions with score for each sampled review.

    ``sample``: review_id, authorid, recipeid, name, nextrecipeid, normfeatures
    (query space; at most ``n_queries`` rows).  ``candidates``: recipeid,
    normfeatures (catalog space).  ``names``: recipeid, name — the catalog.
    Queries whose every candidate is excluded still appear, with NULL
    suggestions and score 0.  ``neighbours`` finds the ranked candidates
    (``pivots.pruned`` gives the same rows with fewer comparisons).
    """
    q = sample.select("review_id", "recipeid", "nextrecipeid", F.col("normfeatures").alias("q_vec"))
    c = candidates.select(F.col("recipeid").alias("cand_id"), F.col("normfeatures").alias("c_vec"))
    found = neighbours(q, c, dim, k, keep=["nextrecipeid"])
    # At most n_queries rows, read twice below: materialise once.
    ensure_checkpoint_dir(sample.sparkSession)
    scored = score_suggestions(found, k=k).checkpoint(eager=True)
    base = sample.select("review_id", "authorid", "recipeid", "name", "nextrecipeid")
    out = base.join(broadcast_bounded(scored, n_queries), "review_id", "left").withColumn(
        "score", F.coalesce("score", F.lit(0.0)))
    # J12 and the suggestion names: the catalog is cut to the (at most 4n)
    # ids the result mentions by a semi-join against the bounded result,
    # then looked up; the catalog itself is never broadcast.
    id_cols = [f"{w}suggestid" for w in _WORDS[:N_SUGGEST]] + ["nextrecipeid"]
    wanted = out.select(F.explode(F.array(*[F.col(x) for x in id_cols])).alias("recipeid")).filter(
        F.col("recipeid").isNotNull())
    looked = (names.join(broadcast_bounded(wanted, (N_SUGGEST + 1) * n_queries), "recipeid", "left_semi")
              .groupBy("recipeid").agg(F.min("name").alias("_nm")))
    looked = broadcast_bounded(looked, (N_SUGGEST + 1) * n_queries)
    for x in id_cols:
        label = "expect_recipe" if x == "nextrecipeid" else x.replace("id", "name")
        out = (out.join(looked.select(F.col("recipeid").alias("_id"), F.col("_nm").alias(label)),
                        F.col(x) == F.col("_id"), "left").drop("_id"))
    return out.select(
        "review_id", F.col("authorid").alias("reviewerid"), "recipeid",
        F.col("name").alias("recipe_name"),
        "firstsuggestid", "firstsuggestname", "secondsuggestid", "secondsuggestname",
        "thirdsuggestid", "thirdsuggestname", "score",
        F.col("nextrecipeid").alias("expect_id"), "expect_recipe")


# Column order of the text result the storefront reads.
TEXT_RESULT_COLUMNS = ["reviewerid", "recipeid", "recipe_name", "firstsuggestid",
                       "firstsuggestname", "secondsuggestid", "secondsuggestname",
                       "thirdsuggestid", "thirdsuggestname", "score", "expect_id",
                       "expect_recipe"]


def as_text_result(result: DataFrame) -> DataFrame:
    """The compatible result layout — every column text (NULL as
    ``None``) except the double ``score``."""
    return result.select(*[F.col(c) if c == "score" else as_text(c).alias(c)
                           for c in TEXT_RESULT_COLUMNS])


def unit_vectors(df: DataFrame, key: str, vec: str, name: str) -> DataFrame:
    """(name_id, name_vec): vectors of any width scaled to length one; a zero vector stays zero."""
    v = F.transform(F.col(vec), lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(F.transform(v, lambda x: x * x), F.lit(0.0), lambda a, x: a + x))
    # Inside a lambda the norm would be summed again for every coordinate.
    norms = F.array_repeat(norm, F.size(v))
    return df.select(F.col(key).alias(name + "_id"),
                     F.zip_with(v, norms, lambda x, n: F.when(n == 0, F.lit(0.0)).otherwise(x / n)).alias(name + "_vec"))


def embedding_neighbours(queries: DataFrame, items: DataFrame, k: int = 3,
                         key: str = "vec_id", vec: str = "embedding", neighbours=ranked_neighbours) -> DataFrame:
    """P13 on an embedding table: cosine top-``k`` of each query vector among
    all other items.  Vectors of any width are normalised and multiplied
    with higher-order array functions (JVM-side); the pairing, chunked
    broadcast and partial top-k are those of ``ranked_neighbours``."""
    found = neighbours(unit_vectors(queries, key, vec, "q"), unit_vectors(items, key, vec, "c"), None, k, query_key="q_id",
                       q_vec="q_vec", c_vec="c_vec", q_item="q_id", c_item="c_id")
    return found.select(F.col("q_id").alias(key), F.col("rn").alias("rank"),
                         F.col("c_id").alias("neighbour_id"), F.round("sim", 6).alias("similarity"))
