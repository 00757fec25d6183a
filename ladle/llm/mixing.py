"""Mixing sources to target weights, with DataFrame operations only.

Every document gets a hash-random key (the md5 of its id), so a prefix of a
source in key order is a uniform sample that every rerun repeats.  Keys are
uniform, so equal key ranges hold equal shares of a source: the first 32 key
bits, scaled by the source's number of ranges, *are* the range partitioning,
without sampling, and a source with a third of all rows simply has more
ranges.  Word counts are summed per range (map-side); exclusive prefix sums,
first over blocks of a source's ranges, then over the ranges of one block, find
the range that holds its cut.  No source is sorted as a whole: only that range
is, to place the cut at the exact word, which gives the rows that a full range
sort would.  A target above the source's size repeats whole epochs before the
cut.

What is left is one row per source (epochs, cut key, words of the cut
document), so applying the mix is a scan joined with a source-sized table,
broadcast once its bytes are measured.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ladle.llm.registry import query, table
from ladle.operators.bounded import broadcast_if_small
from ladle.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)       # of the sources in code point order, repeating
MAX_EPOCHS = 3
ROWS_PER_RANGE = 4000     # mean rows of a key range
SEED = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(doc_id: Column, seed: str = SEED) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


BLOCK_BITS = 10  # ranges of a block, as a power of two


def sized(docs: DataFrame, text: str, doc_id: str, source: str, seed: str, row: bool = False) -> DataFrame:
    """(doc_id, source, size, key) of every row, and the row itself if asked for."""
    carried = [F.struct("*").alias("row")] if row else []
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"),
                       word_count(F.col(f"`{text}`")).alias("size"),
                       random_key(F.col(f"`{doc_id}`"), seed).alias("key"), *carried)


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add weight and target to (source, source_size, n_rows): weighted
    shares of all words, each stopped at ``max_epochs`` times its source and
    the excess reshared by weight.

    Sources fill up in order of cap / weight, so one pass in that order gives
    the final level: a source is full when the level left by the fuller ones
    before it reaches its cap.  The windows run over one row per source.
    """
    everything = Window.partitionBy(F.lit(0))
    rank = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = (sources.withColumn("weight", weight.cast("long"))
              .withColumn("cap", F.col("source_size") * max_epochs))
    by_fill = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.sum("cap").over(everything) / max_epochs - F.coalesce(F.sum("cap").over(before), F.lit(0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    filled = (ranked.withColumn("level", level)
              .withColumn("full", F.col("level") >= F.col("cap") / F.col("weight")))
    final = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("weight") * final)
    return (filled.withColumn("target", target)
            .select("source", "source_size", "n_rows", "weight", "target"))


def cuts(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
         rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """One row per source: (source, source_size, target, epochs, cut_key,
    cut_id, cut_size, cut_words).  In (key, doc_id, size) order every
    document before the cut is taken once more than ``epochs`` times, and
    ``cut_words`` words of the one at the cut."""
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    budget = F.floor("target").cast("long")
    plan = (materialize(targets(per_source, weights, max_epochs), "mix-targets")
            .withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size"))
                        .otherwise(F.lit(0)).cast("long"))
            .withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
            .withColumn("ranges", F.ceil(F.col("n_rows") / rows_per_range).cast("long"))
            .withColumnRenamed("source", "of"))
    top = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    ranged = (rows.join(broadcast_if_small(plan), F.col("source").eqNullSafe(F.col("of")))
              .withColumn("range", F.shiftright(top * F.col("ranges"), 32)))
    per_range = ranged.groupBy("of", "range").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    # Prefix sums in two levels: over blocks of ranges, then over the ranges of the block with the cut.
    per_range = materialize(per_range.withColumn("block", F.shiftright("range", BLOCK_BITS)), "mix-ranges")
    crossed = (F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") >= F.col("rest"))
    in_source = lambda by: F.sum("words").over(Window.partitionBy("of").orderBy(by)) - F.col("words")
    blocks = per_range.groupBy("of", "block").agg(F.sum("words").alias("words"), F.first("rest").alias("rest"))
    block = (blocks.withColumn("before", in_source("block")).where(crossed)
             .select(F.col("of").alias("block_of"), F.col("block").alias("cut_block"), F.col("before").alias("upto")))
    at = (per_range.join(block, F.col("of").eqNullSafe(F.col("block_of")) & (F.col("block") == F.col("cut_block")))
          .withColumn("before", F.col("upto") + in_source("range")).where(crossed)
          .select(F.col("of").alias("cut_of"), F.col("range").alias("cut_range"), "before"))
    # Only the range of the cut is sorted; repeated rows of one document are one entry.
    entries = (ranged.join(at, F.col("of").eqNullSafe(F.col("cut_of")) & (F.col("range") == F.col("cut_range")))
               .groupBy("of", "key", "doc_id", "size")
               .agg(F.count(F.lit(1)).alias("copies"), F.first("before").alias("before"), F.first("rest").alias("rest")))
    ordered = Window.partitionBy("of").orderBy("key", "doc_id", "size")
    total = F.col("size") * F.col("copies")
    crossing = (entries.withColumn("upto", F.col("before") + F.sum(total).over(ordered))
                .withColumn("start", F.col("upto") - total)
                .where((F.col("start") < F.col("rest")) & (F.col("upto") >= F.col("rest")))
                .select(F.col("of").alias("cut_of"), F.col("key").alias("cut_key"), F.col("doc_id").alias("cut_id"),
                        F.col("size").alias("cut_size"),
                        F.expr("(rest - start) div copies").alias("cut_words")))
    return (plan.join(crossing, F.col("of").eqNullSafe(F.col("cut_of")), "left")
            .select(F.col("of").alias("cut_source"), "source_size", "target", "epochs",
                    "cut_key", "cut_id", "cut_size", "cut_words"))


def _taken(rows: DataFrame, cut: DataFrame) -> DataFrame:
    """``rows`` with source_size, target, epochs and ``part``, the words taken beyond whole epochs."""
    joined = rows.join(cut, F.col("source").eqNullSafe(F.col("cut_source")), "left")
    low = F.struct(F.col("key"), F.col("doc_id"), F.col("size"))
    at = F.struct(F.col("cut_key"), F.col("cut_id"), F.col("cut_size"))
    part = (F.when(F.col("cut_key").isNull(), F.lit(0)).when(low < at, F.col("size"))
            .when(low == at, F.col("cut_words")).otherwise(F.lit(0)))
    return joined.withColumn("part", part.cast("long"))


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED,
        rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row.

    * null or empty text: size 0, taken 0; a null source is a source of its
      own, ranked last; the empty string is another;
    * null doc_id: keyed as the word "null"; rows that repeat a doc_id and a
      size are one entry of the order, and share the cut evenly (each takes
      the same whole number of words);
    * a source without words has target 0; an empty table gives no rows.
    """
    rows = materialize(sized(docs, text, doc_id, source, seed), "mix-sized")
    out = _taken(rows, broadcast_if_small(cuts(rows, weights, max_epochs, rows_per_range), pin=True))
    return out.select("doc_id", "size", "source_size", "target",
                      (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"))


def mixed_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source",
                    n_chars: str = "n_chars", weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
                    seed: str = SEED, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """The mix as documents: every row once per time it is taken; of the
    document at a source's cut the last copy holds its first words only.
    ``n_chars`` (if there) is set anew where a text is cut.  A document of no
    words is part of no mix."""
    slim = materialize(sized(docs, text, doc_id, source, seed), "mix-sized")
    cut = broadcast_if_small(cuts(slim, weights, max_epochs, rows_per_range), pin=True)
    rows = _taken(sized(docs, text, doc_id, source, seed, row=True), cut)
    whole = F.col("epochs") + F.when(F.col("part") >= F.col("size"), 1).otherwise(0)
    words = F.when(F.col("part") < F.col("size"), F.col("part")).otherwise(F.lit(0))
    copies = F.concat(F.array_repeat(F.lit(0).cast("long"), whole.cast("int")),
                      F.when(words > 0, F.array(words)).otherwise(F.array().cast("array<bigint>")))
    each = rows.where("size > 0").select("row", F.explode(copies).alias("words"))
    space = r"[\x20\x09-\x0D]+"
    cut = (each.withColumn("bare", F.when(F.col("words") > 0, F.regexp_replace(F.col(f"row.`{text}`"), "^" + space, "")))
           # The last of words + 1 pieces is what follows the cut's white space; there is one, as words < size.
           .withColumn("rest", F.split("bare", space, (F.col("words") + 1).cast("int"))[F.col("words").cast("int")])
           .withColumn("bare", F.regexp_replace(F.expr("left(bare, length(bare) - length(rest))"), space + "$", "")))
    out = F.col("row").withField(f"`{text}`", F.coalesce(F.col("bare"), F.col(f"row.`{text}`")))
    if n_chars in docs.columns:
        chars = F.length("bare").cast(docs.schema[n_chars].dataType)
        out = out.withField(f"`{n_chars}`", F.coalesce(chars, F.col(f"row.`{n_chars}`")))
    return cut.select(out.alias("row")).select("row.*")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, 'null')) AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, sum(sum(size)) OVER ()::BIGINT AS total,
             (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
      FROM d GROUP BY source),
f AS (SELECT *, (total - coalesce(sum(3 * source_size) OVER b, 0))::DOUBLE
                / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
      FROM s WINDOW b AS (ORDER BY 3 * source_size / weight, source NULLS LAST
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, level >= 3 * source_size / weight AS filled FROM f),
t AS (SELECT source, source_size,
             CASE WHEN filled THEN (3 * source_size)::DOUBLE
                  ELSE weight * max(CASE WHEN NOT filled THEN level END) OVER () END AS target FROM g),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs,
             sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS upto
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       epochs * size + greatest(0, least(size, floor(target)::BIGINT - epochs * source_size - (upto - size))) AS taken
FROM p
"""


@query("op3_mix_sources", ORACLE)
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
