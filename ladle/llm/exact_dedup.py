"""Exact dedup by skew-safe combining.

Equal texts are found in three combining steps, each keyed by the digest
*and* the full normalised content, so two contents that share a digest are
never merged:

1. local: the partial aggregate of ``groupBy(digest, content, salt)`` folds
   equal texts inside every task before anything is shuffled;
2. salted: the folded rows meet by (digest, content, salt), so a group that
   holds a third of all rows is merged by ``SALTS`` tasks, not by one;
3. global: at most ``SALTS`` winners per content meet by digest and are
   combined once more.

Only then does every document look up its class (a join on the digest whose
hot keys AQE splits, the class side being unique per key).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.llm.registry import query, table
from ladle.llm.ties import one_of_each
from ladle.session import materialize

SALTS = 16
WHITESPACE = r"[\x20\x09-\x0D]+"
# A winner is ordered by (code points, smallest id): one decimal that hash
# aggregation can keep in place, unlike a struct.  10^20 exceeds the span of a long.
_SPAN = 10 ** 20


def _dec(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(21,0)")


def _rank(n_chars: Column, doc_id: Column) -> Column:
    low = F.coalesce(doc_id.cast("decimal(38,0)"), _dec(2 ** 63))
    return (n_chars.cast("decimal(18,0)") * _dec(_SPAN) - low).cast("decimal(38,0)")


def _id_of(best: Column) -> Column:
    """The doc_id inside a rank (inverse of ``_rank``); null for a null id."""
    chars = F.expr(f"(best + cast({2 ** 63} as decimal(20,0))) div cast({_SPAN} as decimal(21,0))")
    low = (chars.cast("decimal(16,0)") * _dec(_SPAN)).cast("decimal(38,0)") - best
    return F.when(low < _dec(2 ** 63), low.cast("decimal(38,0)").cast("long"))


def _sha256(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def signed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", digest=_sha256,
           row: bool = False) -> DataFrame:
    """(doc_id, content, sha, rank): a null text counts as empty; ``rank``
    orders the copies of one text.  ``row=True`` carries the whole input row
    in ``row``.  ``digest`` is replaced only by tests that want collisions."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    carried = [F.struct("*").alias("row")] if row else []
    flat = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), whole.alias("whole"), *carried)
    return (flat.withColumn("content", F.regexp_replace("whole", WHITESPACE, ""))
            .select("doc_id", "content", digest(F.col("content")).alias("sha"),
                    _rank(F.length("whole"), F.col("doc_id")).alias("rank"), *(["row"] if row else [])))


def combine(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """(sha, content, best, group_size): one row per distinct content."""
    local = (rows.withColumn("salt", F.pmod(F.hash("rank"), F.lit(salts)))
             .groupBy("sha", "content", "salt")
             .agg(F.max("rank").alias("best"), F.count(F.lit(1)).alias("n")))
    # At most `salts` rows per content are left, so meeting by digest is balanced.
    return (local.repartition("sha").groupBy("sha", "content")
            .agg(F.max("best").alias("best"), F.sum("n").alias("group_size")))


def _decide(docs: DataFrame, text: str, doc_id: str, salts: int, digest, row: bool) -> DataFrame:
    """The rows of ``signed`` with their class's best and group_size; the
    content is left null where the digest alone names the class."""
    combined = combine(signed(docs, text, doc_id, digest), salts)
    classes = materialize(combined.groupBy("sha").agg(
        F.count(F.lit(1)).alias("contents"), F.max("best").alias("best"),
        F.max("group_size").alias("group_size")), "exact-classes")
    rows = signed(docs, text, doc_id, digest, row)
    carried = ["doc_id", "sha", "rank", *(["row"] if row else [])]
    # Every row has a class; the left join spares a null test that would hash each text twice.
    looked_up = rows.select(*carried).join(classes, "sha", "left").withColumn("content", F.lit(None).cast("string"))
    collided = classes.where("contents > 1").select("sha")
    if collided.isEmpty():
        return looked_up.drop("contents")
    exact = combined.join(collided, "sha", "left_semi")  # several contents under one digest: ask the content
    return (looked_up.where("contents = 1").drop("contents")
            .unionByName(rows.select("content", *carried).join(exact, ["sha", "content"])))


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                salts: int = SALTS, digest=_sha256) -> DataFrame:
    """Class of every document: (doc_id, keep_id, group_size, kept, text_sha256).

    Texts are equal when identical after deleting every space, tab, LF, VT,
    FF and CR.  Of equal texts the one with the most code points in the
    original text stays, then the smallest doc_id.

    * null text: empty; all texts without a word are one group;
    * null doc_id: sorted after every id, so it stays only if no copy of the
      same length has one (then keep_id is null);
    * rows that repeat a doc_id with the same text are the same document and
      share its decision; each counts in group_size;
    * empty table: no rows; other columns of ``docs`` are ignored.
    """
    rows = _decide(docs, text, doc_id, salts, digest, row=False)
    return rows.select("doc_id", _id_of(F.col("best")).alias("keep_id"), "group_size",
                       (F.col("rank") == F.col("best")).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                      salts: int = SALTS, digest=_sha256) -> DataFrame:
    """One row of ``docs``, all columns, of each class of ``exact_dedup``.

    Rows that tie there (a repeated doc_id, or null ones, at the same length)
    are told apart by the number they are written with."""
    rows = _decide(docs, text, doc_id, salts, digest, row=True)
    return one_of_each(rows.where(F.col("rank") == F.col("best")), ["sha", "content"], "exact-kept")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS whole,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY content ORDER BY length(whole) DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY content) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY content ORDER BY length(whole) DESC, doc_id) AS kept,
       sha256(content) AS text_sha256
FROM d
"""


@query("op1_exact_dedup", ORACLE)
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))
