"""Next-item sequences per author (F5 J3 W1 W2 Q6), safe under key skew.

``lead`` over ``Window.partitionBy(author)`` sends every review of an
author to one task; if one author holds a third of the log, that task
holds a third of the data.  ``leads`` counts rows per author first; the
authors under a hot threshold use that plain window, and the rows of hot
authors get the same values without a per-author task:

1. ``repartitionByRange`` on ``(key, order…)``: Spark samples the full
   composite key, so a hot key's rows spread over many contiguous ranges.
2. Each (key, range) *fragment* is small; ``lead`` runs per fragment.
3. The first two rows of every fragment form a small *heads* table (at
   most two rows per fragment).  For each fragment, the heads that follow
   it in the same key supply the leads of its last two rows.  The join
   uses the window's partition key, so only the small table moves.

Ordinary keys cost one hash shuffle (the window).  Rows of hot keys cost
a range exchange and a hash exchange on (key, fragment); both have
bounded partitions whatever the key distribution.  The fragmented table
is checkpointed once so both uses of it agree on the fragment ids.  The
order must be total, so callers pass a unique tie-breaker as the last
order column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladle.operators.bounded import MAX_BROADCAST_ROWS, broadcast_bounded
from ladle.session import ensure_checkpoint_dir, materialize

_LEAD1, _LEAD2 = "_lead1", "_lead2"


def _key_value(df: DataFrame, key: str):
    """A never-NULL stand-in for ``key``; paired with ``isnull(key)`` it
    separates the NULL group from every real value, so plain equi-joins
    and window partitions can use it."""
    dtype = df.schema[key].dataType
    if isinstance(dtype, T.NumericType):
        return F.coalesce(F.col(key), F.lit(0).cast(dtype))
    if isinstance(dtype, T.StringType):
        return F.coalesce(F.col(key), F.lit(""))
    return F.coalesce(F.col(key).cast("string"), F.lit(""))


# A key with more rows than this is "hot": its rows are split over many
# tasks.  Any other key's rows fit comfortably in one task.
HOT_KEY_ROWS = 1_000_000
# A sample up to this size is paired with the later rows of its keys; a larger
# one is looked up in their sorted ranges.  The rows are the same.
JOINED_SAMPLE = 1_000
# Rows taken at first for each row of a sample, and how many times more at each further try.
TAKEN = 4


def key_counts(df: DataFrame, key: str = "authorid") -> DataFrame:
    """Rows per key (``key``, ``_cnt``), a partial aggregate written once
    under the checkpoint directory: one row per key, read by every filter
    that needs the counts instead of re-scanning the fact table."""
    return materialize(df.groupBy(key).agg(F.count(F.lit(1)).alias("_cnt")), f"{key}-counts")


def leads(df: DataFrame, key: str, order: Sequence[str], value: str,
          partitions: int | None = None, hot_key_rows: int = HOT_KEY_ROWS,
          counts: DataFrame | None = None) -> DataFrame:
    """Add ``_lead1`` / ``_lead2``: structs ``(ok, v)`` of the next and
    second-next row of the same ``key`` in ``order``; NULL when absent.

    Keys are counted first (a partial aggregate, or ``counts`` from
    ``key_counts`` over these rows or over a superset that keeps every row
    of each key).  Rows of keys with at most ``hot_key_rows`` rows take a
    plain window partitioned by key; rows of hot keys take the
    range-fragment path, in enough fragments (``2 * hot rows /
    hot_key_rows``, unless ``partitions`` is given) that none holds more than
    about ``hot_key_rows`` rows.  The hot key list, at most ``rows /
    hot_key_rows`` keys, is written once; the joins with it are Spark's
    choice from the table's bytes.
    """
    cols = df.columns
    nxt = F.struct(F.lit(True).alias("ok"), F.col(value).alias("v"))
    kdf = df.withColumn("_kv", _key_value(df, key)).withColumn("_kn", F.col(key).isNull())
    if counts is None:
        hot = (kdf.groupBy("_kv", "_kn").agg(F.count(F.lit(1)).alias("_cnt"))
               .filter(F.col("_cnt") > hot_key_rows))
    else:
        hot = (counts.filter(F.col("_cnt") > hot_key_rows)
               .select(_key_value(counts, key).alias("_kv"), F.col(key).isNull().alias("_kn"), "_cnt"))
    hot = materialize(hot, "hot-keys")
    n_hot, hot_rows = hot.agg(F.count(F.lit(1)), F.sum("_cnt")).first()
    hot = hot.select("_kv", "_kn")
    cold = kdf.join(hot, ["_kv", "_kn"], "left_anti") if n_hot else kdf
    w = Window.partitionBy("_kv", "_kn").orderBy(*order)
    out = cold.select(*cols, F.lead(nxt, 1).over(w).alias(_LEAD1), F.lead(nxt, 2).over(w).alias(_LEAD2))
    if n_hot:
        split = kdf.join(hot, ["_kv", "_kn"], "left_semi").drop("_kv", "_kn")
        n = partitions or max(2, -(-2 * hot_rows // max(1, hot_key_rows)))
        out = out.unionByName(_fragment_leads(fragments(split, key, order, n), df.columns, order, value))
    return out


def fragments(df: DataFrame, key: str, order: Sequence[str], partitions: int) -> DataFrame:
    """``df`` range-partitioned on (key, order) into ``partitions`` fragments,
    with ``_frag``, ``_kv`` and ``_kn``.

    Range bounds are sampled per exchange, so the fragmented table is
    written once with a reliable checkpoint (shared checkpoint directory):
    every reader, and every recomputation after an executor loss, sees the
    same ids.  The count is explicit, so AQE merges no fragments."""
    ensure_checkpoint_dir(df.sparkSession)
    return (df.repartitionByRange(partitions, key, *order)
            .withColumn("_frag", F.spark_partition_id())
            .withColumn("_kv", _key_value(df, key))
            .withColumn("_kn", F.col(key).isNull())
            .checkpoint(eager=True))


def _fragment_leads(ranged: DataFrame, cols: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Leads for rows of hot keys from their ``fragments``: window per
    fragment + boundary patch."""
    nxt = F.struct(F.lit(True).alias("ok"), F.col(value).alias("v"))
    grp = ["_kv", "_kn", "_frag"]
    w = Window.partitionBy(*grp).orderBy(*order)
    local = (ranged.withColumn("_l1", F.lead(nxt, 1).over(w))
             .withColumn("_l2", F.lead(nxt, 2).over(w))
             .withColumn("_rn", F.row_number().over(w)))

    heads = local.filter(F.col("_rn") <= 2).select(*grp, "_rn", value)
    hw = Window.partitionBy("_kv", "_kn").orderBy("_frag", "_rn")
    tails = (heads.withColumn("_n1", F.lead(nxt, 1).over(hw))
             .withColumn("_n2", F.lead(nxt, 2).over(hw))
             .withColumn("_next_frag", F.lead("_frag", 1).over(hw))
             .filter(F.col("_next_frag").isNull() | (F.col("_next_frag") != F.col("_frag")))
             .select(*grp, "_n1", "_n2"))

    # The join key is the window's partition key, so ``local`` keeps its
    # partitioning and only the small ``tails`` table (one row per
    # fragment) moves.  Only the last two rows of a fragment use it.
    j = local.join(tails, grp, "left")
    lead1 = F.when(F.col("_l1").isNull(), F.col("_n1")).otherwise(F.col("_l1"))
    lead2 = (F.when(F.col("_l1").isNull(), F.col("_n2"))
             .when(F.col("_l2").isNull(), F.col("_n1"))
             .otherwise(F.col("_l2")))
    return j.select(*cols, lead1.alias(_LEAD1), lead2.alias(_LEAD2))


def frequent_key_rows(df: DataFrame, key: str = "authorid", more_than: int = 2,
                      counts: DataFrame | None = None) -> DataFrame:
    """F5 + J3: rows whose key has more than ``more_than`` rows.  The count
    is a partial aggregate written once (``counts`` from ``key_counts``);
    the filter is a left-semi join against that table.  Spark broadcasts it
    where its bytes allow (then the big side is not shuffled); otherwise AQE
    splits a skewed key's partition."""
    if counts is None:
        counts = key_counts(df, key)
    keys = counts.filter(F.col("_cnt") > more_than).select(key)
    return df.join(keys, key, "left_semi")


def drop_latest(df: DataFrame, key: str = "authorid",
                order: Sequence[str] = ("datesubmitted", "review_id"),
                counts: DataFrame | None = None) -> DataFrame:
    """Every row except each key's last one in ``order``."""
    return (leads(df, key, order, order[-1], counts=counts)
            .filter(F.col(_LEAD1).isNotNull()).drop(_LEAD1, _LEAD2))


def next_item(df: DataFrame, key: str = "authorid",
              order: Sequence[str] = ("datesubmitted", "review_id"),
              value: str = "recipeid", out: str = "nextrecipeid",
              holdout: bool = False, counts: DataFrame | None = None) -> DataFrame:
    """W1 + W2: drop each key's latest row, then add the next row's
    ``value``.

    Default (as the reference, D4): the lead is taken *after* the latest
    row is removed, so each key's last kept row has a NULL target.  With
    ``holdout=True`` the lead is taken first and the removed row is the
    target of the row before it.
    """
    l = leads(df, key, order, value, counts=counts).filter(F.col(_LEAD1).isNotNull())
    if holdout:
        target = F.col(_LEAD1)["v"]
    else:
        target = F.when(F.col(_LEAD2).isNotNull(), F.col(_LEAD1)["v"])
    return l.withColumn(out, target).drop(_LEAD1, _LEAD2)


def md5_order(key: str, salt: str):
    """Reproducible pseudo-random order keyed on ``key`` (same in DuckDB)."""
    return F.md5(F.concat(F.lit(salt), F.col(key).cast("string")))


def sample_rows(df: DataFrame, n: int, key: str = "review_id", salt: str = "7-",
                seed: int | None = None) -> DataFrame:
    """L4: ``n`` pseudo-random rows.  ``seed`` gives ``rand(seed)`` order;
    otherwise an md5 order that an SQL engine can reproduce.  Spark keeps a
    top-``n`` per task and merges them (TakeOrderedAndProject)."""
    order = F.rand(seed) if seed is not None else md5_order(key, salt)
    return df.orderBy(order, F.col(key)).limit(n)


def _latest(features: DataFrame, frequent: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """(_of, _last): the id of each frequent key's latest row."""
    first, rest, rid = order[0], list(order[1:]) or [order[0]], order[-1]
    return (features.select(key, *order)
            .join(frequent, (F.col(key) == F.col("_of")) & F.col(first).eqNullSafe(F.col("_first")))
            .groupBy("_of").agg(F.max(F.struct(*rest))[rid].alias("_last")))


def _few_latest(features: DataFrame, frequent: DataFrame, rows: DataFrame, bound: int, key: str, order: Sequence[str]) -> DataFrame:
    """``_latest`` for the keys of at most ``bound`` ``rows``, written once; the log streams past the broadcast keys."""
    keys = broadcast_bounded(rows.select(F.col(key).alias("_of")).distinct(), bound)
    few = broadcast_bounded(frequent.join(keys, "_of", "left_semi"), bound)
    return broadcast_bounded(materialize(_latest(features, few, key, order), f"{key}-few-latest"), bound)


def _without_latest(rows: DataFrame, latest: DataFrame, key: str, rid: str) -> DataFrame:
    """``rows`` of the keys of ``latest`` but each key's latest one."""
    return rows.join(latest, F.col(key) == F.col("_of")).filter(F.col(rid) != F.col("_last")).drop("_of", "_last")


def _drawn(features: DataFrame, frequent: DataFrame, n: int, wanted: int, key: str, order: Sequence[str], salt: str) -> DataFrame | None:
    """The ``n`` rows of the sample where the first ``wanted`` rows in its order hold them, else None."""
    rid = order[-1]
    taken = sample_rows(features, wanted, rid, salt).checkpoint(eager=True)
    latest = _few_latest(features, frequent, taken, wanted, key, order)
    sample = sample_rows(_without_latest(taken, latest, key, rid), n, rid, salt).checkpoint(eager=True)
    return sample if sample.count() == n or taken.count() < wanted else None


def next_item_sample(features: DataFrame, n: int = 20, key: str = "authorid",
                     holdout: bool = False, salt: str = "7-", seed: int | None = None,
                     order: Sequence[str] = ("datesubmitted", "review_id"),
                     value: str = "recipeid", out: str = "nextrecipeid",
                     by_ranges: bool | None = None, hot_key_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Q6: frequent authors → drop latest → next recipe → sample ``n`` rows.

    Only the ``n`` sampled rows need a next item, so the sample is drawn
    first and the sequence work is done for it alone; ``features`` is read
    several times, so callers pass a written table:

    1. one author-grain table (a hash aggregate of the whole log, written
       once) gives each key's row count and latest date (keys with more than
       two rows are kept, F5);
    2. rows are taken in the sample's order (per-task top-n) and those of
       other keys and each key's latest row are left out.  The latest row is
       the largest id among the rows of the key's latest date, looked up for
       the keys of the rows taken: they are broadcast, the log is not
       shuffled.  Where fewer than ``n`` rows remain, more are taken, and in
       the end (or with ``seed``) all rows are joined with the table;
    3. the bounded sample is broadcast against the kept rows of the same
       keys that come later in ``order``; a partial ``min(struct)`` per
       sampled row yields its next item, so a prolific author costs no
       single task anything.

    That pairs every sampled row with all later ones of its key.  For a sample
    of more than ``JOINED_SAMPLE`` rows (or with ``by_ranges=True``) step 3 is
    an as-of lookup instead: the rows of the sampled keys are sorted once
    (``leads``: a hot key over many ranges, a table of the ranges' first rows
    for the successors of their last ones), and a sampled row's next item is
    its successor, whatever ``n``.

    Same rows and values as ``sample_rows(next_item(...), n)``; ``seed``
    switches the md5 order to ``rand(seed)`` (the reference's random pick).
    """
    rid = order[-1]
    counts = features.groupBy(key).agg(F.count(F.lit(1)).alias("_cnt"), F.max(order[0]).alias("_first"))
    frequent = materialize(counts.filter(F.col("_cnt") > 2).select(F.col(key).alias("_of"), "_first"), f"{key}-frequent")
    ensure_checkpoint_dir(features.sparkSession)
    sample = None
    wanted = TAKEN * n
    while seed is None and sample is None and wanted <= MAX_BROADCAST_ROWS:
        sample = _drawn(features, frequent, n, wanted, key, order, salt)
        wanted *= TAKEN
    if sample is None:
        stats = materialize(_latest(features, frequent, key, order), f"{key}-latest")
        # The sample is read three times below and again by every consumer; it
        # holds at most n rows, so it is materialised once (reliable checkpoint).
        sample = sample_rows(_without_latest(features, stats, key, rid), n, rid, salt, seed).checkpoint(eager=True)
    own = _few_latest(features, frequent, sample, n, key, order)
    if holdout:
        pool = features.join(own.drop("_last"), F.col(key) == F.col("_of")).drop("_of")
    else:
        pool = _without_latest(features, own, key, rid)
    if by_ranges or by_ranges is None and n > JOINED_SAMPLE:
        follows = (leads(pool.select(*dict.fromkeys([key, *order, value])), key, order, value, hot_key_rows=hot_key_rows).select(F.col(rid).alias("_sid"), F.col(_LEAD1).alias("_next"))
                   .join(broadcast_bounded(sample.select(F.col(rid).alias("_sid")), n), "_sid", "left_semi"))
        return (sample.join(broadcast_bounded(follows, n), F.col(rid) == F.col("_sid"), "left")
                .withColumn(out, F.col("_next")["v"]).drop("_sid", "_next").checkpoint(eager=True))
    probe = sample.select(F.col(key).alias("_k"), F.col(rid).alias("_sid"),
                          F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]).alias("_spos"))
    later = (pool.select(key, F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]).alias("_pos"),
                         F.col(value).alias("_v"))
             .join(broadcast_bounded(probe, n), (F.col(key) == F.col("_k")) & (F.col("_pos") > F.col("_spos")))
             .groupBy("_sid").agg(F.min(F.struct("_pos", "_v")).alias("_next")))
    return (sample.join(broadcast_bounded(later, n), F.col(rid) == F.col("_sid"), "left")
            .withColumn(out, F.col("_next")["_v"]).drop("_sid", "_next")
            .checkpoint(eager=True))
