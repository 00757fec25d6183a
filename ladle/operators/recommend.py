"""Rating model operators.

ALS is MLlib's blocked alternating least squares: user and item factors
live in blocks that are shuffled between executors each iteration.  The
block count is a parameter (MLlib makes user blocks x item blocks rating
blocks, so it must not follow the core count), and long runs checkpoint
their lineage to the session's checkpoint directory.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.operators.bounded import broadcast_if_small
from ladle.operators.products import all_products, top_products
from ladle.session import ensure_checkpoint_dir, materialize

USER, ITEM, RATING = "authorid", "recipeid", "rating"

# The full tuning grid of the original job (9 x 14 x 7 = 882
# fits), the default of ``tune_als``.
FULL_GRID_RANKS = [1, 5, 10, 15, 20, 25, 50, 75, 100]
FULL_GRID_REG_PARAMS = [0.000000001, 0.0000001, 0.00001, 0.01, 0.03, 0.1, 0.3, 1, 3, 10, 15, 25, 50, 100]
FULL_GRID_MAX_ITERS = [5, 10, 15, 25, 50, 100, 150]


def _md5_bucket(key: str, salt: str, buckets: int) -> Column:
    h = F.conv(F.substring(F.md5(F.concat(F.lit(salt), F.col(key).cast("string"))), 1, 8), 16, 10)
    return F.pmod(h.cast("bigint"), F.lit(buckets))


def md5_split(df: DataFrame, key: str, salt: str = "", buckets: int = 10,
              test_bucket: int = 0) -> tuple[DataFrame, DataFrame]:
    """M7, reproducible: a row is in the test set when the first 8 hex
    digits of ``md5(salt || key)`` fall in ``test_bucket`` modulo
    ``buckets`` (1/buckets of the rows).  Same split in any SQL engine."""
    b = _md5_bucket(key, salt, buckets)
    return df.filter(b != test_bucket), df.filter(b == test_bucket)


def md5_split_written(df: DataFrame, key: str, salt: str = "", buckets: int = 10, test_bucket: int = 0,
                      label: str = "split") -> tuple[DataFrame, DataFrame]:
    """The rows of ``md5_split`` from one written table, for a log that is
    read many times.  Only test rows keep ``key``, which is wider than a
    rating; the training set comes without that column.  A null key is in
    neither set."""
    test = _md5_bucket(key, salt, buckets) == test_bucket
    rest = [c for c in df.columns if c != key]
    rows = materialize(df.where(F.col(key).isNotNull()).select(
        F.when(test, F.col(key)).alias(key), *rest), label)
    return rows.where(F.col(key).isNull()).select(*rest), rows.where(F.col(key).isNotNull()).select(*df.columns)


def random_split(df: DataFrame, train_fraction: float = 0.9, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """M7 as the reference: ``randomSplit([0.9, 0.1], seed)``."""
    train, test = df.randomSplit([train_fraction, 1.0 - train_fraction], seed)
    return train, test


# MLlib's default; the job this mirrors leaves it so.
ALS_BLOCKS = 10
MAX_ALS_BLOCKS = 200
RATINGS_PER_BLOCK = 20_000_000
# MLlib drops the shuffle files of the iterations before a checkpoint; until
# then each leaves the factors on disk once per block that needs them.
CHECKPOINT_EVERY = 2
# Blocks and factors wait on disk: kept in memory (MLlib's default), those of
# one fit or of several at once leave no room for the tasks that build blocks.
HELD_ON = "DISK_ONLY"


def blocks_for(n_ratings: int) -> int:
    """Blocks for a rating log: MLlib's default, more only where a user or
    item block would hold more than ``RATINGS_PER_BLOCK`` ratings, and never
    more than ``MAX_ALS_BLOCKS`` (its square is the number of rating blocks)."""
    return min(MAX_ALS_BLOCKS, max(ALS_BLOCKS, -(-n_ratings // RATINGS_PER_BLOCK)))


def als_estimator(spark, rank: int = 10, max_iter: int = 10, reg_param: float = 0.1,
                  seed: int | None = 42, cold_start: str = "nan", blocks: int = ALS_BLOCKS) -> ALS:
    ensure_checkpoint_dir(spark)
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg_param, userCol=USER, itemCol=ITEM,
              ratingCol=RATING, implicitPrefs=False, coldStartStrategy=cold_start,
              numUserBlocks=blocks, numItemBlocks=blocks,
              checkpointInterval=CHECKPOINT_EVERY,
              intermediateStorageLevel=HELD_ON, finalStorageLevel=HELD_ON)
    if seed is not None:
        als = als.setSeed(seed)
    return als


def fit_als(train: DataFrame, rank: int = 10, max_iter: int = 10, reg_param: float = 0.1,
            seed: int | None = 42, blocks: int | None = None) -> ALSModel:
    """M8: explicit-feedback ALS, rank 10, other parameters at MLlib defaults;
    ``blocks`` follows the counted ratings unless given."""
    ratings = train.select(USER, ITEM, RATING)
    blocks = blocks_for(ratings.count()) if blocks is None else blocks
    est = als_estimator(train.sparkSession, rank, max_iter, reg_param, seed, blocks=blocks)
    return est.fit(ratings)


def predict(model: ALSModel, test: DataFrame) -> DataFrame:
    """M9: score held-out rows; unseen users or items give NaN and are dropped."""
    return model.transform(test).na.drop()


def rmse(predictions: DataFrame, label: str = RATING, prediction: str = "prediction") -> DataFrame:
    """Root mean squared error as a one-row DataFrame (n, rmse)."""
    err = F.col(label).cast("double") - F.col(prediction).cast("double")
    return predictions.agg(F.count(F.lit(1)).alias("n"),
                           F.sqrt(F.avg(err * err)).alias("rmse"))


def rmse_value(predictions: DataFrame) -> float:
    """M10 with MLlib's evaluator (a driver-side scalar, as a report value)."""
    ev = RegressionEvaluator(metricName="rmse", labelCol=RATING, predictionCol="prediction")
    return ev.evaluate(predictions)


def tune_als(train: DataFrame, ranks: Sequence[int] = FULL_GRID_RANKS,
             reg_params: Sequence[float] = FULL_GRID_REG_PARAMS,
             max_iters: Sequence[int] = FULL_GRID_MAX_ITERS, train_ratio: float = 0.9, seed: int = 42,
             parallelism: int = 2, blocks: int | None = None) -> tuple[ALSModel, DataFrame]:
    """M11 + M12: grid search with a train/validation split; returns the best
    model and ``(rank, regParam, maxIter, rmse)`` ordered best first.  The
    grid is an argument whose default is the original's 882 points;
    ``parallelism`` fits several grid points at once; ``blocks`` follows the
    counted ratings unless given."""
    spark = train.sparkSession
    blocks = blocks_for(train.count()) if blocks is None else blocks
    als = als_estimator(spark, cold_start="drop", seed=seed, blocks=blocks)
    grid = (ParamGridBuilder().addGrid(als.rank, list(ranks))
            .addGrid(als.regParam, list(reg_params)).addGrid(als.maxIter, list(max_iters)).build())
    ev = RegressionEvaluator(metricName="rmse", labelCol=RATING, predictionCol="prediction")
    tvs = TrainValidationSplit(estimator=als, estimatorParamMaps=grid, evaluator=ev,
                               trainRatio=train_ratio, seed=seed, parallelism=parallelism)
    fitted = tvs.fit(train.select(USER, ITEM, RATING))
    rows = [(int(pm[als.rank]), float(pm[als.regParam]), int(pm[als.maxIter]), float(m))
            for pm, m in zip(fitted.getEstimatorParamMaps(), fitted.validationMetrics)]
    metrics = spark.createDataFrame(rows, "rank int, regParam double, maxIter int, rmse double")
    return fitted.bestModel, metrics.orderBy("rmse", "rank", "regParam", "maxIter")


def save_model(model: ALSModel, path: str) -> None:
    """Overwrite a saved model (the reference's ``model.mode`` does not exist, D1)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> ALSModel:
    """S10."""
    return ALSModel.load(path)


def recommend_for_users(model: ALSModel, users: DataFrame | None, n: int = 5) -> DataFrame:
    """Top-``n`` items for each user in ``users`` (a DataFrame of ids,
    never a driver list).  Reviewed items are not excluded; users unknown
    to the model produce no row.  ``users=None`` means every user the model
    knows — the same rows as passing every author of its training log, with
    no distinct over that log.  The rows are those of MLlib's blocked cross
    join, found by ``recommend_bounded``."""
    return recommend_bounded(model, n, only=users)


def known_users(model: ALSModel) -> DataFrame:
    """Users the model has factors for: exactly the users that
    ``recommend_for_users`` returns a row for (given a non-empty catalog),
    without computing any recommendation."""
    return model.userFactors.select(F.col("id").alias(USER))


def recommend_for_items(model: ALSModel, items: DataFrame | None, n: int = 5) -> DataFrame:
    """Top-``n`` users for each item in ``items``; ``None`` means every
    item the model knows."""
    return recommend_bounded(model, n, for_items=True, only=items)


def _sides(model: ALSModel, for_items: bool) -> tuple[DataFrame, str, DataFrame, str]:
    users, items = (model.userFactors, USER), (model.itemFactors, ITEM)
    return (*items, *users) if for_items else (*users, *items)


def _recommended(found: DataFrame, key: str, other: str) -> DataFrame:
    pairs = F.transform(F.arrays_zip("best_ids", "best"), lambda p: F.struct(
        p["best_ids"].cast("int").alias(other), p["best"].cast("float").alias("rating")))
    return found.select(F.col("id").cast("int").alias(key), pairs.alias("recommendations"))


def recommend_bounded(model: ALSModel, n: int = 5, for_items: bool = False, only: DataFrame | None = None) -> DataFrame:
    """M13 / M14 for every known user (or item), or those of ``only``, without
    the blocked cross join: the same layout and rows as ``recommendForAllUsers``
    / ``-Items``, found by norm-ordered chunks (``products.top_products``);
    ties are ordered by id."""
    asked, key, held, other = _sides(model, for_items)
    if only is not None:
        asked = asked.join(only.select(F.col(key).alias("id")).distinct(), "id", "left_semi")
    return _recommended(top_products(asked, held, n), key, other)


def recommend_all_pairs(model: ALSModel, n: int = 5, for_items: bool = False) -> DataFrame:
    """The same by every product of a user with an item (``products.all_products``):
    what ``recommend_bounded`` is checked against."""
    asked, key, held, other = _sides(model, for_items)
    return _recommended(all_products(asked, held, n), key, other)


def wide_recommendations(recs: DataFrame, catalog: DataFrame, n: int, key: str = USER,
                         item: str = ITEM, score: str = "rating",
                         array_col: str = "recommendations") -> DataFrame:
    """P7 + J4: ``key, recipeid1, name1, rating1, … recipeid{n}, name{n},
    rating{n}`` from an array of ``(recipeid, rating)`` structs.

    One explode, one join with the catalog names, one regroup — instead
    of ``n`` joins.  The names side is broadcast only after a bounded size
    check; otherwise AQE shuffles it (and splits an item recommended to
    very many users).  Missing ranks and unknown ids stay NULL.
    """
    names = catalog.select(F.col("recipeid").alias("_item"), F.col("name").alias("_name"))
    names = names.groupBy("_item").agg(F.min("_name").alias("_name"))
    # posexplode_outer keeps a key whose array is empty (one row of NULLs).
    long = recs.select(key, F.posexplode_outer(array_col).alias("_pos", "_rec")).select(
        key, "_pos", F.col("_rec")[item].alias("_item"), F.col("_rec")[score].alias("_score"))
    joined = long.join(broadcast_if_small(names), "_item", "left")
    # At most n picks per key: gathered as one list and read by position
    # (a max over the text column would sort instead of hash).
    picks = joined.groupBy(key).agg(F.collect_list(F.struct("_pos", "_item", "_name", "_score")).alias("_picks"))
    cols = []
    at_position = lambda i: F.get(F.filter("_picks", lambda p: p["_pos"] == i), F.lit(0))
    for i in range(n):
        at = at_position(i)
        cols += [at["_item"].alias(f"{item}{i + 1}"), at["_name"].alias(f"name{i + 1}"),
                 at["_score"].alias(f"{score}{i + 1}")]
    return picks.select(key, *cols)


def wide_item_recommendations(recs: DataFrame, catalog: DataFrame, n: int) -> DataFrame:
    """Q10 layout: ``recipeid, name, recipecategory, authorid1, rating1, …``
    (one category column, D14)."""
    cat = (catalog.groupBy("recipeid").agg(F.min(F.struct("name", "recipecategory")).alias("_c"))
           .select("recipeid", "_c.name", "_c.recipecategory"))
    cols = [F.col("recommendations")[i][c].alias(f"{c}{i + 1}")
            for i in range(n) for c in (USER, "rating")]
    return (recs.join(broadcast_if_small(cat), "recipeid", "left")
            .select("recipeid", "name", "recipecategory", *cols))
