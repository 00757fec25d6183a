"""Alternating least squares whose normal equations are mergeable sums (M8).

MLlib's solver gathers all ratings of a user in one block.  Here no user's
ratings have to meet: the normal equations of a user are a sum over the ratings
(their item factors' outer products, the weighted factors and a count), so
tasks add up parts of a user, and only those partial sums are merged and solved.

* ``partial_sums``: ratings meet the fixed side's factors by a join (a side of
  measured size is broadcast, else AQE splits a hot key).  Up to ``HELD``
  users, a task folds the rows it happens to hold, batch by batch with numpy.
  With more, most rows would leave as sums of one rating, far wider than the
  rating; then ratings are dealt by user first, those of a user with over
  ``HOT`` of them to several tasks, and folded as streams over sorted rows.
* ``solved``: partial sums are dealt by user and salt, merged, dealt by user,
  merged again and solved, each a stream over sorted rows.
* ``fit_factors`` alternates; every side is written to the shared folder, so
  an iteration can be resumed from the last written one.

The regularisation is that of MLlib: ``reg`` times the user's ratings.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.operators.bounded import broadcast_if_small
from ladle.session import materialize

HELD = 20_000   # users whose sums a task holds at a time
HOT = 1_000_000  # ratings of a user dealt to one task
FOLDED = 5_000   # ratings folded at a time
SALTS = 16
_SUMS = "id int, salt int, n long, sums array<double>"


def _packed(rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each kept entry of a symmetric matrix."""
    return np.triu_indices(rank)


def _batch_of(ids: np.ndarray, salt: int, n: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    width = sums.shape[1]
    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(ids) + 1) * width, width), pa.int32()), pa.array(sums.ravel()))
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(np.full(len(ids), salt), pa.int32()),
                                       pa.array(n, pa.int64()), lists], names=["id", "salt", "n", "sums"])


def _folded(ids: np.ndarray, n: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of equal ids added up."""
    order = np.argsort(ids, kind="stable")
    ids, n, sums = ids[order], n[order], sums[order]
    first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]][:len(ids)])
    return ids[first], np.add.reduceat(n, first), np.add.reduceat(sums, first, axis=0)


def _counted(ratings: DataFrame, solve: str, hot: int) -> tuple[int, dict[int, int]]:
    """(ids of the side, {id: tasks its ratings need}) for those of over ``hot`` ratings."""
    counts = ratings.groupBy(F.col(solve).cast("int").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    ids, many = counts.agg(F.count(F.lit(1)), F.collect_list(F.when((F.col("n") > hot) & F.col("id").isNotNull(), F.struct("id", "n")))).first()
    return ids, {r["id"]: -(-r["n"] // hot) for r in many}  # at most one in ``hot`` ratings


def partial_sums(ratings: DataFrame, factors: DataFrame, solve: str, fixed: str, rank: int, held: int = HELD, hot: int = HOT) -> DataFrame:
    """(id, salt, n, sums) of the side ``solve``: per task and id the packed
    outer products of the fixed side's factors, then the weighted factors."""
    joined = ratings.join(broadcast_if_small(factors.withColumnRenamed("id", fixed)), fixed)
    columns = [F.col(solve).cast("int").alias("id"), F.col("rating").cast("double").alias("rating"), "features"]
    rows, cols = _packed(rank)
    ids, many = _counted(ratings, solve, hot)
    dealt = ids > held

    def folds(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for batch in batches:
            for at in range(0, batch.num_rows, FOLDED):
                part = batch.slice(at, FOLDED)
                f = part.column(2).flatten().to_numpy().astype(np.float64).reshape(-1, rank)
                sums = np.concatenate([f[:, rows] * f[:, cols], f * part.column(1).to_numpy()[:, None]], axis=1)
                yield _folded(part.column(0).to_numpy(), np.ones(len(f), np.int64), sums)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        salt = TaskContext.get().partitionId() % SALTS
        if dealt:
            for found in _by_runs(folds(batches)):
                yield _batch_of(found[0], salt, *found[1:])
            return
        parts: list[tuple] = []
        for part in folds(batches):
            parts.append(part)
            if sum(len(p[0]) for p in parts) > held:
                parts = [_folded(*(np.concatenate(x) for x in zip(*parts)))]
        if parts:
            merged = _folded(*(np.concatenate(x) for x in zip(*parts)))
            yield _batch_of(merged[0], salt, *merged[1:])

    if not dealt:
        return joined.select(*columns).mapInArrow(fold, _SUMS)
    ways = F.lit(1)
    if many:
        ways = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in many.items() for x in pair]), F.col(solve).cast("int")), ways)
    part = F.pmod(F.xxhash64(fixed, "rating"), ways).alias("part")
    return (joined.select(*columns, part).repartition("id", "part").sortWithinPartitions("id")
            .select("id", "rating", "features").mapInArrow(fold, _SUMS))


def _sums_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            yield batch.column(0).to_numpy(), batch.column(2).to_numpy(), batch.column(3).flatten().to_numpy().reshape(batch.num_rows, -1)


def _by_runs(parts: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Merged sums of parts sorted by id, complete ids at a time."""
    kept = None
    for part in parts:
        if kept is not None:
            part = tuple(np.concatenate(x) for x in zip(kept, part))
        ids, n, sums = _folded(*part)
        kept = ids[-1:], n[-1:], sums[-1:]  # the last id may go on
        if len(ids) > 1:
            yield ids[:-1], n[:-1], sums[:-1]
    if kept is not None:
        yield kept


def solved(sums: DataFrame, rank: int, reg: float) -> DataFrame:
    """(id, features): the least-squares factors of every id of the partial sums."""
    rows, columns = _packed(rank)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, n, total in _by_runs(_sums_of(batches)):
            yield _batch_of(ids, 0, n, total)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, n, total in _by_runs(_sums_of(batches)):
            matrix = np.zeros((len(ids), rank, rank))
            matrix[:, rows, columns] = total[:, :len(rows)]
            matrix[:, columns, rows] = total[:, :len(rows)]
            matrix[:, np.arange(rank), np.arange(rank)] += reg * n[:, None]
            found = np.linalg.solve(matrix, total[:, len(rows):, None])[:, :, 0].astype(np.float32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(ids) + 1) * rank, rank), pa.int32()), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(ids), lists], names=["id", "features"])

    salted = sums.repartition("id", "salt").sortWithinPartitions("id").mapInArrow(merge, _SUMS)
    return salted.repartition("id").sortWithinPartitions("id").mapInArrow(solve, "id int, features array<float>")


def solve_side(ratings: DataFrame, factors: DataFrame, solve: str, fixed: str, rank: int, reg: float) -> DataFrame:
    """(id, features) of one side, the other side's ``factors`` held fixed."""
    return solved(partial_sums(ratings, factors, solve, fixed, rank), rank, reg)


def start_factors(ratings: DataFrame, side: str, rank: int, seed: int) -> DataFrame:
    """(id, features): a unit vector per id, a function of the id and the seed."""
    bits = [F.pmod(F.xxhash64(F.col("id"), F.lit(seed), F.lit(j)), F.lit(1 << 20)) / F.lit(1 << 20) - 0.5 for j in range(rank)]
    raw = ratings.select(F.col(side).cast("int").alias("id")).distinct().withColumn("raw", F.array(*bits))
    norm = F.sqrt(F.aggregate("raw", F.lit(1e-12).cast("double"), lambda s, x: s + x * x))
    return raw.select("id", F.transform("raw", lambda x: (x / norm).cast("float")).alias("features"))


def _known(ratings: DataFrame, user: str, item: str) -> DataFrame:
    return materialize(ratings.where(F.col(user).isNotNull() & F.col(item).isNotNull() & F.col("rating").isNotNull())
                       .select(user, item, "rating"), "factor-ratings")


def iterated(known: DataFrame, rank: int, reg: float, seed: int, user: str, item: str) -> Iterator[tuple[DataFrame, DataFrame]]:
    """(user factors, item factors) after one iteration, after two, and so on; each is written."""
    users = materialize(start_factors(known, user, rank, seed), "factor-start")
    while True:
        items = materialize(solve_side(known, users, item, user, rank, reg), "factor-items")
        users = materialize(solve_side(known, items, user, item, rank, reg), "factor-users")
        yield users, items


def fit_factors(ratings: DataFrame, rank: int = 10, iterations: int = 10, reg: float = 0.1, seed: int = 42,
                user: str = "authorid", item: str = "recipeid") -> tuple[DataFrame, DataFrame]:
    """(user factors, item factors) after ``iterations``, as MLlib's ``ALS``
    alternates them: items from users, then users from items.

    Rows with a NULL id or rating are left out; rows that repeat a pair each
    count; no ratings: no factors.  All ids are ints.
    """
    return next(islice(iterated(_known(ratings, user, item), rank, reg, seed, user, item), iterations - 1, None))


def tune_factors(train: DataFrame, validation: DataFrame, ranks: Sequence[int], regs: Sequence[float], max_iters: Sequence[int],
                 seed: int = 42, user: str = "authorid", item: str = "recipeid") -> tuple[DataFrame, tuple[DataFrame, DataFrame]]:
    """M11 + M12: ((rank, regParam, maxIter, rmse) best first, the best point's factors).

    The points of one rank and regParam differ only in how far they iterate,
    so one run of the longest scores them all on its way: a grid of 9 ranks, 14
    regParams and 7 maxIters is 126 runs, not 882.  Validation rows of unknown
    users or items drop out, as with MLlib's ``coldStartStrategy="drop"``."""
    known, points, best = _known(train, user, item), [], None
    for rank in ranks:
        for reg in regs:
            for i, (users, items) in enumerate(islice(iterated(known, rank, reg, seed, user, item), max(max_iters)), start=1):
                if i not in max_iters:
                    continue
                error = F.col("rating").cast("double") - F.col("prediction")
                rmse = predicted(validation, users, items, user, item).agg(F.sqrt(F.avg(error * error))).first()[0]
                points.append((int(rank), float(reg), i, rmse))
                if rmse is not None and (best is None or rmse < best[0]):
                    best = rmse, (users, items)
    metrics = train.sparkSession.createDataFrame(points, "rank int, regParam double, maxIter int, rmse double")
    return metrics.orderBy(F.asc_nulls_last("rmse"), "rank", "regParam", "maxIter"), best[1] if best else None


def tune_split(ratings: DataFrame, ranks: Sequence[int], regs: Sequence[float], max_iters: Sequence[int], train_ratio: float = 0.9,
               seed: int = 42, user: str = "authorid", item: str = "recipeid",
               ) -> tuple[DataFrame, tuple[DataFrame, DataFrame] | None, tuple[DataFrame, DataFrame]]:
    """M11 + M12 as ``TrainValidationSplit`` has them: ``ratings`` are split once,
    at random by ``seed``; ``tune_factors`` scores the grid on the validation
    rows; the best point is fitted again to all ratings.  Returns its metrics,
    the factors of that fit (None if no point has an error) and the two sets."""
    dealt = materialize(ratings.select(user, item, "rating").withColumn("_held", F.rand(seed) >= train_ratio), "tuning-split")
    train, validation = dealt.where("not _held").drop("_held"), dealt.where("_held").drop("_held")
    metrics, _ = tune_factors(train, validation, ranks, regs, max_iters, seed, user, item)
    first = metrics.first()
    best = None if first is None or first["rmse"] is None else fit_factors(ratings, first["rank"], first["maxIter"], first["regParam"], seed, user, item)
    return metrics, best, (train, validation)


def predicted(ratings: DataFrame, users: DataFrame, items: DataFrame, user: str = "authorid", item: str = "recipeid") -> DataFrame:
    """``ratings`` with ``prediction``; rows of unknown users or items drop out (M9)."""
    score = F.aggregate(F.zip_with("u", "v", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, x: s + x)
    return (ratings.join(broadcast_if_small(users.select(F.col("id").alias(user), F.col("features").alias("u"))), user)
            .join(broadcast_if_small(items.select(F.col("id").alias(item), F.col("features").alias("v"))), item)
            .withColumn("prediction", score.cast("float")).drop("u", "v"))
