"""The best candidates of every query by blocks of products.

A task holds a bounded chunk of the queries and streams its candidates past
them: a block of candidates and a block of queries are one matrix product.  It
only decides which pairs may be among a query's best ``k``; their similarities
are then summed again from left to right, as a column expression sums them, so
the values do not depend on the blocks.  A task returns, per query, its best
``k`` and what may tie with the k-th after rounding; ranking is that of
``neighbours``.

Candidates with equal vectors are equally similar, so of a block's copies only
those of the smallest ids are multiplied.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladle.session import materialize

QUERY_BYTES = 32 << 20   # vectors and best lists of the queries that a task holds
QUERIES, CANDIDATES = 512, 4096   # multiplied at a time
# Similarities are compared after rounding to nine places.
SLACK = 2e-9
EXACT = 1 << 14  # pairs summed at a time


class Best:
    """The best ``k`` candidates so far of each of ``n`` queries, and those
    whose similarity is too near the k-th's to be told apart by rounding."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.floor = np.full(n, -np.inf)  # nothing below it is among the best
        self.row, self.ids, self.sims = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)

    def add(self, row: np.ndarray, ids: np.ndarray, sims: np.ndarray) -> None:
        row, ids, sims = np.r_[self.row, row], np.r_[self.ids, ids], np.r_[self.sims, sims]
        order = np.lexsort((ids, -sims, row))
        row, ids, sims = row[order], ids[order], sims[order]
        place = _places(np.r_[True, row[1:] != row[:-1]][:len(row)])
        tied = _places(np.r_[True, (row[1:] != row[:-1]) | (sims[1:] != sims[:-1])][:len(row)])
        last = place == self.k - 1
        self.floor[row[last]] = np.maximum(self.floor[row[last]], sims[last] - SLACK)
        kept = (sims >= self.floor[row]) & (tied < self.k)  # equal ones are ranked by id
        self.row, self.ids, self.sims = row[kept], ids[kept], sims[kept]


def _places(first: np.ndarray) -> np.ndarray:
    """The place of each row in its run; ``first``: where runs begin."""
    starts = np.flatnonzero(first)
    return np.arange(len(first)) - np.repeat(starts, np.diff(np.r_[starts, len(first)]))


def _summed(a: np.ndarray, b: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Products of the pairs, added from left to right."""
    out = np.zeros(len(rows))
    for at in range(0, len(rows), EXACT):
        part = slice(at, at + EXACT)
        products = a[rows[part]] * b[columns[part]]
        for j in range(products.shape[1]):
            out[part] += products[:, j]
    return out


def without_copies(ids: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The candidates without those that ``k`` others of the same vector and
    smaller ids come before, whichever id a query leaves out."""
    _, group = np.unique(np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.shape[1] * 8))).ravel(), return_inverse=True)
    order = np.lexsort((ids, group))
    new = np.r_[True, group[order][1:] != group[order][:-1]][:len(order)]
    same_id = _places(np.r_[True, new[1:] | (ids[order][1:] != ids[order][:-1])][:len(order)])
    most = np.zeros(group.max() + 1, np.int64)  # rows that share an id
    np.maximum.at(most, group[order], same_id + 1)
    kept = np.sort(order[_places(new) < k + most[group[order]]])
    return ids[kept], vectors[kept]


def multiply(best: Best, rows: np.ndarray, queries: np.ndarray, own: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
    """Add the products of the queries ``rows`` of ``best`` (their vectors,
    the ids they leave out) with a block of candidates."""
    order = np.argsort(own, kind="stable")
    low, high = np.searchsorted(own[order], ids), np.searchsorted(own[order], ids, side="right")
    column = np.repeat(np.arange(len(ids)), high - low)
    left_out = order[_places(np.r_[True, column[1:] != column[:-1]][:len(column)]) + low[column]]
    lengths = np.sqrt((queries * queries).sum(axis=1))
    error = 1e-15 * queries.shape[1] * lengths * np.sqrt((vectors * vectors).sum(axis=1).max())  # of a matrix product
    for at in range(0, len(rows), QUERIES):
        part = slice(at, at + QUERIES)
        sims = queries[part] @ vectors.T
        mine = (left_out >= at) & (left_out < at + QUERIES)
        sims[left_out[mine] - at, column[mine]] = -np.inf
        least = best.floor[rows[part]] - error[part]
        better = np.flatnonzero(sims.max(axis=1) >= least)
        if not len(better):
            continue
        sims, least = sims[better], least[better]
        if len(ids) > best.k:
            kth = np.partition(sims, len(ids) - best.k, axis=1)[:, len(ids) - best.k]
            least = np.maximum(least, kth - SLACK - 2 * error[part][better])
        r, c = np.nonzero((sims >= least[:, None]) & (sims > -np.inf))
        r = better[r] + at
        best.add(rows[r], ids[c], _summed(queries, vectors, r, c))


def plain(vec: str, width: int | Column) -> Column:
    """Whether a vector has ``width`` finite values."""
    finite = F.forall(vec, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))  # NaN is above infinity
    return F.coalesce((F.size(vec) == width) & finite, F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, width)


def best_pairs(queries: DataFrame, candidates: DataFrame, width: int, k: int, q_vec: str, c_vec: str, q_item: str,
               c_item: str, keep: list[str], query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(keep, c_item, sim): pairs of other items that hold the best ``k`` of
    every query by the similarity rounded to nine places, then id.

    Vectors are ``plain``, items are integers; pairs with a NULL item drop out.
    Queries are taken in chunks of at most ``query_bytes``, one broadcast each.
    """
    known = queries.where(F.col(q_item).isNotNull()).select(*dict.fromkeys([*keep, q_item, q_vec]))
    held = materialize(known.withColumn("_at", F.monotonically_increasing_id()), "paired-chunks")
    chunks = max(1, -(-held.count() * (8 * width + 48 * k) // query_bytes))
    dealt = candidates.where(F.col(c_item).isNotNull()).select(c_item, c_vec)
    schema = T.StructType([*[queries.schema[c] for c in keep], candidates.schema[c_item], T.StructField("sim", T.DoubleType())])
    parts = [_chunk_pairs(held.where(F.col("_at") % chunks == i).drop("_at"), dealt, width, k, q_vec, q_item, keep, schema)
             for i in range(chunks)]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def _broadcast(chunk: DataFrame):
    """A chunk of queries as one Arrow stream."""
    table = chunk.toArrow()  # at most ``query_bytes``
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return chunk.sparkSession.sparkContext.broadcast(sink.getvalue().to_pybytes())


def _chunk_pairs(chunk: DataFrame, dealt: DataFrame, width: int, k: int, q_vec: str, q_item: str, keep: list[str], schema: T.StructType) -> DataFrame:
    held = _broadcast(chunk)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = pa.ipc.open_stream(held.value).read_all()
        vectors = matrix(asked.column(q_vec), width)
        own = asked.column(q_item).to_numpy().astype(np.int64)
        best, rows, kind = Best(len(own), k), np.arange(len(own)), pa.int64()
        for batch in batches:
            kind = batch.schema.field(0).type
            for at in range(0, batch.num_rows if len(own) else 0, CANDIDATES):
                part = batch.slice(at, CANDIDATES)
                ids = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                multiply(best, rows, vectors, own, *without_copies(ids, matrix(part.column(1), width), k))
        for at in range(0, len(best.row), 1 << 16):
            part = slice(at, at + (1 << 16))
            columns = [asked.column(c).take(pa.array(best.row[part])).combine_chunks() for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(best.ids[part]).cast(kind), pa.array(best.sims[part])], names=schema.fieldNames())

    return dealt.mapInArrow(stream, schema)


def visited_pairs(queries: DataFrame, members: DataFrame, visits: DataFrame, cells: DataFrame, width: int, k: int, query_key: str,
                  q_vec: str, c_vec: str, q_item: str, c_item: str, keep: list[str], query_bytes: int = QUERY_BYTES) -> DataFrame:
    """``best_pairs`` of only those queries and ``members`` whose cell they
    visit: ``visits`` (query_key, cell, size, floor; similarities below the
    floor are not asked for), ``cells`` (cell, size), a unique ``query_key``.

    A group is at most some ``CANDIDATES`` members of a cell with the numbers of its visitors.
    """
    spark = queries.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = materialize(queries.where(F.col(q_item).isNotNull()).withColumn("_at", F.monotonically_increasing_id()), "paired-chunks")
    chunks = max(1, -(-held.count() * (8 * width + 48 * k) // query_bytes))
    ways = F.ceil(F.col("size") / CANDIDATES)
    blocks = (members.where(F.col(c_item).isNotNull()).join(F.broadcast(cells.select("cell", "size")), "cell")
              .select("cell", F.pmod(F.xxhash64(c_item), ways).alias("part"), c_item, c_vec).repartition(n, "cell", "part"))
    schema = T.StructType([*[queries.schema[c] for c in keep], members.schema[c_item], T.StructField("sim", T.DoubleType())])
    found = None
    for i in range(chunks):
        chunk = held.where(F.col("_at") % chunks == i)
        asked = (visits.join(chunk.select(query_key, "_at"), query_key)
                 .select("cell", F.explode(F.sequence(F.lit(0).cast("long"), ways - 1)).alias("part"), "_at", "floor").repartition(n, "cell", "part"))
        multiplied = blocks.groupBy("cell", "part").cogroup(asked.groupBy("cell", "part")).applyInArrow(
            _visit(_broadcast(chunk), width, k, q_vec, c_vec, q_item, c_item, keep, schema.fieldNames()), schema)
        found = multiplied if found is None else found.unionByName(multiplied)
    return found


def _visit(held, width: int, k: int, q_vec: str, c_vec: str, q_item: str, c_item: str, keep: list[str], names: list[str]):
    def visit(block: pa.Table, visitors: pa.Table) -> pa.Table:
        asked = pa.ipc.open_stream(held.value).read_all()
        numbers = asked.column("_at").to_numpy()
        order = np.argsort(numbers)
        at = order[np.searchsorted(numbers[order], visitors.column("_at").to_numpy())]
        mine, best = asked.take(pa.array(at)), Best(len(at), k)
        best.floor = visitors.column("floor").to_numpy().astype(np.float64) - SLACK
        best.floor[np.isnan(best.floor)] = -np.inf
        if len(at) and block.num_rows:
            ids = block.column(c_item).to_numpy().astype(np.int64)
            multiply(best, np.arange(len(at)), matrix(mine.column(q_vec), width), mine.column(q_item).to_numpy().astype(np.int64),
                     *without_copies(ids, matrix(block.column(c_vec), width), k))
        columns = [mine.column(c).take(pa.array(best.row)) for c in keep]
        return pa.Table.from_arrays([*columns, pa.array(best.ids).cast(block.schema.field(c_item).type), pa.array(best.sims)], names=names)

    return visit
