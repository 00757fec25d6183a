"""Exact cosine top-k that compares each query with few candidates.

Angles between unit vectors obey the triangle inequality, so what is known
about a candidate's angle to some pivot bounds its similarity to a query:

1. ``PIVOTS`` candidates that lie far apart are chosen from a bounded sample.
   Quantiles of the angle part the candidates into rings around each pivot;
   a cell holds those in the same rings around the first few pivots (as many
   as make cells of some ``CELL_SIZE`` members).  It keeps its size and, for
   *every* pivot, the smallest and largest angle of its members.
2. A query's similarity to any member of a cell is at most the cosine of the
   widest gap, over the pivots, between the query's angle and the cell's
   interval.  The query first visits its best cells until they hold ``k``
   candidates; their k-th similarity is a floor for the answer.
3. It then visits just the other cells whose bound reaches that floor (ties
   included); the rest cannot hold a neighbour and is never compared.

The catalog is measured against the pivots once and written with its cells;
both visits stream it past broadcast tables whose bytes are measured (beyond
the bound they are shuffled by cell), and ranking is that of ``neighbours``.
Vectors of unknown width are multiplied in blocks, a cell with its visitors
(``paired.visited_pairs``).
"""

from __future__ import annotations

from dataclasses import dataclass
from math import pi

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladle.functions.columns import dot, round_sim
from ladle.operators.bounded import broadcast_if_small
from ladle.operators.neighbours import TOP_K, ranked, spread
from ladle.operators.paired import plain, visited_pairs
from ladle.session import materialize

PIVOTS = 16
RINGS = 3            # around a pivot, in the cells
CELL_SIZE = 24
MOST_RINGED = 7      # pivots whose rings make the cells: at most RINGS ** MOST_RINGED of them
SAMPLE = 512         # candidates from which pivots are chosen
# Slack of a bound: an angle near zero is only known to about 1e-8, and
# similarities are compared after rounding to nine places.
ANGLE_SLACK = 1e-6
SIM_SLACK = 2e-9


def _product(a: Column, b: Column, dim: int | None) -> Column:
    if dim is not None:
        return dot([a[i] for i in range(dim)], [b[i] for i in range(dim)])
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _angles(vec: Column, pivots: list[list[float]], dim: int | None) -> Column:
    """Angle to every pivot; a zero vector is at a right angle to all."""
    arrays = [F.lit(p) for p in pivots]
    return F.array(*[F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), _product(vec, p, dim)))) for p in arrays])


@dataclass
class PivotIndex:
    """``members``: the candidates with their cell; ``cells``: cell, size and the interval of angles to each pivot."""
    members: DataFrame
    cells: DataFrame
    pivots: list[list[float]]
    dim: int | None


def _far_apart(sample: list[list[float]], n: int) -> list[list[float]]:
    """At most ``n`` of the (bounded) sample, each the farthest from those before it."""
    chosen, nearest = [], [-2.0] * len(sample)
    for _ in range(min(n, len(sample))):
        at = min(range(len(sample)), key=nearest.__getitem__)
        if nearest[at] > 1 - 1e-9:
            break  # only repeats are left
        chosen.append(sample[at])
        nearest = [max(s, sum(x * y for x, y in zip(v, sample[at]))) for s, v in zip(nearest, sample)]
    return chosen


def pivot_index(candidates: DataFrame, dim: int | None, c_item: str = "cand_id", c_vec: str = "c_vec",
                pivots: int = PIVOTS, rings: int = RINGS, cell_size: int = CELL_SIZE) -> PivotIndex:
    """Index of ``candidates`` (``c_item``, ``c_vec``: unit or zero vectors;
    rows without a vector are left out)."""
    known = candidates.select(c_item, c_vec).where(F.col(c_vec).isNotNull())
    length = F.aggregate(c_vec, F.lit(0.0), lambda s, x: s + x * x)
    drawn = known.where(length > 0.5).orderBy(F.xxhash64(c_item), c_item).limit(SAMPLE).select(c_vec).collect()
    held = _far_apart([list(r[0]) for r in drawn], pivots)
    measured = materialize(spread(known, c_item).withColumn("angles", _angles(F.col(c_vec), held, dim) if held else
                                                            F.array().cast("array<double>")), "pivot-angles")
    n, ringed = measured.count(), 0
    while ringed < min(MOST_RINGED, len(held)) and rings ** (ringed + 1) * cell_size <= n:
        ringed += 1
    parts = [i / rings for i in range(1, rings)]
    cuts = (measured.where(length > 0.5).agg(*[F.percentile_approx(F.col("angles")[i], parts, 10_000).alias(f"c{i}") for i in range(ringed)])
            .first() if ringed else [])  # one row of `ringed` short lists
    cell = F.lit(0)
    for i in range(ringed):
        cell = cell * rings + sum((F.col("angles")[i] > c).cast("int") for c in cuts[i])
    # Zero vectors are on no sphere; their similarity is 0 whatever the query.
    members = materialize(measured.withColumn("cell", F.when(length > 0.5, cell).otherwise(-1)), "pivot-members")
    spans = [F.array(*[f(F.col("angles")[i]) for i in range(len(held))]).alias(n) for f, n in ((F.min, "low"), (F.max, "high"))]
    cells = materialize(members.groupBy("cell").agg(F.count(F.lit(1)).alias("size"), *spans), "pivot-cells")
    return PivotIndex(members, cells, held, dim)


def _bounds(queries: DataFrame, index: PivotIndex, query_key: str, q_vec: str) -> DataFrame:
    """(query_key, cell, size, bound): every query with every cell (a bounded
    number of summaries, held as one row's list)."""
    listed = index.cells.agg(F.collect_list(F.struct("cell", "size", "low", "high")).alias("cells"))
    vec = F.col(q_vec)
    zero = F.aggregate(vec, F.lit(0.0), lambda s, x: s + x * x) < 0.5
    each = (queries.select(query_key, zero.alias("zero"), _angles(vec, index.pivots, index.dim).alias("own"))
            .join(F.broadcast(listed)).select(query_key, "zero", "own", F.explode("cells").alias("c")).select(query_key, "zero", "own", "c.*"))
    gaps = F.zip_with("own", F.zip_with("low", "high", lambda lo, hi: F.struct(lo.alias("lo"), hi.alias("hi"))),
                      lambda a, s: F.greatest(a - s["hi"], s["lo"] - a))
    gap = F.least(F.lit(pi), F.greatest(F.lit(0.0), F.coalesce(F.array_max(gaps), F.lit(0.0)) - ANGLE_SLACK))
    bound = F.when(F.col("zero") | (F.col("cell") < 0), F.lit(0.0)).otherwise(F.cos(gap))
    return each.select(query_key, "cell", "size", (bound + SIM_SLACK).alias("bound"))


def _block_width(asked: DataFrame, index: PivotIndex, q_vec: str, c_vec: str, q_item: str, c_item: str) -> int:
    """The width of all vectors if they can be multiplied in blocks, else 0."""
    kinds = (asked.schema[q_item].dataType, index.members.schema[c_item].dataType)
    if index.dim is not None or not all(isinstance(t, (T.IntegerType, T.LongType)) for t in kinds):
        return 0
    width = asked.agg(F.max(F.size(q_vec))).first()[0] or 0
    whole = [df.where(~plain(vec, width)).isEmpty() for df, vec in ((asked, q_vec), (index.members, c_vec))]
    return width if all(whole) else 0


def pruned_neighbours(queries: DataFrame, index: PivotIndex, k: int = TOP_K, query_key: str = "review_id",
                      q_vec: str = "q_vec", c_vec: str = "c_vec", q_item: str = "recipeid", c_item: str = "cand_id",
                      keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(neighbours, visits): the rows of ``ranked_neighbours`` exactly, and
    (query_key, cells, pairs, candidates): how many cells and candidates each
    query was compared with, of how many candidates.

    ``queries`` need unit or zero vectors; rows without a vector have no
    neighbours; ``query_key`` is unique.
    """
    keep = [query_key] + [c for c in (keep or []) if c != query_key]
    asked = materialize(queries.where(F.col(q_vec).isNotNull()).select(*dict.fromkeys([*keep, q_item, q_vec])), "pivot-queries")
    ordered = Window.partitionBy(query_key).orderBy(F.desc("bound"), "cell")
    before = F.sum("size").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    # The query's own item may be among the first k, so one more is asked for.
    bounds = materialize(_bounds(asked, index, query_key, q_vec)
                         .withColumn("first", F.coalesce(before, F.lit(0)) <= k), "pivot-bounds")
    queries_side = broadcast_if_small(asked)

    width = _block_width(asked, index, q_vec, c_vec, q_item, c_item)

    def compared(visits: DataFrame) -> DataFrame:
        if width:
            return visited_pairs(asked, index.members, visits, index.cells, width, k, query_key, q_vec, c_vec, q_item, c_item,
                                 keep).withColumn("sim", round_sim(F.col("sim")))
        visits = visits.drop("size")
        sim = round_sim(_product(F.col(q_vec), F.col(c_vec), index.dim))
        return (index.members.select("cell", c_item, c_vec).join(broadcast_if_small(visits), "cell")
                .join(queries_side, query_key).where(F.col(q_item) != F.col(c_item))
                .select(*keep, c_item, sim.alias("sim"), "floor").where("floor is null or sim >= floor").drop("floor"))

    first = bounds.where("first").select(query_key, "cell", "size", F.lit(None).cast("double").alias("floor"))
    best = materialize(ranked(compared(first), query_key, c_item, k), "pivot-first")
    floors = best.where(F.col("rn") == k).select(query_key, F.col("sim").alias("floor"))
    left = materialize(bounds.where("not first").join(broadcast_if_small(floors), query_key, "left")
                       .where("floor is null or bound >= floor").select(query_key, "cell", "size", "floor"), "pivot-second")
    more = compared(left)
    found = ranked(best.drop("rn").unionByName(more), query_key, c_item, k)
    seen = bounds.where("first").select(query_key, "size").unionByName(left.select(query_key, "size"))
    total = index.cells.agg(F.sum("size").alias("candidates"))
    visits = seen.groupBy(query_key).agg(F.count(F.lit(1)).alias("cells"), F.sum("size").alias("pairs")).join(F.broadcast(total))
    return found, visits


def pruned(queries: DataFrame, candidates: DataFrame, dim: int | None, k: int = TOP_K, query_key: str = "review_id",
           q_vec: str = "q_vec", c_vec: str = "c_vec", q_item: str = "recipeid", c_item: str = "cand_id",
           keep: list[str] | None = None) -> DataFrame:
    """``ranked_neighbours`` by an index built for this call."""
    index = pivot_index(candidates, dim, c_item, c_vec)
    return pruned_neighbours(queries, index, k, query_key, q_vec, c_vec, q_item, c_item, keep)[0]
