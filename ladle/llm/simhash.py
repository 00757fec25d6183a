"""SimHash near-dedup by covering locality-sensitive hashing.

Each of the 64 fingerprint bits is given a non-zero vector of r + 1 bits
(r = the radius).  For every non-zero vector v of r + 1 bits there is a table
whose mask holds the bits whose vectors have an odd product with v.  Any r
bits leave some v with an even product with all of them, so two fingerprints
that differ in at most r bits agree on that table's whole mask: every linked
pair collides in one of the 2^(r+1) - 1 tables, with certainty.

Copies fold first: only distinct fingerprints are hashed into tables.  A
bucket up to ``LARGEST`` distinct fingerprints is compared inside its task,
and it emits its local components (at most one row per member), never its
pairs.  A larger bucket is split again by the same construction over the bits
its mask leaves free; after three levels at most 2^6 distinct values can
share a bucket, so every bucket is bounded and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.llm.batches import bounded_batches
from ladle.llm.components import components
from ladle.llm.registry import query, table
from ladle.llm.ties import one_of_each
from ladle.session import materialize

SHINGLE = 3
RADIUS = 3
BITS = 64
LARGEST = 1024
SEED = 42
_ALL = (1 << BITS) - 1


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of a text's word shingles, repeats included: a bit is
    set if more than half of the shingles' hashes have it; 0 without words."""
    joined = b" ".join((text or "").encode("utf-8").lower().split())
    if not joined:
        return 0
    ends = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 32).tolist()
    starts = [0, *(e + 1 for e in ends)]
    ends.append(len(joined))
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[s:e], seed) for s, e in zip(starts, ends[shingle - 1:] or ends[-1:])])
    count = len(hashes) // 8
    votes = np.zeros(BITS, dtype=np.int64)
    octets = np.frombuffer(hashes, dtype=np.uint8).reshape(count, 8)
    for i in range(0, count, 1 << 14):  # bounded, however long the text
        votes += np.unpackbits(octets[i:i + (1 << 14)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > count).tobytes(), "big")


def _text_key(text: str) -> Column:
    """Names a text: rows of equal texts have equal fingerprints."""
    return F.sha2(F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b"")), 256)


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                 shingle: int = SHINGLE, keyed: bool = False) -> DataFrame:
    """(doc_id, fp), fp the fingerprint's 64 bits as a signed long; if ``keyed`` the text's digest ``key`` as well."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def signed(texts):
        values = np.fromiter((fingerprint(t, shingle) for t in texts), dtype=np.uint64, count=len(texts))
        return type(texts)(values.view(np.int64))

    carried = [_text_key(text).alias("key")] if keyed else []
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                       signed(F.col(f"`{text}`")).alias("fp"), *carried)


@lru_cache
def masks(free: int = _ALL, radius: int = RADIUS) -> tuple[int, ...]:
    """The covering masks over the set bits of ``free``."""
    bits = [i for i in range(BITS) if free >> i & 1]
    vectors = range(1, 1 << (radius + 1))
    of = {b: k % len(vectors) + 1 for k, b in enumerate(bits)}
    return tuple(sum(1 << b for b in bits if (of[b] & v).bit_count() & 1) for v in vectors)


def free_bits(path: tuple[int, ...], radius: int = RADIUS) -> int:
    """The bits that the masks on the way to a bucket leave free."""
    free = _ALL
    for v in path:
        free &= ~masks(free, radius)[v]
    return free


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << BITS) if mask >> (BITS - 1) else mask)


def _tables(rows: DataFrame, level: int, radius: int) -> DataFrame:
    """Hash rows (fp, path, bucket) into the tables of the next level.

    ``path`` numbers the masks taken so far, ``bucket`` holds the bits they
    fix.  The masks of a path are looked up in an array of fixed size
    (15 entries, 225 at the second level, 3375 at the third)."""
    n = (1 << (radius + 1)) - 1
    table_of = []
    for p in range(n ** level):
        path = []
        for _ in range(level):
            path.append(p % n)
            p //= n
        table_of.extend(masks(free_bits(tuple(reversed(path)), radius), radius))
    lookup = F.array(*[_signed(m) for m in table_of])
    return (rows.select("fp", "path", "bucket", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("v"))
            .select("fp", (F.col("path") * n + F.col("v")).alias("path"), "bucket")
            .select("fp", "path", F.col("bucket").bitwiseOR(F.col("fp").bitwiseAND(F.get(lookup, F.col("path").cast("int"))))
                    .alias("bucket")))


def _link_buckets(path: np.ndarray, bucket: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(u, v): each fingerprint and the smallest of its component inside its
    bucket, over rows sorted by (path, bucket, fp)."""
    n = len(fp)
    if n < 2:
        return fp[:0], fp[:0]
    first = np.r_[True, (path[1:] != path[:-1]) | (bucket[1:] != bucket[:-1])]
    group = np.cumsum(first)
    left, right, d = [], [], 1
    alive = np.arange(n - 1)
    while len(alive):  # links at distance d of the order, in all buckets at once
        alive = alive[alive + d < n]
        alive = alive[group[alive] == group[alive + d]]
        near = np.bitwise_count(fp[alive].view(np.uint64) ^ fp[alive + d].view(np.uint64)) <= radius
        left.append(alive[near].astype(np.int32))
        right.append((alive[near] + d).astype(np.int32))
        d += 1
    a, b = np.concatenate(left), np.concatenate(right)
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    moved = label != np.arange(n)
    return fp[moved], fp[label[moved]]


def _local_links(rows: DataFrame, radius: int) -> DataFrame:
    """Star edges (u, v) of every bucket; buckets are bounded, and a batch of whole buckets is compared at a time."""
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.empty(0, np.int64)] * 3
        schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

        def links(part):
            u, v = _link_buckets(*part, radius)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], schema=schema)

        for batch in batches:
            columns = [np.concatenate([k, batch.column(i).to_numpy(zero_copy_only=False)]) for i, k in enumerate(kept)]
            last = (columns[0] == columns[0][-1]) & (columns[1] == columns[1][-1]) if len(columns[0]) else []
            cut = len(columns[0]) - int(np.count_nonzero(last))  # the last bucket may go on
            yield links([c[:cut] for c in columns])
            kept = [c[cut:] for c in columns]
        yield links(kept)

    return (rows.repartition("path", "bucket").sortWithinPartitions("path", "bucket", "fp")
            .select("path", "bucket", "fp").mapInArrow(linked, "u long, v long"))


def links(fps: DataFrame, radius: int = RADIUS, largest: int = LARGEST) -> DataFrame:
    """Edges (u, v) that connect exactly the components of the distinct
    fingerprints ``fps`` (fp) under distance <= radius."""
    rows = fps.select("fp", F.lit(0).cast("long").alias("path"), F.lit(0).cast("long").alias("bucket"))
    edges = None
    for level in range(3):
        hashed = _tables(rows, level, radius)
        sizes = hashed.groupBy("path", "bucket").count().where("count > 1")
        sizes = materialize(sizes, f"simhash-buckets-{level}")
        large = sizes.where(F.col("count") > largest)
        shared = hashed.join(sizes, ["path", "bucket"])
        bounded = shared.where(F.col("count") <= largest) if level < 2 else shared
        found = _local_links(bounded.select("fp", "path", "bucket"), radius)
        edges = found if edges is None else edges.unionByName(found)
        if level == 2 or large.isEmpty():
            return edges
        rows = materialize(shared.where(F.col("count") > largest).select("fp", "path", "bucket"),
                           f"simhash-dense-{level}")
    return edges


def _rooted(docs: DataFrame, text: str, doc_id: str, shingle: int, radius: int, largest: int, row: bool) -> DataFrame:
    """``near_duplicates`` with the fingerprint ``root`` that tells the components apart.

    Texts are read for their fingerprints once; a row finds its fingerprint
    again by its text's digest."""
    slim = materialize(fingerprints(docs, text, doc_id, shingle, keyed=row), "simhash-fps")
    distinct = materialize(slim.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    of = components(links(distinct.select("fp"), radius, largest)).withColumnRenamed("node", "fp")
    rooted = distinct.join(of, "fp", "left").withColumn("root", F.coalesce("component", "fp"))
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = materialize(rooted.join(named, "root").select("fp", "root", "component_id"), "simhash-components")
    if not row:
        return slim.join(by_fp, "fp")
    by_key = slim.select("key", "fp").distinct().join(by_fp, "fp")
    return (docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), _text_key(text).alias("key"), F.struct("*").alias("row"))
            .join(by_key, "key").drop("key"))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE,
                    radius: int = RADIUS, largest: int = LARGEST, row: bool = False) -> DataFrame:
    """(doc_id, fp, component_id[, row]) of every row; ``component_id`` is the
    smallest doc_id reachable over fingerprints that differ in at most
    ``radius`` bits, the row's own included.

    * null, empty or wordless text: fingerprint 0, linked like any other;
    * null doc_id: the row is a member, but names no component unless all
      members are null (component_id is then null);
    * rows that repeat a doc_id are rows of their own fingerprints;
    * empty table: no rows.
    """
    return _rooted(docs, text, doc_id, shingle, radius, largest, row).drop("root")


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE,
                         radius: int = RADIUS, largest: int = LARGEST) -> DataFrame:
    """One row of ``docs``, all columns, of each component: one whose doc_id
    names it (with a null doc_id only where no member has one).

    Rows that tie there (repeated or null doc_ids, be their texts equal or
    not) are told apart by the number they are written with."""
    rows = _rooted(docs, text, doc_id, shingle, radius, largest, row=True)
    return one_of_each(rows.where(F.col("doc_id").eqNullSafe(F.col("component_id"))), ["root"], "simhash-kept")


@query("op8_simhash_near_dedup")
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
