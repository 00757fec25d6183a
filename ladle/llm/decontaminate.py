"""Benchmark decontamination by winnowing.

A document word is contaminated if it lies inside an occurrence of a window of
``WINDOW`` consecutive words of a benchmark item (of all its words, where an
item has fewer).

1. Every window of n words holds the same number of k-word grams (k = (n + 1)
   // 2); the smallest gram hash in it is its fingerprint.  Neighbouring
   windows mostly share theirs, so one fingerprint stands for a run of windows,
   and equal windows have equal fingerprints: no shared window is missed.
2. The item windows' fingerprints are set in a bit array (two bits each, at
   most 64 MB whatever the benchmark's size, built by Spark's bitmap
   aggregates) that goes to all tasks.  Documents are winnowed in their scan;
   only windows whose fingerprint the array may hold leave it.
3. Such hits are extended to the windows around them: windows and item windows
   meet by their words (not by a hash).  A common window meets one row of
   the table of distinct item windows, whose join AQE splits, so no task sees
   all documents that share a passage with all items that do.
4. Documents that hold the same set of item windows have the same items, which
   are looked up once for each such set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ladle.llm.batches import bounded_batches, text_slices
from ladle.llm.registry import query, table
from ladle.session import materialize

WINDOW = 10
SEGMENT = 1 << 20          # bytes hashed at a time
SMALLEST_BITS, LARGEST_BITS = 22, 29
BITS_PER_ENTRY = 64
_BUCKET_BITS = 32_768      # of Spark's bitmap aggregates
_BASE = 0x9E3779B97F4A7C15
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[ord("0"):ord("9") + 1] = _IN_WORD[ord("a"):ord("z") + 1] = True
_IN_WORD[128:] = True      # every character beyond ASCII


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


class Powers:
    """Powers of the rolling hash's base and of its inverse, and byte values."""

    def __init__(self, size: int):
        inverse = pow(_BASE, -1, 1 << 64)
        self.up = np.cumprod(np.r_[np.uint64(1), np.full(size, _BASE, np.uint64)])
        self.down = np.cumprod(np.r_[np.uint64(1), np.full(size, inverse, np.uint64)])
        self.values = np.random.default_rng(12).integers(1, 1 << 63, 256, dtype=np.uint64)


class Words:
    """Lower-cased words of several texts held in one byte buffer."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, powers: Powers):
        self.bytes = _LOWER[data]
        inside = _IN_WORD[self.bytes]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cuts = offsets[(offsets > 0) & (offsets < len(data))]
        first[cuts] = inside[cuts]
        last[cuts - 1] = inside[cuts - 1]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.text = np.searchsorted(offsets, self.starts, side="right") - 1
        self.hashes = self._hash(powers)

    def _hash(self, powers: Powers) -> np.ndarray:
        out, at = np.empty(len(self.starts), np.uint64), 0
        while at < len(out):
            low = self.starts[at]
            stop = max(at + 1, int(np.searchsorted(self.ends, low + SEGMENT, side="right")))
            part = self.bytes[low:self.ends[stop - 1]]
            held = powers if len(part) <= SEGMENT else Powers(len(part))
            sums = np.r_[np.uint64(0), np.cumsum(held.values[part] * held.up[:len(part)])]
            a, b = self.starts[at:stop] - low, self.ends[at:stop] - low
            out[at:stop] = (sums[b] - sums[a]) * held.down[a]
            at = stop
        return _mixed(out)

    def fingerprints(self, n: int) -> np.ndarray:
        """Of every run of n words (also those across texts): its smallest gram hash."""
        k = (n + 1) // 2
        if len(self.hashes) < n:
            return np.empty(0, np.uint64)
        grams = np.zeros(len(self.hashes) - k + 1, np.uint64)
        for i in range(k):
            grams = grams * np.uint64(_BASE) + self.hashes[i:len(self.hashes) - k + 1 + i]
        grams = _mixed(grams)
        least, width, span = grams, n - k + 1, 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        least = np.minimum(least[:len(least) - (width - span)], least[width - span:])
        return _mixed(least + np.uint64(n))

    def whole(self, n: int) -> np.ndarray:
        """Which runs of n words lie in one text."""
        return self.text[:len(self.text) - n + 1] == self.text[n - 1:] if len(self.text) >= n else np.empty(0, bool)

    def said(self, at: int, n: int) -> str:
        return b" ".join(self.bytes[a:b].tobytes() for a, b in
                         zip(self.starts[at:at + n].tolist(), self.ends[at:at + n].tolist())).decode("utf-8")


_powers: list[Powers] = []


def _worker_powers() -> Powers:
    if not _powers:
        _powers.append(Powers(SEGMENT))
    return _powers[0]


def _words(texts: pa.Array) -> Words:
    """Of a string array without nulls."""
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return Words(held, offsets[:-1] - offsets[0], _worker_powers())


def item_windows(items: DataFrame, text: str, item_id: str, window: int) -> DataFrame:
    """(item_id, n, fp, said): every window of every item, its words joined by spaces."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in text_slices(batch):
                words = _words(texts)
                counts = np.bincount(words.text, minlength=len(texts))
                for n in np.unique(np.minimum(counts, window)).tolist():
                    if n == 0:
                        continue
                    runs = words.whole(n) & (np.minimum(counts, window) == n)[words.text[:len(words.text) - n + 1]]
                    at = np.flatnonzero(runs)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(words.text[at])), pa.array(np.full(len(at), n, np.int32)),
                         pa.array(words.fingerprints(n)[at].view(np.int64)), pa.array([words.said(i, n) for i in at.tolist()], pa.string())],
                        names=["item_id", "n", "fp", "said"])

    return _plain(items, item_id, text).mapInArrow(cut, "item_id long, n int, fp long, said string")


def _plain(rows: DataFrame, key: str, text: str) -> DataFrame:
    return rows.select(F.col(f"`{key}`").cast("long").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))


def bit_array(fingerprints: DataFrame) -> tuple[bytes, int]:
    """(bits, mask): both bits of every fingerprint ``fp`` set; 2^22 to 2^29
    bits, by the number of fingerprints."""
    n = fingerprints.count()
    size = min(LARGEST_BITS, max(SMALLEST_BITS, (n * BITS_PER_ENTRY).bit_length()))
    mask = (1 << size) - 1
    places = fingerprints.select(F.explode(F.array(  # Spark's buckets count from 1
        F.expr(f"(fp & {mask}L) + 1"), F.expr(f"(shiftrightunsigned(fp, 32) & {mask}L) + 1"))).alias("place"))
    held = bytearray((mask + 1) // 8)
    width = _BUCKET_BITS // 8
    rows = places.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    for r in rows.toLocalIterator():  # at most 2^29 bits in all
        at = (r.bucket - 1) * width
        held[at:at + width] = r.bits
    return bytes(held), mask


def _held(bits: np.ndarray, mask: int, fp: np.ndarray) -> np.ndarray:
    found = np.ones(len(fp), bool)
    for place in (fp & np.uint64(mask), (fp >> np.uint64(32)) & np.uint64(mask)):
        found &= (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1
    return found


def hits(docs: DataFrame, text: str, doc_id: str, lengths: list[int], bits: bytes, mask: int) -> DataFrame:
    """(row, doc_id, n_words, start, n, said): one row of every document with
    its words counted (start null), and one of every window whose fingerprint
    the bit array may hold."""
    held = docs.sparkSession.sparkContext.broadcast(bits)

    def winnow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(held.value, np.uint8)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for ids, texts in text_slices(batch):
                words = _words(texts)
                none = pa.nulls(len(texts), pa.int64())
                yield _hit_rows(np.arange(row, row + len(texts)), ids, pa.array(np.bincount(words.text, minlength=len(texts))),
                                none, pa.nulls(len(texts), pa.int32()), pa.nulls(len(texts), pa.string()))
                before = np.searchsorted(words.text, np.arange(len(texts)))  # words of earlier texts
                for n in lengths:
                    fp = words.fingerprints(n)
                    first = np.ones(len(fp), bool)
                    first[1:] = fp[1:] != fp[:-1]
                    run = np.cumsum(first) - 1
                    at = np.flatnonzero(_held(known, mask, fp[first])[run] & words.whole(n)) if len(fp) else []
                    for i in range(0, len(at), 10_000):
                        some = at[i:i + 10_000]
                        of = words.text[some]
                        yield _hit_rows(row + of, ids.take(pa.array(of)), pa.nulls(len(some), pa.int64()),
                                        pa.array(some - before[of]), pa.array(np.full(len(some), n, np.int32)),
                                        pa.array([words.said(x, n) for x in some.tolist()], pa.string()))
                row += len(texts)

    return _plain(docs, doc_id, text).mapInArrow(
        winnow, "row long, doc_id long, n_words long, start long, n int, said string")


def _hit_rows(row: np.ndarray, doc_id, n_words, start, n, said) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), doc_id, n_words, start, n, said],
                                      names=["row", "doc_id", "n_words", "start", "n", "said"])


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id",
                  item_text: str = "text", item_id: str = "item_id", window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, items) of every document row: the words inside
    benchmark windows and the sorted ids (as strings) of the items whose
    windows occur.

    A null text has no words; neither has an empty one.  Items without words
    match nothing; rows that repeat an item_id are one item with all their
    windows; windows of items without an id hit words but name no item.  Rows
    that repeat a doc_id are documents of their own, a null doc_id stays null.
    No documents: no rows; no items: no hits.  Other columns are ignored.  A
    text is winnowed as a whole (about five bytes of memory a byte).
    """
    bounded_batches(docs.sparkSession)
    cut = materialize(item_windows(items, item_text, item_id, window), "winnow-items")
    distinct = materialize(cut.select("said", "n", "fp").distinct()
                           .withColumn("id", F.monotonically_increasing_id()), "winnow-windows")
    named = materialize(cut.where("item_id is not null").join(distinct.select("said", "id"), "said")
                        .select("id", "item_id").distinct(), "winnow-names")
    lengths = sorted(r.n for r in distinct.select("n").distinct().collect())  # at most `window` of them
    bits, mask = bit_array(distinct.select("fp").distinct())
    found = materialize(hits(docs, text, doc_id, lengths, bits, mask), "winnow-hits")
    in_order = Window.partitionBy("row").orderBy("start", "n")
    covered = F.max(F.col("start") + F.col("n")).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    own = (found.where("start is not null").join(distinct.select("said", "id"), "said")
           .withColumn("more", F.greatest(F.lit(0), F.col("start") + F.col("n")
                                          - F.greatest("start", F.coalesce(covered, F.lit(0))))))
    per_row = materialize(own.groupBy("row").agg(F.sum("more").alias("n_hit"),
                                                 F.sort_array(F.collect_set("id")).alias("windows"))
                          .withColumn("group", F.sha2(F.array_join("windows", ","), 256)), "winnow-rows")
    groups = (per_row.select("group", "windows").dropDuplicates(["group"])
              .select("group", F.explode("windows").alias("id")).join(named, "id").select("group", "item_id").distinct()
              .groupBy("group").agg(F.sort_array(F.collect_list(F.col("item_id").cast("string"))).alias("items")))
    # Only rows with hits look their items up: the others have no group to meet in.
    hit = per_row.select("row", "n_hit", "group").join(groups, "group", "left").drop("group")
    return (found.where("start is null").select("row", "doc_id", "n_words").join(hit, "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


_ORACLE = r"""
with doc_words as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
item_words as (
  select item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
item_windows as (
  select distinct item_id, least(len(w), 10) as n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') as said
  from (select item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) as i from item_words where len(w) > 0)),
lengths as (select distinct n from item_windows),
doc_windows as (
  select r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') as said
  from (select r, w, n, unnest(generate_series(1, len(w) - n + 1)) as i from doc_words, lengths where len(w) >= n)),
found as (
  select r, i, d.n, item_id from doc_windows d join item_windows t on d.said = t.said and d.n = t.n),
hit as (
  select r, count(distinct p) as n_hit
  from (select r, unnest(generate_series(i, i + n - 1)) as p from (select distinct r, i, n from found)) group by r),
named as (
  select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
  from (select distinct r, cast(item_id as varchar) as item_id from found where item_id is not null) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from doc_words left join hit using (r) left join named using (r)
"""


@query("op12_winnow_decontaminate", _ORACLE)
def op12_winnow_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
