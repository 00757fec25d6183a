"""Exact substring dedup over induced-sorting suffix arrays.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts
anywhere else.  Suffix arrays answer that inside a shard; the work around
them brings all starts of equal strings into one shard without moving texts
that repeat nothing.

1. Every window of LENGTH bytes is assigned to the smallest hash of its
   GRAM-byte substrings, its anchor, which depends on the window's bytes
   alone; neighbouring windows with the same anchor form a chunk.
2. Chunks whose anchor occurs once, and once inside the chunk, repeat
   nothing.  Of the rest, chunks that are equal byte for byte (128-bit
   digests, folded map-side) are repeated throughout.
3. What is left are anchors with several different chunks, the places where
   copies start and end to differ, and periodic chunks.  One copy of each is cut from its text and
   the chunks of an anchor meet in a shard of bounded bytes: suffix array by
   induced sorting, permuted common prefixes, and every window whose
   neighbour shares LENGTH bytes is repeated.
4. The chunks of an anchor that has more of them than a shard holds are cut
   finer first: windows that have the anchor at a distance from 2^j to
   2^(j+1) from one end share the 2^j bytes on that side of it and nearly all
   that a window holds on the other, so these bytes join the anchor in the
   key, and steps 2 and 3 are taken again with the finer chunks.
5. Should a key still have more chunks than a shard holds, it is spread over
   shards; each then names its distinct windows by digest, and windows named
   by several shards are repeated too.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.llm.batches import bounded_batches
from ladle.llm.registry import query, table
from ladle.llm.suffix_array import permuted_lcp, suffix_array
from ladle.session import materialize

LENGTH = 400
GRAM = 50
SHARD_BYTES = 1 << 20
SEGMENT = 1 << 20      # bytes hashed at a time, whatever the length of a text
_BASE = 0x9E3779B97F4A7C15
_CHUNK = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("start", pa.int64()), ("windows", pa.int64()),
                    ("anchor", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("periodic", pa.bool_())])
_PLACE = np.uint64((1 << 21) - 1)  # low bits of a hash that hold its place in a segment
_FOUND = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
                    ("d1", pa.int64()), ("d2", pa.int64()), ("repeated", pa.bool_())])


class Anchors:
    """Anchor runs of byte arrays; holds the powers of the rolling hash."""

    def __init__(self, length: int, gram: int, segment: int):
        self.length, self.gram = length, gram
        size = segment + length
        inverse = pow(_BASE, -1, 1 << 64)
        self.power = np.cumprod(np.r_[np.uint64(1), np.full(size, _BASE, np.uint64)])
        self.inverse = np.cumprod(np.r_[np.uint64(1), np.full(size, inverse, np.uint64)])
        self.table = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)

    def smallest(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every window of ``length`` bytes its smallest substring hash,
        with the place of its first and (counted down) its last occurrence."""
        sums = np.r_[np.uint64(0), np.cumsum(self.table[data] * self.power[:len(data)])]
        g = self.gram
        h = (sums[g:] - sums[:-g]) * self.inverse[:len(data) - g + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        h &= ~_PLACE
        place = np.arange(len(h), dtype=np.uint64)
        return self._slide(h | place), self._slide(h | (_PLACE - place))

    def _slide(self, h: np.ndarray) -> np.ndarray:
        width, span = self.length - self.gram + 1, 1
        while span * 2 <= width:
            h = np.minimum(h[:-span], h[span:])
            span *= 2
        return np.minimum(h[:len(h) - (width - span)], h[width - span:])

    def runs(self, pieces: list[bytes]) -> tuple[np.ndarray, ...]:
        """(piece, start, windows, anchor, periodic) of every run in the
        pieces, hashed as one array; periodic if it holds its anchor twice."""
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        sizes = np.array([len(p) for p in pieces])
        offsets = np.cumsum(sizes) - sizes
        head, tail = self.smallest(data)
        least = head >> np.uint64(21)
        inside = np.zeros(len(least) + 1, dtype=np.int64)
        long_enough = sizes >= self.length
        np.add.at(inside, offsets[long_enough], 1)
        np.add.at(inside, (offsets + sizes - self.length + 1)[long_enough], -1)
        inside = np.cumsum(inside)[:-1] > 0
        first = inside.copy()
        first[1:] &= (least[1:] != least[:-1]) | ~inside[:-1]
        first[offsets[long_enough]] = True
        starts = np.flatnonzero(first)
        stops = np.r_[starts[1:], len(least)]
        piece = np.searchsorted(offsets, starts, side="right") - 1
        while len(piece) and (sizes[piece] == 0).any():  # empty pieces share an offset with the one they precede
            piece = np.where(sizes[piece] == 0, piece + 1, piece)
        stops = np.minimum(stops, (offsets + sizes - self.length + 1)[piece])
        periodic = (head[starts] & _PLACE) != _PLACE - (tail[stops - 1] & _PLACE)
        return piece, starts - offsets[piece], stops - starts, least[starts].view(np.int64), periodic


_anchors: dict[tuple, Anchors] = {}


def _worker_anchors(*key: int) -> Anchors:
    """One table of powers per worker and (length, gram, segment)."""
    if key not in _anchors:
        _anchors[key] = Anchors(*key)
    return _anchors[key]


def _digests(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(b"".join(blake2b(p, digest_size=16).digest() for p in parts), dtype=np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _chunk_batch(anchors: Anchors, rows: list[tuple]) -> pa.RecordBatch:
    """rows: (doc_id, th, position in the document, bytes)."""
    piece, start, windows, anchor, periodic = anchors.runs([r[3] for r in rows])
    ends = (start + windows + anchors.length - 1).tolist()
    parts = [rows[k][3][a:b] for k, a, b in zip(piece.tolist(), start.tolist(), ends)]
    d1, d2 = _digests(parts)
    base = np.array([r[2] for r in rows], dtype=np.int64)
    doc_ids = pa.array([r[0] for r in rows], pa.int64()).take(pa.array(piece, pa.int64()))
    th = np.array([r[1] for r in rows], dtype=np.int64)[piece]
    return pa.RecordBatch.from_arrays([doc_ids, *map(pa.array, (th, start + base[piece], windows, anchor, d1, d2, periodic))],
                                      schema=_CHUNK)


def _keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(doc_id, th, text): a document is known by its id and its text's hash."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(whole).alias("th"),
                       whole.alias("text"))


def chunks(keyed: DataFrame, length: int, gram: int, segment: int = SEGMENT) -> DataFrame:
    """(doc_id, th, start, windows, anchor, d1, d2, periodic): ``windows``
    successive windows from byte ``start``, all with this anchor; d1, d2 the
    chunk's digest."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, held, size = _worker_anchors(length, gram, segment), [], 0
        for batch in batches:
            for doc_id, th, text in zip(*(c.to_pylist() for c in batch.columns)):
                data = text.encode("utf-8")
                for at in range(0, len(data) - length + 1, segment):
                    part = data[at:at + segment + length - 1]
                    if size + len(part) > segment + length - 1:
                        yield _chunk_batch(anchors, held)
                        held, size = [], 0
                    held.append((doc_id, th, at, part))
                    size += len(part)
        if held:
            yield _chunk_batch(anchors, held)

    return keyed.mapInArrow(cut, "doc_id long, th long, start long, windows long, anchor long, d1 long, d2 long, "
                            "periodic boolean")


def _spans_of(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.r_[0, marked.astype(np.int8), 0])
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def shard_repeats(shard: pa.Table, length: int, spread: bool) -> pa.Table:
    """Repeated windows of one shard's chunks as byte spans of their
    documents; if the anchor is ``spread`` also every distinct window once."""
    parts = shard.column("bytes").to_pylist()
    windows = np.array(shard.column("windows").to_pylist())
    copies = np.array(shard.column("copies").to_pylist())
    base = np.array(shard.column("start").to_pylist())
    sizes = np.array([len(p) + 1 for p in parts])
    offsets = np.cumsum(sizes) - sizes
    text = np.frombuffer(b"\x00".join([*parts, b"\x00"]), dtype=np.uint8).astype(np.uint16) + 2
    text[offsets + sizes - 1] = 1  # between chunks; no byte has it
    text[-1] = 0
    plcp, phi = permuted_lcp(text, suffix_array(text, 258))
    valid = np.zeros(len(text) + 1, dtype=np.int64)
    np.add.at(valid, offsets, 1)
    np.add.at(valid, offsets + windows, -1)
    valid = np.cumsum(valid)[:-1] > 0  # starts of whole windows
    hit = np.flatnonzero(valid & (plcp >= length))
    marked = np.zeros(len(text), dtype=bool)
    marked[hit] = True
    marked[phi[hit]] = True
    lows, highs = _spans_of(marked)
    piece = np.searchsorted(offsets, lows, side="right") - 1
    own = copies[piece] == 1  # chunks with copies are known to be repeated
    lows, highs, piece = lows[own], highs[own], piece[own]
    columns = [piece, base[piece] + lows - offsets[piece], base[piece] + highs - offsets[piece] + length - 1]
    none = pa.nulls(len(piece), pa.int64())
    rows = [_found(shard, *columns, none, none, pa.array(np.ones(len(piece), bool)))]
    if spread:
        distinct = np.flatnonzero(valid & (plcp < length))  # the first of its class in the order
        piece = np.searchsorted(offsets, distinct, side="right") - 1
        inside = distinct - offsets[piece]
        d1, d2 = _digests([parts[k][a:a + length] for k, a in zip(piece.tolist(), inside.tolist())])
        rows.append(_found(shard, piece, base[piece] + inside, base[piece] + inside + length, pa.array(d1), pa.array(d2),
                           pa.array(marked[distinct] | (copies[piece] > 1))))
    return pa.concat_tables(rows)


def _found(shard: pa.Table, piece: np.ndarray, start: np.ndarray, end: np.ndarray, d1, d2, repeated) -> pa.Table:
    take = pa.array(piece, pa.int64())
    return pa.Table.from_arrays([shard.column("doc_id").combine_chunks().take(take),
                                 shard.column("th").combine_chunks().take(take),
                                 pa.array(start, pa.int64()), pa.array(end, pa.int64()), d1, d2, repeated], schema=_FOUND)


def _finer_batch(anchors: Anchors, rows: list[tuple]) -> pa.RecordBatch:
    """rows: (doc_id, th, start, windows, copies, anchor, bytes) of chunks;
    their finer chunks with key, digest and bytes."""
    data = b"".join(r[6] for r in rows)
    head, _ = anchors.smallest(np.frombuffer(data, dtype=np.uint8))
    sizes = np.array([len(r[6]) for r in rows])
    windows = np.array([r[3] for r in rows])
    offsets = np.cumsum(sizes) - sizes
    piece = np.repeat(np.arange(len(rows)), windows)
    at = np.repeat(offsets, windows) + np.arange(len(piece)) - np.repeat(np.cumsum(windows) - windows, windows)
    place = (head[at] & _PLACE).astype(np.int64)  # the anchor's first place in each window
    room = anchors.length - anchors.gram          # bytes of a window beside its anchor
    left = place - at
    near = np.minimum(left, room - left)
    code = 2 * np.ceil(np.log2(near + 1)).astype(np.int64) + (left > room - left)  # 2 * bit length + side
    first = np.r_[True, (piece[1:] != piece[:-1]) | (code[1:] != code[:-1]) | (place[1:] != place[:-1])]
    starts = np.flatnonzero(first)
    counts = np.diff(np.r_[starts, len(piece)])
    keys, parts = [], []
    for p, c, g, n, k in zip(at[starts].tolist(), code[starts].tolist(), place[starts].tolist(), counts.tolist(),
                             piece[starts].tolist()):
        low, high = (1 << c // 2) >> 1, 1 << c // 2
        short, far = low, max(0, room - high + 1)
        before, after = (far, short) if c & 1 else (short, far)
        context = data[g - before:g + anchors.gram + after]
        keys.append(blake2b(b"%d,%d," % (rows[k][5], c) + context, digest_size=8).digest())
        parts.append(data[p:p + n + anchors.length - 1])
    d1, d2 = _digests(parts)
    of = piece[starts]
    column = lambda i: pa.array([r[i] for r in rows], pa.int64()).take(pa.array(of, pa.int64()))
    start = np.array([r[2] for r in rows], dtype=np.int64)[of] + at[starts] - offsets[of]
    return pa.RecordBatch.from_arrays(
        [column(0), column(1), pa.array(start), pa.array(counts), column(4),
         pa.array(np.frombuffer(b"".join(keys), dtype=np.int64)), pa.array(d1), pa.array(d2), pa.array(parts, pa.binary())],
        names=["doc_id", "th", "start", "windows", "copies", "anchor", "d1", "d2", "bytes"])


def finer_chunks(cut: DataFrame, length: int, gram: int, segment: int = SEGMENT) -> DataFrame:
    """Chunks (doc_id, th, start, windows, copies, anchor, bytes) cut finer, with new anchors and digests."""
    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, held, size = _worker_anchors(length, gram, segment), [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and size + len(row[6]) > segment + length - 1:
                    yield _finer_batch(anchors, held)
                    held, size = [], 0
                held.append(row)
                size += len(row[6])
        if held:
            yield _finer_batch(anchors, held)

    return (cut.select("doc_id", "th", "start", "windows", "copies", "anchor", "bytes")
            .mapInArrow(refine, "doc_id long, th long, start long, windows long, copies long, anchor long, "
                                "d1 long, d2 long, bytes binary"))


def _several(pieces: DataFrame, length: int, periodic: bool) -> DataFrame:
    """(anchor, bytes): the anchors whose chunks must be compared byte by byte, with the bytes to compare."""
    n_bytes = F.sum(F.col("at.windows") + (length - 1)).cast("long").alias("bytes")
    found = pieces.groupBy("anchor").agg(F.count(F.lit(1)).alias("chunks"), n_bytes,
                                         (F.max("periodic") if periodic else F.lit(False)).alias("periodic"))
    return materialize(found.where("chunks > 1 or periodic").select("anchor", "bytes"), "substr-anchors")


def repeated_spans(keyed: DataFrame, length: int, gram: int, shard_bytes: int) -> DataFrame:
    """(doc_id, th, start, end): byte spans, possibly overlapping, that cover
    exactly the bytes of repeated windows."""
    limit = shard_bytes // 2  # bytes of one anchor that may share a shard with others
    columns = ["doc_id", "th", "start", "end"]
    span_end = (F.col("start") + F.col("windows") + (length - 1)).alias("end")
    rows = materialize(chunks(keyed, length, gram), "substr-chunks")
    shared = (rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.max("periodic").alias("periodic"))
              .where("n > 1 or periodic").select("anchor"))
    some = materialize(rows.join(shared, "anchor", "left_semi"), "substr-shared")
    pieces = materialize(some.groupBy("anchor", "d1", "d2").agg(
        F.count(F.lit(1)).alias("copies"), F.max("periodic").alias("periodic"),
        F.min(F.struct("doc_id", "th", "start", "windows")).alias("at")), "substr-pieces")
    spans = (some.join(pieces.where("copies > 1"), ["anchor", "d1", "d2"], "left_semi")
             .select("doc_id", "th", "start", span_end))
    mixed = _several(pieces, length, periodic=True)
    if mixed.isEmpty():
        return spans
    refs = (pieces.join(mixed, "anchor").select("anchor", F.col("bytes").alias("held"), "copies", "at.*")
            .groupBy("doc_id", "th").agg(F.collect_list(F.struct("anchor", "held", "copies", "start", "windows")).alias("refs")))
    same = F.col("d.th").eqNullSafe(F.col("r.th")) & F.col("d.doc_id").eqNullSafe(F.col("r.doc_id"))
    cut = materialize(
        keyed.alias("d").join(refs.alias("r"), same)
        .select("d.doc_id", "d.th", F.col("d.text").cast("binary").alias("raw"), F.explode("r.refs").alias("ref"))
        .select("doc_id", "th", "ref.*", F.expr(f"substring(raw, int(ref.start) + 1, int(ref.windows) + {length - 1})")
                .alias("bytes")), "substr-cut")
    compared = cut.where(F.col("held") <= limit)
    heavy = cut.where(F.col("held") > limit)
    heavy_bytes = heavy.agg(F.sum(F.octet_length("bytes"))).first()[0]
    if heavy_bytes:
        dealt = heavy.repartition(-(-heavy_bytes // shard_bytes), "doc_id", "th", "start")  # a shard's bytes a task
        fine = materialize(finer_chunks(dealt, length, gram), "substr-fine")
        parts = materialize(fine.groupBy("anchor", "d1", "d2").agg(
            F.count(F.lit(1)).alias("n"), F.max("copies").alias("copies"),
            F.min(F.struct("doc_id", "th", "start", "windows")).alias("at")), "substr-fine-pieces")
        equal = fine.where("copies = 1").join(parts.where("n > 1"), ["anchor", "d1", "d2"], "left_semi")
        spans = spans.unionByName(equal.select("doc_id", "th", "start", span_end))
        at = parts.select("anchor", F.greatest("n", "copies").alias("copies"), "at.*")
        again = (fine.drop("copies", "d1", "d2").join(
            at.join(_several(parts, length, periodic=False).withColumnRenamed("bytes", "held"), "anchor")
            .select("anchor", "held", "copies", F.col("doc_id").alias("o"), F.col("th").alias("p"), F.col("start").alias("q"))
            .withColumnRenamed("anchor", "a"),
            (F.col("anchor") == F.col("a")) & F.col("doc_id").eqNullSafe(F.col("o")) & (F.col("th") == F.col("p"))
            & (F.col("start") == F.col("q"))).drop("a", "o", "p", "q"))
        compared = compared.unionByName(again)
    compared = materialize(compared, "substr-compared")
    total = compared.agg(F.sum(F.octet_length("bytes"))).first()[0]
    if not total:
        return spans
    spread = F.col("held") > limit
    salt = F.pmod(F.xxhash64("doc_id", "th", "start"), F.ceil(F.col("held") / limit))
    dealt = compared.select(
        F.when(spread, F.col("anchor")).alias("spread"),
        F.when(spread, salt).otherwise(F.pmod(F.xxhash64("anchor"), F.lit(-(-total // shard_bytes)))).alias("part"),
        "copies", "doc_id", "th", "start", "windows", "bytes")

    def repeats(shard: pa.Table) -> pa.Table:
        return shard_repeats(shard, length, shard.column("spread")[0].is_valid)

    found = materialize(dealt.groupBy("spread", "part").applyInArrow(
        repeats, "doc_id long, th long, start long, end long, d1 long, d2 long, repeated boolean"), "substr-found")
    named = found.where("d1 is not null")
    several = named.groupBy("d1", "d2").count().where("count > 1").select("d1", "d2")
    across = named.where("not repeated").join(several, ["d1", "d2"], "left_semi")
    return spans.unionByName(found.where("d1 is null").select(*columns)).unionByName(across.select(*columns))


def substring_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH,
                    gram: int = GRAM, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row: ``spans`` the maximal
    removed byte runs [start, end), ``kept`` the remaining bytes.

    Texts are UTF-8 bytes, matches never cross documents.  A null or empty
    text, or one shorter than ``length``, keeps all its bytes; rows that
    repeat an id and a text repeat each other (both lose them); a null doc_id
    is an id like any other; empty table: no rows.
    """
    bounded_batches(docs.sparkSession, 128)
    keyed = _keyed(docs, text, doc_id)
    spans = (repeated_spans(keyed, length, gram, shard_bytes)
             .groupBy("doc_id", "th").agg(F.collect_set(F.struct("start", "end")).alias("found")))
    same = F.col("d.th").eqNullSafe(F.col("s.th")) & F.col("d.doc_id").eqNullSafe(F.col("s.doc_id"))
    joined = (keyed.alias("d").join(spans.alias("s"), same, "left")
              .select("d.doc_id", F.col("d.text").alias("text"), "s.found"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, runs, kept = [], [], []
            for whole, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data, merged, rest, at = whole.encode("utf-8"), [], [], 0
                for a, b in sorted((x["start"], x["end"]) for x in found or ()):
                    if merged and a <= merged[-1]["end"]:
                        merged[-1]["end"] = max(merged[-1]["end"], b)
                    else:
                        merged.append({"start": a, "end": b})
                for span in merged:
                    rest.append(data[at:span["start"]])
                    at = span["end"]
                sizes.append(len(data))
                runs.append(merged)
                kept.append(b"".join([*rest, data[at:]]))
            pair = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()),
                                              pa.array(runs, pa.list_(pair)), pa.array(kept, pa.binary())],
                                             names=["doc_id", "n_bytes", "spans", "kept"])

    return joined.mapInArrow(remove, "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")


@query("op10_suffix_array_dedup")
def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))
