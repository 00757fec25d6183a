"""Harmonic packing of tokenised documents into fixed-length sequences.

Lengths are partitioned into reciprocal-capacity classes: a length in
(capacity / (j + 1), capacity / j] is of class j, and j documents of that class
fill a bin, whatever their lengths; so a bin is complete by counting and no
worker needs to know another's bins.  Of a document longer than a sequence
whole sequences are cut first; what remains is classed like a document.

A complete bin leaves a gap of less than one of its documents.  As cutting is
free, the bins with the widest gaps are dissolved again, just as many as it
takes, and their documents cut to fill the gaps of the others: every sequence
is full, and all documents but those few stay whole.  When a task ends, its
incomplete bins are strung together and cut at the capacity: one padded
sequence per task is all that remains.

One narrow stage, no shuffle: a lost executor's tasks are simply rerun.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.llm.batches import bounded_batches, text_slices
from ladle.llm.registry import query, table
from ladle.llm.tokens import encoder

CAPACITY = 2048
END_ID = 1
SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long")
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def class_of(length: int, capacity: int) -> int:
    """The j with capacity / (j + 1) < length <= capacity / j."""
    return capacity // length


class Piece(NamedTuple):
    doc_id: int | None
    start: int
    ids: np.ndarray
    total: int


class Packer:
    """Bins of one task.  What waits is bounded: one incomplete bin per class
    and less than one dissolved bin."""

    def __init__(self, capacity: int, first_sequence: int):
        self.capacity, self.next_sequence = capacity, first_sequence
        self.open: dict[int, list[Piece]] = {}
        self.complete: list[list[Piece]] = []
        self.filler: deque[Piece] = deque()
        self.rows: list[tuple[Piece, int, int]] = []

    def _emit(self, pieces: list[Piece]) -> None:
        offset = 0
        for piece in pieces:
            self.rows.append((piece, self.next_sequence, offset))
            offset += len(piece.ids)
        self.next_sequence += 1

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        total, capacity = len(ids), self.capacity
        rest = total % capacity
        for start in range(0, total - rest, capacity):
            self._emit([Piece(doc_id, start, ids[start:start + capacity], total)])
        if rest:
            j = class_of(rest, capacity)
            pieces = self.open.setdefault(j, [])
            pieces.append(Piece(doc_id, total - rest, ids[total - rest:].copy(), total))  # not the batch it lies in
            if len(pieces) == j:
                self.complete.append(self.open.pop(j))

    def _cut(self, room: int) -> list[Piece]:
        """At most ``room`` ids off the front of the filler."""
        out = []
        while room and self.filler:
            piece = self.filler.popleft()
            if len(piece.ids) > room:
                self.filler.appendleft(Piece(piece.doc_id, piece.start + room, piece.ids[room:], piece.total))
                piece = piece._replace(ids=piece.ids[:room])
            out.append(piece)
            room -= len(piece.ids)
        return out

    def fill(self) -> None:
        """Emit the complete bins, those with the widest gaps dissolved to fill the others."""
        used = [sum(len(p.ids) for p in b) for b in self.complete]
        order = sorted(range(len(used)), key=used.__getitem__)
        gaps, supply = sum(self.capacity - n for n in used), sum(len(p.ids) for p in self.filler)
        dissolved = 0
        while supply < gaps:  # the widest gap first; dissolving all leaves no gap
            b = order[dissolved]
            gaps, supply = gaps - (self.capacity - used[b]), supply + used[b]
            self.filler.extend(self.complete[b])
            dissolved += 1
        for b in order[dissolved:]:
            self._emit(self.complete[b] + self._cut(self.capacity - used[b]))
        self.complete = []

    def close(self) -> None:
        """String the incomplete bins together, largest pieces first."""
        self.fill()
        for j in sorted(self.open):
            self.filler.extend(self.open[j])
        self.open.clear()
        while self.filler:
            self._emit(self._cut(self.capacity))

    def flush(self) -> pa.RecordBatch:
        pieces = [r[0] for r in self.rows]
        sizes = np.array([len(p.ids) for p in pieces], np.int64)
        flat = np.concatenate([p.ids for p in pieces]) if pieces else np.empty(0, "<u4")
        ids = pa.Array.from_buffers(pa.binary(), len(pieces), [None, pa.py_buffer(np.r_[0, np.cumsum(4 * sizes)].astype(np.int32)),
                                                               pa.py_buffer(flat)])
        number = lambda values: pa.array(values, pa.int64())
        out = pa.RecordBatch.from_arrays([number([p.doc_id for p in pieces]), number([p.start for p in pieces]), number(sizes), ids,
                                          number([p.total for p in pieces]), number([r[1] for r in self.rows]),
                                          number([r[2] for r in self.rows])], schema=_ARROW)
        self.rows = []
        return out


def pack(docs: DataFrame, tokenizer_path: str, text: str = "text", doc_id: str = "doc_id",
         capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents: (doc_id, start, length, ids, doc_tokens,
    sequence_id, offset); ``ids`` are the piece's token ids as little-endian
    unsigned 32-bit integers, ``offset`` its place in the sequence.

    A document is its text's ids, then ``end_id``; a null or empty text is
    ``end_id`` alone.  A null doc_id stays null, rows that repeat an id are
    packed each; a text longer than a sequence is cut as often as it needs; an empty
    table gives no rows.  Other columns of ``docs`` are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as f:  # a fixed vocabulary, the same for any input
        vocabulary = spark.sparkContext.broadcast(f.read())

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary.value).encode
        packer = Packer(capacity, TaskContext.get().partitionId() << 33)
        for batch in batches:
            for keys, texts in text_slices(batch):
                ids, offsets = encode(texts)
                ids = np.insert(ids, offsets[1:], end_id)
                offsets = (offsets + np.arange(len(offsets))).tolist()
                for key, a, b in zip(keys.to_pylist(), offsets[:-1], offsets[1:]):
                    packer.add(key, ids[a:b])
                packer.fill()
                yield packer.flush()
        packer.close()
        yield packer.flush()

    return (docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
            .mapInArrow(packed, SCHEMA))


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids): the pieces of each sequence (at most its
    capacity) joined in order, before padding."""
    return (pieces.groupBy("sequence_id")
            .agg(F.sum("length").alias("n_tokens"),
                 F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
            .select("sequence_id", "n_tokens",
                    F.aggregate("parts", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"])).alias("ids")))


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query("op2_harmonic_packing")
def op2_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), default_tokenizer())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")
