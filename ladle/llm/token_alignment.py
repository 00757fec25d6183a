"""Cross-tokenizer alignment of a byte-level BPE (A) and a sentencepiece BPE (B).

Both vocabularies end a token before a space or line feed that follows
anything but white space, so a text's tokens are those of its segments (such
a space or line feed and what follows, up to the next) and every segment's end
is a common cut.  Segments recur: each distinct one is encoded and aligned once
per worker while a bounded cache lasts.

1. The tokenizers' character offsets and sentencepiece's proto spans are the
   coarse cuts of a segment's bytes.  Tokens that share a character (a
   multibyte one cut by A) and B's byte-fallback tokens are refined by their
   decoded bytes.  The decoded bytes of all tokens are held against the
   segment's; a text with a segment that differs has no tokens.
2. Cuts that A and B share end a group; all A-B pairs of a group are links.
   A text's groups, its distinct linked id pairs and how often it holds each
   are gathered from its segments with numpy.
3. Pairs are counted by documents in one partial aggregate, and the counts
   come back to the documents by a join: those of the most frequent pairs
   (as many as a measured bound admits) are broadcast, so neither they nor a
   hot key are shuffled; the rarer rest meets its counts by a shuffle.

sentencepiece's "immutable_proto" was withdrawn in favour of "proto" in the
installed version; its spans are the same, counted in bytes.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ladle.llm.batches import SLICE_BYTES, bounded_batches
from ladle.llm.registry import query, table
from ladle.session import materialize

CACHE_BYTES = 224 << 20      # of one worker's segments
ENTRY_BYTES = 400            # of a segment beside its text, estimated
BROADCAST_BYTES = 64 << 20   # of pair counts
PAIR_BYTES = 48              # of one pair's count in a broadcast hash table
_SPACE = "▁"            # B's mark of a space
_ROWS = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
         "a_ids array<int>, b_ids array<int>, times array<int>")


def _byte_letters() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the other bytes for 256 and up."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Pieces:
    """Decoded bytes of a vocabulary, by id."""

    def __init__(self, decoded: list[bytes]):
        self.size = np.array([len(d) for d in decoded], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(decoded), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[_ranges(self.at[ids], self.size[ids])]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for each of the ranges in turn."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class Aligner:
    """Aligns segments; the results of distinct segments are kept in arrays by slot."""

    def __init__(self, byte_bpe: str, piece_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_str(byte_bpe)
        self.a.encode_special_tokens = True
        letters = _byte_letters()
        entries = sorted(self.a.get_vocab(with_added_tokens=True).items(), key=lambda e: e[1])
        self.a_pieces = Pieces([bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
                                for token, _ in entries])
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_byte = np.array([self.b.is_byte(i) for i in range(len(pieces))])
        joins = [p for p in pieces if _SPACE in p.lstrip(_SPACE) or "\n" in p]
        if joins:
            raise ValueError(f"pieces that go on beyond a word's end: {joins[:3]}")
        self.b_pieces = Pieces([bytes([int(p[3:5], 16)]) if byte else p.replace(_SPACE, " ").encode()
                                for p, byte in zip(pieces, self.b_byte)])
        self.b_space = self.b.piece_to_id(_SPACE)
        self.n_b = len(pieces)
        a_text, b_text = [str(i) for i in range(len(entries))], [str(i) for i in range(len(pieces))]
        # a token's text after the start of a segment, of a group, of a group's B side, and after another token
        self.said = [a_text, [";" + t for t in a_text], ["," + t for t in a_text],
                     ["|" + t for t in b_text], ["," + t for t in b_text]]
        self.clear()

    def clear(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.used = 0
        self.groups: list[str] = []
        self.counts = np.empty((0, 5), np.int64)        # n_a, n_b, n_groups, n_links, whether the bytes agree
        self.pairs = np.empty(0, np.int64)
        self.times = np.empty(0, np.int64)
        self.pair_at = np.zeros(1, np.int64)

    def slots_of(self, segments: list[bytes]) -> np.ndarray:
        new = [s for s in segments if s not in self.slots]
        if new and self.used + sum(map(len, new)) + ENTRY_BYTES * len(new) > CACHE_BYTES:
            self.clear()
            new = segments
        if new:
            self.slots.update(zip(new, range(len(self.slots), len(self.slots) + len(new))))
            self.used += sum(map(len, new)) + ENTRY_BYTES * len(new)
            self._align(new)
        return np.fromiter(map(self.slots.__getitem__, segments), np.int64, len(segments))

    def _a_tokens(self, texts: list[str], starts: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, ...]:
        """(ids, segment, end) of A's tokens, ends in the bytes of all segments."""
        encoded = self.a.encode_batch(texts, add_special_tokens=False)
        n = np.array([len(e) for e in encoded])
        ids = np.array([i for e in encoded for i in e.ids], np.int64)
        spans = np.array([o for e in encoded for o in e.offsets], np.int64).reshape(-1, 2)
        of = np.repeat(np.arange(len(texts)), n)
        characters = np.r_[np.flatnonzero((flat & 0xC0) != 0x80), len(flat)]  # where each begins
        first = np.searchsorted(characters, starts)
        coarse = characters[first[of] + spans[:, 1]]
        # A cut is sharp unless the next token lies in the same character.
        sharp = np.ones(len(ids), bool)
        sharp[:-1] = (of[1:] != of[:-1]) | (spans[1:, 0] >= spans[:-1, 1])
        return ids, of, self._refined(coarse, sharp, of, starts, self.a_pieces.size[ids])

    def _refined(self, coarse, sharp, of, starts, sizes) -> np.ndarray:
        """Ends: the coarse cut where it is sharp, else the decoded bytes after the last sharp one."""
        decoded = np.cumsum(sizes)
        index = np.arange(len(of))
        begins = np.r_[True, of[1:] != of[:-1]]
        last = np.maximum.accumulate(np.where(np.r_[False, sharp[:-1]] | begins, index, 0))  # the token after a sharp cut
        base = np.where(begins[last], starts[of], coarse[last - 1])
        return np.where(sharp, coarse, base + decoded - (decoded - sizes)[last])

    def _b_tokens(self, segments: list[bytes], texts: list[str], starts: np.ndarray) -> tuple[np.ndarray, ...]:
        """As above for B.  Its own leading space stands for a segment's; one before a line feed is dropped."""
        spaced = [s[0] == 32 for s in segments]
        encoded = self.b.encode([t[1:] if sp else t for t, sp in zip(texts, spaced)], return_type="proto", num_threads=1)
        ids, ends, n = [], [], []
        for segment, sp, e in zip(segments, spaced, encoded):
            if sp:
                found = [(p.id, p.end + 1) for p in e.pieces] or [(self.b_space, 1)]
            else:
                found = [(p.id, p.end) for p in e.pieces][1:]
            ids += [i for i, _ in found]
            ends += [x for _, x in found]
            n.append(len(found))
        of, ids = np.repeat(np.arange(len(segments)), n), np.array(ids, np.int64)
        return ids, of, self._refined(np.array(ends, np.int64) + starts[of], ~self.b_byte[ids], of, starts, self.b_pieces.size[ids])

    def _agree(self, pieces: Pieces, ids, of, flat, starts, sizes) -> np.ndarray:
        """Which segments' bytes the decoded tokens rebuild."""
        decoded = np.bincount(of, pieces.size[ids], minlength=len(sizes)).astype(np.int64)
        same = decoded == sizes
        held = same[of]
        got, want = pieces.joined(ids[held]), flat[_ranges(starts[same], sizes[same])]
        which = np.repeat(np.flatnonzero(same), sizes[same])
        same[which[got != want]] = False
        return same

    def _align(self, segments: list[bytes]) -> None:
        flat = np.frombuffer(b"".join(segments), np.uint8)
        sizes = np.array([len(s) for s in segments], np.int64)
        starts = np.cumsum(sizes) - sizes
        texts = [s.decode("utf-8") for s in segments]
        a, a_of, a_end = self._a_tokens(texts, starts, flat)
        b, b_of, b_end = self._b_tokens(segments, texts, starts)
        good = self._agree(self.a_pieces, a, a_of, flat, starts, sizes) & self._agree(self.b_pieces, b, b_of, flat, starts, sizes)
        keep_a, keep_b = good[a_of], good[b_of]
        a, a_of, a_end, b, b_of, b_end = a[keep_a], a_of[keep_a], a_end[keep_a], b[keep_b], b_of[keep_b], b_end[keep_b]
        common = np.intersect1d(a_end, b_end, assume_unique=True)
        a_group, b_group = np.searchsorted(common, a_end), np.searchsorted(common, b_end)
        n_a, n_b = np.bincount(a_group, minlength=len(common)), np.bincount(b_group, minlength=len(common))
        group_of = a_of[np.searchsorted(a_group, np.arange(len(common)))]
        n = len(segments)
        each = np.stack([np.bincount(a_of, minlength=n), np.bincount(b_of, minlength=n), np.bincount(group_of, minlength=n),
                         np.bincount(group_of, n_a * n_b, minlength=n).astype(np.int64), good.astype(np.int64)], axis=1)
        b_first = np.cumsum(n_b) - n_b
        left = np.repeat(a, n_b[a_group])
        right = b[_ranges(b_first[a_group], n_b[a_group])]
        segment = np.repeat(a_of, n_b[a_group])
        code = left * self.n_b + right
        span = int(self.a_pieces.size.shape[0]) * self.n_b
        distinct, times = np.unique(segment * span + code, return_counts=True)
        held = np.bincount(distinct // span, minlength=n)
        self.counts = np.concatenate([self.counts, each])
        self.pair_at = np.r_[self.pair_at, self.pair_at[-1] + np.cumsum(held)]
        self.pairs = np.r_[self.pairs, distinct % span]
        self.times = np.r_[self.times, times]
        self._say(n, a, a_of, a_group, b, b_of, b_group)

    def _say(self, n, a, a_of, a_group, b, b_of, b_group) -> None:
        """The groups of each segment as text."""
        new_segment, new_group = np.r_[True, a_of[1:] != a_of[:-1]][:len(a)], np.r_[True, a_group[1:] != a_group[:-1]][:len(a)]
        a_kind = np.where(new_segment, 0, np.where(new_group, 1, 2))
        b_kind = np.where(np.r_[True, b_group[1:] != b_group[:-1]][:len(b)], 3, 4)
        order = np.lexsort((np.r_[np.zeros(len(a), np.int8), np.ones(len(b), np.int8)], np.r_[a_group, b_group]))
        kinds, ids = np.r_[a_kind, b_kind][order].tolist(), np.r_[a, b][order].tolist()
        parts = [self.said[k][i] for k, i in zip(kinds, ids)]
        ends = np.cumsum(np.bincount(np.r_[a_of, b_of], minlength=n)).tolist()
        at = 0
        for end in ends:
            self.groups.append("".join(parts[at:end]))
            at = end

    def documents(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple]:
        """(n_a, n_b, n_groups, n_links, groups, pair codes, times) of each of
        the texts, which all are spaced and not empty; None where bytes differ."""
        cuts = segment_starts(data, offsets[:-1])
        segments = pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(np.r_[cuts, len(data)].astype(np.int32)),
                                                                  pa.py_buffer(data)]).dictionary_encode()
        slots = self.slots_of(segments.dictionary.to_pylist())[segments.indices.to_numpy()]
        low = np.searchsorted(cuts, offsets)
        sums = np.concatenate([np.zeros((1, 5), np.int64), np.cumsum(self.counts[slots], axis=0)])
        totals = sums[low[1:]] - sums[low[:-1]]
        good = (totals[:, 4] == low[1:] - low[:-1]).tolist()
        text_of = np.repeat(np.arange(len(low) - 1), np.diff(low))
        pair_low, codes, times = self._pairs(text_of, slots, len(low) - 1)
        names, out = self.groups, []
        listed, low, totals = slots.tolist(), low.tolist(), totals.tolist()
        for i, fine in enumerate(good):
            if not fine:
                out.append(None)
                continue
            p, q = pair_low[i], pair_low[i + 1]
            out.append((*totals[i][:4], ";".join(map(names.__getitem__, listed[low[i]:low[i + 1]])), codes[p:q], times[p:q]))
        return out

    def _pairs(self, text_of, slots, n: int) -> tuple[np.ndarray, ...]:
        """(first, code, times): each text's distinct pairs from those of its segments."""
        seen, repeats = np.unique(text_of * len(self.slots) + slots, return_counts=True)
        text, slot = seen // len(self.slots), seen % len(self.slots)
        held = self.pair_at[slot + 1] - self.pair_at[slot]
        at = _ranges(self.pair_at[slot], held)
        span = int(self.a_pieces.size.shape[0]) * self.n_b
        key = np.repeat(text, held) * span + self.pairs[at]
        times = np.repeat(repeats, held) * self.times[at]
        order = np.argsort(key, kind="stable")
        key, times = key[order], times[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][:len(key)])
        total = np.add.reduceat(times, first) if len(first) else times
        return np.searchsorted(key[first], np.arange(n + 1) * span), key[first] % span, total


def segment_starts(data: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where segments begin: at every text, and at spaces and line feeds
    after a character that is surely no white space."""
    before = np.r_[np.zeros(3, np.uint8), data[:-1]]  # the byte before byte i is before[i + 2]
    one, two, three = before[2:], before[1:-1], before[:-2]
    lead = np.where(two >= 0xC0, two, np.where(three >= 0xC0, three, 0xF0))
    solid = ((one > 32) & (one < 127)) | ((one >= 128) & (lead != 0xC2) & (lead != 0xE1) & (lead != 0xE2) & (lead != 0xE3))
    cut = ((data == 32) | (data == 10)) & solid
    cut[texts] = True
    return np.flatnonzero(cut)


_aligners: dict[int, Aligner] = {}


def _worker_aligner(byte_bpe: str, piece_model: bytes) -> Aligner:
    key = hash((byte_bpe, piece_model))
    if key not in _aligners:
        _aligners.clear()
        _aligners[key] = Aligner(byte_bpe, piece_model)
    return _aligners[key]


def _slices(texts: list[bytes], limit: int) -> Iterator[tuple[list[int], bytes, np.ndarray]]:
    """(whose, data, offsets): spaced texts, some at a time; a text of more
    than ``limit`` bytes is cut between segments."""
    whose, parts, size = [], [], 0
    for i, text in enumerate(texts):
        if not text:
            continue
        pieces = [b" " + text]
        if len(text) > limit:
            data = np.frombuffer(pieces[0], np.uint8)
            cuts = segment_starts(data, np.array([0]))
            at = [0]
            while at[-1] + limit < len(data):
                k = int(np.searchsorted(cuts, at[-1] + limit, side="right")) - 1
                following = cuts[k] if cuts[k] > at[-1] else cuts[k + 1] if k + 1 < len(cuts) else len(data)
                if following == len(data):
                    break
                at.append(int(following))
            pieces = [data[p:q].tobytes() for p, q in zip(at, [*at[1:], len(data)])]
        for piece in pieces:
            if parts and size + len(piece) > limit:
                yield _joined(whose, parts)
                whose, parts, size = [], [], 0
            whose.append(i)
            parts.append(piece)
            size += len(piece)
    if parts:
        yield _joined(whose, parts)


def _joined(whose: list[int], parts: list[bytes]) -> tuple[list[int], bytes, np.ndarray]:
    return whose, np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)])


_NOTHING = (0, 0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64))


def _merged(parts: list[tuple | None]) -> tuple:
    """The parts of one text put together."""
    if not parts or any(p is None for p in parts):
        return _NOTHING
    if len(parts) == 1:
        return parts[0]
    codes, where = np.unique(np.concatenate([p[5] for p in parts]), return_inverse=True)
    times = np.bincount(where, np.concatenate([p[6] for p in parts])).astype(np.int64)
    return (*(sum(p[i] for p in parts) for i in range(4)), ";".join(p[4] for p in parts), codes, times)


def aligned(docs: DataFrame, byte_bpe_path: str, piece_model_path: str, text: str = "text", doc_id: str = "doc_id",
            slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, groups, a_ids, b_ids, times)
    of every row: ``groups`` as "a1,a2|b1;a3|b2,b3", (a_ids[i], b_ids[i]) its
    distinct linked id pairs, each ``times[i]`` links; ``row`` is unique within
    one computation, so write the result before using it twice.

    A null or empty text, and one whose tokens do not decode to its bytes (with
    the leading space), has no tokens.  Repeated rows are texts of their own, a
    null doc_id stays null, other columns are ignored; empty table: no rows.  A
    long text is aligned in slices between its segments.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(byte_bpe_path, encoding="utf-8") as f, open(piece_model_path, "rb") as g:  # fixed vocabularies
        models = spark.sparkContext.broadcast((f.read(), g.read()))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _worker_aligner(*models.value)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            ready, at = {}, 0
            for whose, data, offsets in _slices(texts, slice_bytes):
                for i, found in zip(whose, aligner.documents(data, offsets)):
                    ready.setdefault(i, []).append(found)
                if whose[-1] > at:  # the texts before the last one are complete
                    yield _result(row + at, batch.column(0)[at:whose[-1]], [_merged(ready.pop(i, [])) for i in range(at, whose[-1])],
                                  aligner.n_b)
                    at = whose[-1]
            if at < len(texts):
                yield _result(row + at, batch.column(0)[at:], [_merged(ready.pop(i, [])) for i in range(at, len(texts))], aligner.n_b)
            row += len(texts)

    return (docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
            .mapInArrow(align, _ROWS))


def _result(row: int, doc_ids: pa.Array, found: list[tuple], n_b: int) -> pa.RecordBatch:
    sizes = np.array([len(f[5]) for f in found])
    ends = pa.array(np.r_[0, np.cumsum(sizes)], pa.int32())
    codes = np.concatenate([f[5] for f in found])
    lists = [pa.ListArray.from_arrays(ends, pa.array(v, pa.int32())) for v in
             (codes // n_b, codes % n_b, np.concatenate([f[6] for f in found]))]
    numbers = [pa.array([f[i] for f in found], pa.int64()) for i in range(4)]
    return pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + len(found))), doc_ids, *numbers,
                                       pa.array([f[4] for f in found], pa.string()), *lists],
                                      names=[c.split()[0] for c in _ROWS.split(", ")])


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n, best): how many rows hold each linked pair (A's id in the
    upper 32 bits), and whether none of its A id's pairs has more."""
    pairs = rows.select(F.explode(_coded()).alias("p")).select(F.col("p.pair").alias("pair"))
    counted = pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    most = F.max("n").over(Window.partitionBy(F.shiftright("pair", 32)))  # at most B's vocabulary in a group
    return materialize(counted.withColumn("best", (F.col("n") == most).cast("int")), "align-pairs")


def _coded():
    return F.transform(F.arrays_zip("a_ids", "b_ids", "times"), lambda p: F.struct(
        (F.shiftleft(p["a_ids"].cast("long"), 32) + p["b_ids"]).alias("pair"), p["times"].alias("times")))


def link_counts(rows: DataFrame, counts: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(row, n_best, count_sum) of the rows that have links."""
    most = broadcast_bytes // PAIR_BYTES
    by_size = {r.size: r.pairs for r in counts.groupBy(F.floor(F.log2("n")).cast("int").alias("size"))
               .agg(F.count(F.lit(1)).alias("pairs")).collect()}  # at most 63 rows
    least, room = 64, most
    while least > 0 and (room := room - by_size.get(least - 1, 0)) >= 0:
        least -= 1
    frequent = counts.where(F.col("n") >= F.lit(1 << least if least < 63 else (1 << 63) - 1))
    links = rows.select("row", F.explode(_coded()).alias("p")).select("row", "p.*")
    found = _summed(links.join(F.broadcast(frequent), "pair"))
    if least > 0:
        rest = links.join(F.broadcast(frequent.select("pair")), "pair", "left_anti")
        rare = counts.where(F.col("n") < (1 << least))
        found = found.unionByName(_summed(rest.join(rare, "pair"))).groupBy("row").agg(
            F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return found


def _summed(links: DataFrame) -> DataFrame:
    return links.groupBy("row").agg(F.sum(F.col("times") * F.col("best")).alias("n_best"),
                                    F.sum(F.col("times") * F.col("n")).alias("count_sum"))


def default_models() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@query("op11_tokenizer_alignment")
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = aligned(table(spark, sf_dir, "documents"), *default_models())
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    rows = materialize(found.withColumn("groups_sha256", digest).drop("groups"), "align-rows")
    links = link_counts(rows, pair_counts(rows))
    counted = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")]
    return rows.join(links, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", *counted, "groups_sha256")
