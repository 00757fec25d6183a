"""Prefix trie of conversations by burst tries.

A conversation is its sequence of turn ids (SHA-256 of role and text, 32 bytes
each, end to end: its path); a node is a distinct prefix, and the bytes of a
path sort a node before what extends it.

1. Equal conversations are folded first, however many there are: their ids are
   range-sorted, joined in bounded pieces where they lie, and the pieces of a
   path stream through its digest in order.
2. Containers hold the suffixes under a trie head, at first all under the
   root.  A container of more than ``CONTAINER`` turns bursts: its head becomes
   a node, and its sequences move to containers of their next turn id.  Heads
   are counted by partial aggregates, and only sequences under burst heads are
   looked at again, so a level costs what is left of them.
3. The containers that remain are bounded.  They are dealt to tasks whole,
   sorted there by path, and each is swept once into its nodes.
4. What the sweeps found below a burst head (leaves, saved tokens, children)
   is summed into all heads on its path by partial aggregates.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.llm.batches import bounded_batches
from ladle.llm.registry import query, table
from ladle.session import materialize

CONTAINER = 1 << 14  # turns of one container
IDS_IN_PIECE = 4096
WORD = r"[^\x20\x09-\x0D]+"
ID = 32              # bytes of a turn id
_NODE = ("conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "ends_sha256 string, parent_conv_id long, head binary")
_SEQUENCE = "path binary, words array<int>, n long, conv_id long, ends string"
_NO_ENDS = hashlib.sha256().hexdigest()


def turn_sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation as (turn, id, words),
    by turn (null first), ties by id."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    framed = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.sha2(framed, 256).alias("id"), F.regexp_count(text, F.lit(WORD)).cast("int").alias("words"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "id", "words"))).alias("turns"))


def _path(turns: Column) -> Column:
    return F.unhex(F.array_join(F.transform(turns, lambda t: t["id"]), ""))


def rebuilt(conversations: DataFrame, shared: int = 20, leads: int = 4) -> DataFrame:
    """(conv_id, path, words): every conversation c with its first h turns
    taken from conversation c - c % ``shared``, h = crc32(c) % ``leads``."""
    own = materialize(turn_sequences(conversations), "trie-turns")
    bases = own.where(f"conv_id % {shared} = 0").select(F.col("conv_id").alias("base"),
                                                         F.slice("turns", 1, leads).alias("lead"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(leads)).cast("int")
    parts = (own.withColumn("base", F.expr(f"conv_id - conv_id % {shared}")).join(bases, "base", "left")
             .withColumn("h", h)
             .select("conv_id", F.concat(F.coalesce(F.slice("lead", F.lit(1), F.col("h")), F.slice("turns", 1, 0)),
                                         F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns")))
    return parts.select("conv_id", _path(F.col("turns")).alias("path"),
                        F.transform("turns", lambda t: t["words"]).alias("words"))


def _pieces(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Of sorted (path, conv_id, words): the ids of a path joined, some at a time."""
    held: tuple | None = None
    out: list[tuple] = []

    def made() -> pa.RecordBatch:
        columns = list(zip(*out))
        out.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()),
             pa.array(columns[3], pa.string()), pa.array(columns[4], pa.list_(pa.int32()))],
            names=["path", "first", "n", "ids", "words"])

    def close() -> None:
        out.append((held[0], held[1][0], len(held[1]), ",".join(map(str, held[1])), held[2]))

    for batch in batches:
        for path, conv_id, words in zip(*(c.to_pylist() for c in batch.columns)):
            if held and (held[0] != path or len(held[1]) == most):
                close()
                held = None
            if held:
                held[1].append(conv_id)
            else:
                held = (path, [conv_id], words)
        if out:
            yield made()
    if held:
        close()
        yield made()


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted (path, first, n, ids, words): one row of each path with the digest of all its ids."""
    held: list | None = None
    out: list[tuple] = []

    def made() -> pa.RecordBatch:
        paths, words, counts, firsts, digests = zip(*out)
        out.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.binary()), pa.array(words, pa.list_(pa.int32())), pa.array(counts, pa.int64()),
             pa.array(firsts, pa.int64()), pa.array(digests, pa.string())], names=["path", "words", "n", "conv_id", "ends"])

    def close() -> None:
        out.append((held[0], held[1], held[2], held[3], held[4].hexdigest()))

    for batch in batches:
        for path, first, n, ids, words in zip(*(c.to_pylist() for c in batch.columns)):
            if held and held[0] == path:
                held[2] += n
                held[4].update(b"," + ids.encode())
            else:
                if held:
                    close()
                held = [path, words, n, first, hashlib.sha256(ids.encode())]
        if out:
            yield made()
    if held:
        close()
        yield made()


def folded(sequences: DataFrame, ids_in_piece: int = IDS_IN_PIECE) -> DataFrame:
    """(path, words, n, conv_id, ends): each distinct sequence once, with the
    number and smallest id of its conversations and the digest of their ids."""
    pieces = (sequences.select("path", "conv_id", "words").repartitionByRange("path", "conv_id")
              .sortWithinPartitions("path", "conv_id")
              .mapInArrow(lambda batches: _pieces(batches, ids_in_piece), "path binary, first long, n long, ids string, words array<int>"))
    return (pieces.repartition("path").sortWithinPartitions("path", "first").mapInArrow(_digested, _SEQUENCE))


def nodes_of(head: bytes, rows: list[tuple]) -> list[tuple]:
    """Nodes of one container: rows are its sequences (path, words, n,
    conv_id, ends) sorted by path, all of which start with ``head``; the first
    node is the head's own."""
    level = len(head) // ID
    depth, parent, n_convs, first, words, ends = [level], [-1], [0], [None], [rows[0][1][level - 1] if level else 0], [_NO_ENDS]
    stack, last = [0], head  # the nodes from the head to the last sequence's end
    for path, counted, n, conv_id, digest in rows:
        shared, most = len(head), min(len(last), len(path))
        while shared < most and last[shared:shared + ID] == path[shared:shared + ID]:
            shared += ID
        del stack[shared // ID - level + 1:]
        for d in range(shared // ID, len(path) // ID):
            depth.append(d + 1)
            parent.append(stack[-1])
            n_convs.append(0)
            first.append(None)
            words.append(counted[d])
            ends.append(_NO_ENDS)
            stack.append(len(depth) - 1)
        node, last = stack[-1], path
        n_convs[node], first[node], ends[node] = n, conv_id, digest
    children, leaves, saved = [0] * len(depth), [0] * len(depth), [0] * len(depth)
    for i in range(len(depth) - 1, -1, -1):  # a node comes after its parent
        leaves[i] = leaves[i] or 1
        saved[i] += (n_convs[i] - 1) * words[i]
        up = parent[i]
        if up >= 0:
            n_convs[up] += n_convs[i]
            first[up] = first[i] if first[up] is None else min(first[up], first[i])
            children[up] += 1
            leaves[up] += leaves[i]
            saved[up] += saved[i]
    return [(first[i], depth[i], n_convs[i], children[i], leaves[i], saved[i], ends[i],
             first[parent[i]] if i else None, None if i else head) for i in range(len(depth))]


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Containers sorted by (head, path) into nodes, one after the other."""
    head, rows = None, []
    types = [pa.int64()] * 6 + [pa.string(), pa.int64(), pa.binary()]
    names = [c.split()[0] for c in _NODE.split(", ")]

    def made() -> pa.RecordBatch:
        columns = zip(*nodes_of(head, rows))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    for batch in batches:
        found = []
        for at, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if rows and at != head:
                found.append(made())
                rows = []
            head = at
            rows.append(row)
        if found:
            yield pa.Table.from_batches(found).combine_chunks().to_batches()[0]
    if rows:
        yield made()


def _prefix(depth: Column) -> Column:
    return F.substring("path", F.lit(1), (depth * ID).cast("int"))


def prefix_trie(sequences: DataFrame, container: int = CONTAINER, ids_in_piece: int = IDS_IN_PIECE) -> DataFrame:
    """Nodes of the trie of ``sequences`` (conv_id, path, words): conv_id (the
    smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.  A node is the first ``depth`` turns of
    conversation ``conv_id``.

    A sequence may be empty (it ends at the root); rows that repeat a conv_id
    are members each.  Null roles and texts count as empty, turns that tie are
    ordered by their id, and rows without a conv_id belong to no conversation
    (``turn_sequences``).  No conversations: no nodes, not even a root.
    A task holds one container, of ``container`` turns or one sequence.
    """
    bounded_batches(sequences.sparkSession, 4096)
    live = materialize(folded(sequences, ids_in_piece).withColumn("depth", F.size("words")), "trie-sequences")
    level, heads, settled = 0, [], []
    while True:
        at = F.lit(level)
        headed = live.withColumn("head", _prefix(at))
        ended = F.col("depth") == at
        word = F.max(F.get("words", at - 1)) if level else F.lit(0)
        counted = headed.groupBy("head").agg(
            F.sum(F.greatest(F.lit(1), F.col("depth") - at)).alias("slots"), F.count(F.lit(1)).alias("sequences"),
            F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"), word.alias("words"),
            F.max(F.when(ended, F.col("ends"))).alias("ends"))
        burst = materialize(counted.where((F.col("slots") > container) & (F.col("sequences") > 1))
                            .select("head", at.cast("long").alias("depth"), "n_convs", "conv_id",
                                    F.col("words").cast("long").alias("words"), "ends"), "trie-heads")
        if burst.isEmpty():
            settled.append(headed)
            break
        settled.append(headed.join(burst.select("head"), "head", "left_anti").select(*headed.columns))
        live = materialize(headed.join(burst.select("head"), "head", "left_semi").where(~ended).drop("head"), "trie-live")
        heads.append(burst)
        level += 1
    containers = settled[0]
    for more in settled[1:]:
        containers = containers.unionByName(more)
    swept = (containers.select("head", "path", "words", "n", "conv_id", "ends").repartition("head")
             .sortWithinPartitions("head", "path").mapInArrow(_sweep, _NODE))
    if not heads:
        return swept.select(*COLUMNS)
    return _with_heads(materialize(swept, "trie-nodes"), heads)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _with_heads(swept: DataFrame, heads: list[DataFrame]) -> DataFrame:
    """The swept nodes with their tops' parents, and the nodes of the burst heads."""
    burst = heads[0]
    for more in heads[1:]:
        burst = burst.unionByName(more)
    own_saved = ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")
    up = F.substring("head", F.lit(1), ((F.col("depth") - 1) * ID).cast("int"))
    tops = swept.where("head is not null")

    def on_path(rows: DataFrame, last: Column) -> DataFrame:
        ancestor = F.substring("head", F.lit(1), (F.col("d") * ID).cast("int"))
        return (rows.where(last >= 0).withColumn("d", F.explode(F.sequence(F.lit(0).cast("long"), last)))
                .select(ancestor.alias("head"), "n_leaves", "saved_tokens"))

    below = (on_path(tops, F.col("depth") - 1)
             .unionByName(on_path(burst.select("head", "depth", F.lit(0).cast("long").alias("n_leaves"), own_saved),
                                  F.col("depth")))
             .groupBy("head").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")))
    children = (tops.select(up.alias("head")).unionByName(burst.where("depth > 0").select(up.alias("head")))
                .groupBy("head").agg(F.count(F.lit(1)).alias("n_children")))
    parents = burst.select(F.col("head").alias("above"), F.col("conv_id").alias("parent"))
    # The root's path is empty and it is its own prefix: it has no parent.
    above = F.when(F.col("depth") > 0, up).alias("above")
    inner = (burst.withColumn("above", above).join(parents, "above", "left").join(below, "head").join(children, "head")
             .select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                     "saved_tokens", F.coalesce("ends", F.lit(_NO_ENDS)).alias("ends_sha256")))
    outer = (tops.withColumn("above", above).join(parents, "above", "left")
             .withColumn("parent_conv_id", F.col("parent")).select(*COLUMNS))
    return swept.where("head is null").select(*COLUMNS).unionByName(outer).unionByName(inner.select(*COLUMNS))


_ORACLE = r"""
with own as (
  select conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} order by turn nulls first, role, text) as turns
  from conversations where conv_id is not null group by conv_id),
crc as (  -- CRC-32 bit by bit: each byte is mixed in before eight shifts
  select conv_id, turns,
         xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(
               string_split(cast(conv_id as varchar), ''), lambda c: [ascii(c)::bigint, 0, 0, 0, 0, 0, 0, 0]))),
             lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))), 4294967295) % 4 as h
  from own),
seqs as (
  select c.conv_id, list_concat(coalesce(list_slice(b.turns, 1, h), []), list_slice(c.turns, h + 1, len(c.turns))) as turns
  from crc c left join own b on b.conv_id = c.conv_id - c.conv_id % 20),
members as (
  select conv_id, d, list_slice(turns, 1, d) as path, d = len(turns) as ends
  from (select conv_id, turns, unnest(generate_series(0, len(turns))) as d from seqs)),
nodes as (
  select path, d, min(conv_id) as conv_id, count(*) as n_convs,
         sha256(coalesce(string_agg(conv_id, ',' order by conv_id) filter (where ends), '')) as ends_sha256
  from members group by path, d),
own_values as (
  select n.*, p.conv_id as parent_conv_id,
         case when n.d = 0 then 0 else (n.n_convs - 1) * len(regexp_extract_all(n.path[n.d].t, '[^\x20\x09-\x0D]+')) end as saved,
         (select count(*) from nodes k where k.d = n.d + 1 and list_slice(k.path, 1, n.d) = n.path) as n_children
  from nodes n left join nodes p on p.d = n.d - 1 and list_slice(n.path, 1, n.d - 1) = p.path),
below as (
  select a.path, a.d, sum(case when b.n_children = 0 then 1 else 0 end) as n_leaves, sum(b.saved) as saved_tokens
  from nodes a join own_values b on b.d >= a.d and list_slice(b.path, 1, a.d) = a.path
  group by a.path, a.d)
select conv_id, cast(o.d as bigint) as depth, parent_conv_id, cast(n_convs as bigint) as n_convs,
       cast(n_children as bigint) as n_children, cast(n_leaves as bigint) as n_leaves,
       cast(saved_tokens as bigint) as saved_tokens, ends_sha256
from own_values o join below b on o.d = b.d and o.path = b.path
"""


@query("op13_conversation_trie", _ORACLE)
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(table(spark, sf_dir, "conversations"))).select(*COLUMNS)
