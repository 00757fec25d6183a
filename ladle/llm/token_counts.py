"""Token counts by a linear longest-match automaton.

Greedy word-piece tokenisation takes the longest vocabulary entry at each
place of a word.  The vocabulary's trie is given failure links: where the next
byte has no edge, the link leads to the state after the pieces that are
certain by then, and the number of those pieces is stored with it.  A word is
read once, byte by byte, adding the stored counts; no piece is ever built and
no byte read twice (Song et al., 2021).

A file's pieces that end a word are read as ending in a byte of their own
kind, so one trie serves word ends and insides.  Every single byte is a piece
in both kinds, hence every word has an answer.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.llm.batches import bounded_batches
from ladle.llm.registry import query, table
from ladle.llm.tokens import LONGEST_CACHED, Recent

END = 256            # added to a word's last byte
WORD_END = "</w>"    # the file's mark of a piece that ends a word
CACHED_WORDS = 400_000


def byte_letters() -> dict[str, int]:
    """The byte each letter of a byte-level vocabulary stands for: printable
    Latin-1 letters stand for themselves, the rest for 256, 257, ... in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    letters |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))}
    return letters


def pieces(vocabulary_json: str) -> list[tuple[int, ...]]:
    """The vocabulary's pieces as byte symbols, the last one plus END where the piece ends a word."""
    letters, out = byte_letters(), []
    for token in json.loads(vocabulary_json)["model"]["vocab"]:
        ends = token.endswith(WORD_END) and token != WORD_END
        symbols = [letters.get(c) for c in (token[:-len(WORD_END)] if ends else token)]
        if symbols and None not in symbols:
            out.append((*symbols[:-1], symbols[-1] + END) if ends else tuple(symbols))
    return out


class Automaton:
    """Trie with failure links; ``popped[v]`` pieces are certain when state v fails."""

    def __init__(self, vocabulary: list[tuple[int, ...]]):
        self.edges: list[dict[int, int]] = [{}]
        whole = [False]
        for piece in vocabulary:
            at = 0
            for symbol in piece:
                following = self.edges[at].get(symbol)
                if following is None:
                    following = self.edges[at][symbol] = len(self.edges)
                    self.edges.append({})
                    whole.append(False)
                at = following
            whole[at] = True
        self.fail: list[int] = [-1] * len(self.edges)   # -1: none
        self.popped = [0] * len(self.edges)
        queue = deque([0])
        while queue:  # by depth: a link leads to a shallower state
            parent = queue.popleft()
            for symbol, state in self.edges[parent].items():
                queue.append(state)
                if whole[state]:
                    self.fail[state], self.popped[state] = 0, 1
                    continue
                link, count = self.fail[parent], self.popped[parent]
                while link >= 0 and symbol not in self.edges[link]:
                    count += self.popped[link]
                    link = self.fail[link]
                if link >= 0:
                    self.fail[state], self.popped[state] = self.edges[link][symbol], count

    def count(self, word: bytes) -> int:
        """Number of pieces of the greedy longest match of a word."""
        edges, fail, popped = self.edges, self.fail, self.popped
        at = total = 0
        symbols = [*word[:-1], word[-1] + END]
        for symbol in symbols:
            while symbol not in edges[at]:
                if fail[at] < 0:
                    raise ValueError(f"the vocabulary has no piece for byte {symbol}")
                total += popped[at]
                at = fail[at]
            at = edges[at][symbol]
        while at:
            if fail[at] < 0:
                raise ValueError("the vocabulary cannot close this word")
            total += popped[at]
            at = fail[at]
        return total


_workers: dict[int, tuple[Automaton, Recent]] = {}


def count_tokens(docs: DataFrame, tokenizer_path: str, text: str = "text", doc_id: str = "doc_id",
                 lower: bool = True) -> DataFrame:
    """(doc_id, n_words, n_tokens) of every row: words are runs of anything but
    space, tab, LF, VT, FF and CR, with A-Z lower-cased for a lower-case vocabulary.

    A null, empty or wordless text counts 0 and 0; a null doc_id stays null;
    repeated rows are counted each; empty table: no rows.  Other columns of
    ``docs`` are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as f:  # a fixed vocabulary, the same for any input
        vocabulary = spark.sparkContext.broadcast(f.read())

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(vocabulary.value)
        if key not in _workers:
            _workers[key] = Automaton(pieces(vocabulary.value)), Recent(CACHED_WORDS)
        automaton, known = _workers[key]
        for batch in batches:
            texts = [(t or "").encode("utf-8") for t in batch.column(1).to_pylist()]
            words = [(t.lower() if lower else t).split() for t in texts]
            fresh: set[bytes] = set()
            for w in words:
                fresh.update(w)
            new = known.missing(fresh)
            known.update((w, automaton.count(w)) for w in new)
            totals = [sum(map(known.__getitem__, w)) for w in words]
            for w in new:
                if len(w) > LONGEST_CACHED:
                    del known[w]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(len, words), pa.int64()),
                                              pa.array(totals, pa.int64())], names=["doc_id", "n_words", "n_tokens"])

    return (docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
            .mapInArrow(counted, "doc_id long, n_words long, n_tokens long"))


@query("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
