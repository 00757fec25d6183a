"""Word-cached encoding with a tokenizers file inside Python tasks."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_BYTES = 96 << 20   # of one worker's stems and marks
ENTRY_BYTES = 200        # of a cached one beside its text and ids, estimated
JOINED_WORDS = 20_000
ENCODED_AT_ONCE = 4096
LONGEST_CACHED = 64
# ASCII marks that never join a letter's token; the apostrophe may ("'s"), and
# "<", "|", ">" may belong to a special token.
_MARKS = ".,;:!?#$%&*()[]{}=+-/\""


class Recent(dict):
    """A bounded cache of two generations: what is asked for again moves to
    the newer one, the older one is dropped when that is full."""

    def __init__(self, limit: int):
        self.limit, self.older = limit, {}

    def missing(self, keys) -> list:
        if len(self) > self.limit:
            self.older = dict(self)
            self.clear()
        absent = []
        for k in keys:
            if k not in self:
                if k in self.older:
                    self[k] = self.older[k]
                else:
                    absent.append(k)
        return absent


class WordEncoder:
    """Token ids of whole texts.

    The vocabulary drops white space and marks the end of every run of
    letters, so no token crosses white space or the step from a letter to a
    mark: a text's ids are those of its words in turn, and a word's are those
    of its stem and of its closing marks.  Stems recur, so each is encoded
    once per worker while the cache, bounded by bytes, lasts.
    """

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self._tokenizer = Tokenizer.from_str(tokenizer_json)
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._clear()

    def _clear(self) -> None:
        self._slots: dict[str, int] = {"": 0}
        self._ids, self._at = np.empty(0, "<u4"), np.zeros(2, np.int32)
        self.held_bytes = 0

    def _encode_each(self, parts: list[str]) -> list[np.ndarray]:
        out = []
        for i in range(0, len(parts), ENCODED_AT_ONCE):
            encoded = self._tokenizer.encode_batch_fast(parts[i:i + ENCODED_AT_ONCE], add_special_tokens=False)
            out += [np.asarray(e.ids, dtype="<u4") for e in encoded]
        return out

    def _encode_letters(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of runs of letters, encoded in one call and parted at the word ends."""
        ids, sizes = [np.empty(0, "<u4")], [np.empty(0, np.int64)]
        for i in range(0, len(parts), JOINED_WORDS):
            some = parts[i:i + JOINED_WORDS]
            joined = self._tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0]
            found = np.asarray(joined.ids, dtype="<u4")
            ends = np.flatnonzero(self._ends[found]) + 1
            if len(ends) != len(some):  # a letter that lower-cases to more than letters
                each = self._encode_each(some)
                found, ends = np.concatenate(each), np.cumsum([len(e) for e in each])
            ids.append(found)
            sizes.append(np.diff(ends, prepend=0))
        return np.concatenate(ids), np.concatenate(sizes)

    def _learn(self, parts: list[str]) -> None:
        letters = [p for p in parts if p.isalpha()]
        others = [p for p in parts if not p.isalpha()]
        ids, sizes = self._encode_letters(letters)
        each = self._encode_each(others)
        self._slots.update(zip(letters + others, range(len(self._slots), len(self._slots) + len(parts))))
        self._ids = np.concatenate([self._ids, ids, *each])
        grown = np.r_[sizes, np.array([len(e) for e in each], np.int64)]
        self._at = np.concatenate([self._at, (self._at[-1] + np.cumsum(grown)).astype(np.int32)])

    @staticmethod
    def _split(words: list[str]) -> tuple[list[str], list[str]]:
        """Each word's stem (lower-cased if ASCII letters) and closing marks."""
        stems, marks = [], []
        for word in words:
            stem, mark = word.rstrip(_MARKS), ""
            if len(stem) < len(word):
                if stem and stem[-1].lower()[-1].isalpha() and "|" not in word:
                    mark = word[len(stem):]
                else:
                    stem = word
            stems.append(stem.lower() if stem.isascii() and stem.isalpha() else stem)
            marks.append(mark)
        return stems, marks

    def _slots_of(self, parts: list[str]) -> np.ndarray:
        return np.fromiter(map(self._slots.__getitem__, parts), np.int32, len(parts))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of a string array without nulls: text i has ids[offsets[i]:offsets[i + 1]]."""
        split = pc.ascii_split_whitespace(texts)
        of_text = split.offsets.to_numpy().astype(np.int64)
        coded = split.flatten().dictionary_encode()
        stems, marks = self._split(coded.dictionary.to_pylist())
        distinct = {*stems, *marks}
        new = [p for p in distinct if p not in self._slots]
        if self.held_bytes and self.held_bytes + self._cost(new) > CACHE_BYTES:
            self._clear()
            new = [p for p in distinct if p]
        if new:
            self.held_bytes += self._cost(new)
            self._learn(new)
        word = coded.indices.to_numpy()
        slots = np.stack([self._slots_of(stems)[word], self._slots_of(marks)[word]], axis=1).ravel()
        sizes = self._at[slots + 1] - self._at[slots]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat((self._at[slots] - ends + sizes).astype(np.int32), sizes)
        at += np.arange(total, dtype=np.int32)
        ids = self._ids[at]
        return ids, np.r_[0, ends][2 * (of_text - of_text[0])]

    @staticmethod
    def _cost(parts: list[str]) -> int:
        return 3 * sum(map(len, parts)) + ENTRY_BYTES * len(parts)

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit bytes."""
        ids, offsets = self.encode(pa.array([t or "" for t in texts], pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]


_encoders: dict[int, WordEncoder] = {}


def encoder(tokenizer_json: str) -> WordEncoder:
    """The worker's encoder of a vocabulary; it outlives the task."""
    key = hash(tokenizer_json)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = WordEncoder(tokenizer_json)
    return _encoders[key]
