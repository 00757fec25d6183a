import random

import numpy as np
from tokenizers import Tokenizer

from ladle.llm import tokens as T
from ladle.llm.packing import Packer, class_of, default_tokenizer, pack, sequences
from ladle.llm.tokens import WordEncoder

ODD = ["Don't they're, 'S. it's! x'll<|endoftext|>y <|EndOfText|> Áb H̱, İstanbul. KK 12,345.67 é, €, €€,. aẞ, İİ. naïve… "
       "!!! ,a, a.b, ¿qué? 한국, 5% x=5 (y) [z]{q} \"s\" ﬁ, ß. 가, '", "", "  \t\n", "A" * 300 + ",", " a b\x1cc\x85d", "a̸, ≠ b."]


def whole(texts):
    tokenizer = Tokenizer.from_file(default_tokenizer())
    return [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes() for t in texts]


def test_words_encode_like_whole_texts(messy_rows):
    texts = ODD + [r[1] for r in messy_rows if r[1] and len(r[1]) < 5000]
    with open(default_tokenizer(), encoding="utf-8") as f:
        encode = WordEncoder(f.read())
    for _ in range(2):  # the second time from the cache
        assert [x + b"\1\0\0\0" for x in encode(texts)] == whole(texts)


def test_classes_are_reciprocal():
    for length in range(1, 2049):
        j = class_of(length, 2048)
        assert 2048 < (j + 1) * length and j * length <= 2048


def test_the_cache_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(T, "CACHE_BYTES", 20_000)
    with open(default_tokenizer(), encoding="utf-8") as f:
        encode = WordEncoder(f.read())
    rng = random.Random(1)
    for _ in range(20):
        texts = [" ".join("".join(rng.choice("abcé,.1") for _ in range(rng.randint(1, 8))) for _ in range(30)) for _ in range(2)]
        assert [x + b"\1\0\0\0" for x in encode(texts)] == whole(texts)
        assert encode.held_bytes <= 40_000


def packed_lengths(lengths, capacity, batch):
    """Bins of documents of these lengths, packed some at a time."""
    packer, rows = Packer(capacity, 0), []
    for i in range(0, len(lengths), batch):
        for k, n in enumerate(lengths[i:i + batch]):
            packer.add(i + k, np.arange(n, dtype="<u4"))
        packer.fill()
        rows += packer.rows
        packer.rows = []
        assert sum(len(p.ids) for p in packer.filler) < capacity
    packer.close()
    return rows + packer.rows


def test_classes_fill_bins_and_only_gap_fillers_are_cut():
    rng = random.Random(7)
    for capacity, batch in ((64, 500), (64, 1), (2048, 100)):
        lengths = [rng.choice([1, 2, 3, rng.randint(1, capacity), rng.randint(1, capacity // 4), rng.randint(1, 3 * capacity)])
                   for _ in range(1500)]
        rows = packed_lengths(lengths, capacity, batch)
        by_sequence, by_doc = {}, {}
        for piece, sequence, offset in rows:
            by_sequence.setdefault(sequence, []).append((offset, len(piece.ids)))
            by_doc.setdefault(piece.doc_id, []).append((piece.start, piece.ids))
        for i, n in enumerate(lengths):
            ids = np.concatenate([x for _, x in sorted(by_doc[i], key=lambda p: p[0])])
            assert ids.tolist() == list(range(n))
        used = []
        for pieces in by_sequence.values():
            at = 0
            for offset, n in sorted(pieces):
                assert offset == at
                at += n
            used.append(at)
        assert all(n == capacity for n in used[:-1]) and sum(n < capacity for n in used) <= 1
        fits = [i for i, n in enumerate(lengths) if n <= capacity]
        whole_ones = sum(len(by_doc[i]) == 1 for i in fits)
        assert batch == 1 or whole_ones > 0.75 * len(fits)
        in_classes = 0
        for pieces in by_sequence.values():
            sizes = [n for _, n in sorted(pieces)]
            j = capacity // sizes[0]
            in_classes += len(sizes) >= j and all(capacity // n == j for n in sizes[:j])
        assert in_classes >= len(by_sequence) - capacity  # all but the last ones of the task start with j of class j
        assert capacity == 64 or in_classes > 0.9 * len(by_sequence)


def test_pieces_rebuild_every_document(messy, messy_rows):
    rows = pack(messy, default_tokenizer()).collect()
    want = sorted(zip([r[0] if r[0] is not None else -1 for r in messy_rows], whole([r[1] for r in messy_rows])))
    by_doc, by_sequence = {}, {}
    for r in rows:
        assert r.length * 4 == len(r.ids)
        by_doc.setdefault(-1 if r.doc_id is None else r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    got = []
    for k, pieces in by_doc.items():  # repeated ids are equal texts here
        copies = sum(p.start == 0 for p in pieces)
        pieces.sort(key=lambda p: p.start)
        starts = {}
        for p in pieces:
            starts.setdefault(p.start, []).append(p)
        ids = b"".join(same[0].ids for _, same in sorted(starts.items())) if copies == 1 else pieces[0].ids
        got += [(k, ids)] * copies
    assert sorted(got) == want
    padding = used = 0
    for pieces in by_sequence.values():
        pieces.sort(key=lambda p: p.offset)
        at = 0
        for p in pieces:
            assert p.offset == at
            at += p.length
        assert at <= 2048
        used += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding <= 4 * 2048  # one sequence a task
    # Documents that fit a sequence are cut only to fill the gaps of others.
    short = [p for p in by_doc.values() if p[0].doc_tokens <= 2048 and len({r.start for r in p}) == len(p)]
    assert sum(len(p) == 1 for p in short) > 0.7 * len(short)


def test_sequences_and_empty_table(messy):
    pieces = pack(messy, default_tokenizer(), capacity=64)
    for r in sequences(pieces).collect():
        assert len(r.ids) == 4 * r.n_tokens <= 256
    assert pack(messy.limit(0), default_tokenizer()).collect() == []
