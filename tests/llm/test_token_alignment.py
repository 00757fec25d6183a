import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ladle.llm import token_alignment as T
from ladle.llm.token_alignment import Aligner, aligned, default_models, link_counts, op11_tokenizer_alignment, pair_counts
from ladle.session import materialize

ODD = ["hello  world\nfoo é €\U0001F600 bar", "a\n\n  b \n c\t d  ", " \n x", "\n", "  ", "\r\n a\x0b b\x1c c\x85 d\xa0 e  f　 g",
       "한국어 텍스트, ﬁne. naïve é à", "literal ▁ mark", "▁", "<s> </s> <unk> <0x0A> <|endoftext|> \x00 \x7f x", "ab" * 400,
       "don't they're 'tis I'LL  we'd", "x" + "́" * 30 + " a‍\U0001F469‍\U0001F680 z", "ñ ñ é é\né a. b, (c) [d]", "0 12 345 6,789"]


def decoded():
    byte_bpe, model = default_models()
    a = Tokenizer.from_file(byte_bpe)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=model)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in plain)}

    def encode(text):
        ids = a.encode(" " + text, add_special_tokens=False).ids
        left = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in ids]
        right = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
                 for i in b.encode(text)]
        return left, right
    return encode


ENCODE = decoded()


def plain(text):
    """(groups as lists of A and B ids) by decoded bytes alone."""
    if not text:
        return []
    left, right = ENCODE(text)
    if not (b"".join(x for _, x in left) == b"".join(x for _, x in right) == (" " + text).encode()):
        return []
    ends = [{int(e): i + 1 for i, e in enumerate(np.cumsum([len(x) for _, x in side]))} for side in (left, right)]
    out, at = [], [0, 0]
    for cut in sorted(ends[0].keys() & ends[1].keys()):
        group = []
        for k, side in enumerate((left, right)):
            stop = ends[k][cut]
            group.append([i for i, _ in side[at[k]:stop]])
            at[k] = stop
        out.append(group)
    return out


def said(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def brute(texts):
    groups = [plain(t) for t in texts]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    n = Counter(p for found in links for p in found)
    most = {}
    for (a, _), k in n.items():
        most[a] = max(most.get(a, 0), k)
    return [(sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(found.values()),
             sum(t for (a, b), t in found.items() if n[a, b] == most[a]), sum(t * n[p] for p, t in found.items()),
             hashlib.sha256(said(g).encode()).hexdigest() if g else "") for g, found in zip(groups, links)]


def fuzz(seed=2, n=250):
    rng = random.Random(seed)
    atoms = ["a", "The", "the", "tion", "é", "ñ", "ß", "한", "€", "\U0001F600", "1", "23", ".", ",", "'s", "’", "-", "\n", " ", " ", " ",
             "  ", "\t", "\r\n", "\xa0", " ", "​", "_", "<", "|", "X", "\x1f", "\x85", "א", "中", "文字"]
    return ["".join(rng.choice(atoms) for _ in range(rng.randint(1, 40))) for _ in range(n)]


def test_segments_align_like_whole_texts():
    byte_bpe, model = default_models()
    with open(byte_bpe, encoding="utf-8") as f, open(model, "rb") as g:
        aligner = Aligner(f.read(), g.read())
    texts = ODD + fuzz()
    want = [said(plain(t)) for t in texts]
    assert sum(w == "" for w in want) >= 2 and sum(w != "" for w in want) > 200
    for limit in (1 << 20, 16):  # also cut between segments, from the cache
        parts = {}
        for whose, data, offsets in T._slices([t.encode() for t in texts], limit):
            for i, found in zip(whose, aligner.documents(data, offsets)):
                parts.setdefault(i, []).append(found)
        assert [T._merged(parts[i])[4] for i in range(len(texts))] == want


def test_a_full_cache_starts_anew(monkeypatch):
    byte_bpe, model = default_models()
    with open(byte_bpe, encoding="utf-8") as f, open(model, "rb") as g:
        aligner = Aligner(f.read(), g.read())
    monkeypatch.setattr(T, "CACHE_BYTES", 5000)
    texts = fuzz(8, 60)
    got = []
    for t in texts:
        data = np.frombuffer((" " + t).encode(), np.uint8)
        found = aligner.documents(data, np.array([0, len(data)]))[0]
        got.append(found[4] if found else "")
    assert got == [said(plain(t)) for t in texts] and aligner.used < 10_000


@pytest.mark.parametrize("broadcast", [64 << 20, 40 * T.PAIR_BYTES, 0])
def test_counts_with_and_without_a_broadcast(spark, broadcast):
    texts = [*ODD, *fuzz(3, 60), "the same", "the same", None, ""]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, n_a int").repartition(3)
    held = materialize(aligned(docs, *default_models(), slice_bytes=64), "test-align")
    links = link_counts(held, pair_counts(held), broadcast)
    got = {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best or 0, r.count_sum or 0,
                      hashlib.sha256(r.groups.encode()).hexdigest() if r.n_a else "")
           for r in held.join(links, "row", "left").collect()}
    assert [got[i] for i in range(len(texts))] == brute([t or "" for t in texts])


def test_messy_documents(spark, messy, messy_rows, tmp_path):
    messy.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(str, op11_tokenizer_alignment(spark, str(tmp_path)).collect()))
    want = brute([r[1] or "" for r in messy_rows])
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rows = [f"Row(doc_id={r[0]}, {', '.join(f'{k}={v!r}' for k, v in zip(names, w))})" for r, w in zip(messy_rows, want)]
    assert got == sorted(rows)
    messy.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert op11_tokenizer_alignment(spark, f"{tmp_path}/none").collect() == []
