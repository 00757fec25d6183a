"""Suffix arrays, permuted prefixes and substring dedup against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from ladle.llm.substring_dedup import substring_dedup
from ladle.llm.suffix_array import permuted_lcp, suffix_array


def test_suffix_array_and_prefixes_match_brute_force():
    for seed in range(120):
        rng = random.Random(seed)
        k, n = rng.choice([1, 2, 3, 20]), rng.randint(1, 90)
        text = [rng.randint(1, k) for _ in range(n)]
        if seed % 3 == 0:
            text = (text[:rng.randint(1, 10)] * 30)[:n]
        text.append(0)
        array = np.array(text, np.uint16)
        order = suffix_array(array, k + 1)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        plcp, phi = permuted_lcp(array, order)
        for a, b in zip(order[:-1].tolist(), order[1:].tolist()):
            common = 0
            while text[a + common:a + common + 1] == text[b + common:b + common + 1] != []:
                common += 1
            assert (plcp[b], phi[b]) == (common, a)


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(d), sum(gone), runs, bytes(c for c, g in zip(d, gone) if not g)))
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = [say(30) for _ in range(4)]
    texts = [None, "", "short", "a" * 300, "ab" * 90, shared[0], shared[0]]
    for _ in range(50):
        parts = [say(rng.randint(0, 25))]
        for s in rng.sample(shared, rng.randint(0, 2)):
            a = rng.randint(0, 40)
            parts += [s[a:a + rng.randint(20, 140)], say(rng.randint(0, 12))]
        texts.append(" ".join(parts))
    texts += texts[-5:] + [texts[-1] + "!", "x" + texts[-2]]
    return texts


@pytest.mark.parametrize("shard_bytes", [1 << 20, 3000, 600])
def test_matches_brute_force(spark, shard_bytes):
    texts = corpus(shard_bytes)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, th string")
    rows = substring_dedup(docs.repartition(5), length=40, gram=8, shard_bytes=shard_bytes).collect()
    found = {r.doc_id: (r.n_bytes, sum(s["end"] - s["start"] for s in r.spans), len(r.spans), bytes(r.kept)) for r in rows}
    assert [found[i] for i in range(len(texts))] == brute(texts, 40)


def test_a_passage_in_every_document(spark):
    rng = random.Random(11)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(90))
    noise = lambda: "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 120)))
    texts = [noise() + passage + noise() for _ in range(150)] + [passage[:60] + noise(), noise() + passage[30:]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = substring_dedup(docs, length=40, gram=8, shard_bytes=2000).collect()
    found = {r.doc_id: (r.n_bytes, sum(s["end"] - s["start"] for s in r.spans), len(r.spans), bytes(r.kept)) for r in rows}
    assert [found[i] for i in range(len(texts))] == brute(texts, 40)


def test_null_ids_repeated_rows_and_empty_table(spark):
    text = "0123456789" * 3
    docs = spark.createDataFrame([(None, text), (None, text), (1, "q" * 20), (1, None)], "doc_id long, text string")
    rows = substring_dedup(docs, length=30, gram=5).collect()
    assert sorted(bytes(r.kept) for r in rows) == [b"", b"", b"", b"q" * 20]
    assert substring_dedup(docs.limit(0)).collect() == []
