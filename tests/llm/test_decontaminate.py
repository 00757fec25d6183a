import random
import re

import numpy as np
import pytest

from ladle.llm import decontaminate as D
from ladle.llm.decontaminate import Powers, Words, decontaminate

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, window=10):
    by_window = {}
    for item_id, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            by_window.setdefault(tuple(w[i:i + n]), set()).add(item_id)
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in by_window}:
            for i in range(len(w) - n + 1):
                if (ids := by_window.get(tuple(w[i:i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= {str(x) for x in ids if x is not None}
        out.append((doc_id, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def run(spark, docs, items, **more):
    d = spark.createDataFrame([(*r, "x", 7) for r in docs], "doc_id long, text string, row string, n long").repartition(3)
    b = spark.createDataFrame([(*r, "y") for r in items], "item_id long, text string, said string")
    return sorted([(r.doc_id, r.n_words, r.n_hit, list(r.items)) for r in decontaminate(d, b, **more).collect()], key=str)


def corpus(seed=4):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéñß한") for _ in range(rng.randint(1, 4))) for _ in range(60)]
    say = lambda n: rng.choice([" ", ", ", "\n", "-"]).join(rng.choice(vocabulary) for _ in range(n))
    template = say(12)
    items = [(i, f"{template} {say(rng.randint(1, 30))}") for i in range(20)]
    items += [(100 + i, say(i)) for i in range(0, 14)] + [(3, say(15)), (None, say(11)), (None, None), (200, ""), (201, "!!")]
    docs = [(1, None), (2, ""), (3, " \t"), (None, template), (4, template.upper()), (4, template), (5, say(3000))]
    for i in range(10, 60):
        passage = words(rng.choice(items)[1] or "x") or ["x"]
        a = rng.randrange(len(passage))
        docs.append((i, f"{say(rng.randint(0, 40))} {' '.join(passage[a:a + rng.randint(1, 25)])} {say(rng.randint(0, 9))}"))
    return docs, items


def test_against_brute_force(spark):
    docs, items = corpus()
    want = brute(docs, items)
    assert any(n and n < 10 for _, _, n, _ in want) and any(len(ids) >= 20 for *_, ids in want)
    assert run(spark, docs, items) == want


def test_small_windows_and_a_full_bit_array(spark, monkeypatch):
    docs, items = corpus(5)
    monkeypatch.setattr(D, "SMALLEST_BITS", 15)  # nearly every fingerprint seems to be there: words decide
    monkeypatch.setattr(D, "LARGEST_BITS", 15)
    monkeypatch.setattr(D, "BITS_PER_ENTRY", 1)
    assert run(spark, docs, items, window=4) == brute(docs, items, 4)


def test_empty_tables(spark):
    docs, items = corpus()
    assert run(spark, [], items) == []
    assert run(spark, docs, []) == [(*r[:2], 0, []) for r in brute(docs, items)]


@pytest.mark.parametrize("n", [1, 2, 3, 9, 10])
def test_equal_windows_share_a_fingerprint(n):
    rng = random.Random(n)
    a = " ".join(rng.choice("abc") for _ in range(400)).encode()
    w = Words(np.frombuffer(a, np.uint8), np.array([0]), Powers(1000))
    seen, fps = {}, w.fingerprints(n).tolist()
    assert len(fps) == 400 - n + 1
    for i, fp in enumerate(fps):
        assert seen.setdefault(w.said(i, n), fp) == fp


def test_long_texts_hash_in_segments(monkeypatch):
    text = ("word " * 50 + "x" * 700 + " word").encode()
    data = np.frombuffer(text, np.uint8)
    whole = Words(data, np.array([0]), Powers(1 << 12)).hashes
    monkeypatch.setattr(D, "SEGMENT", 64)
    assert (Words(data, np.array([0]), Powers(64)).hashes == whole).all()
    assert whole[0] == whole[49] == whole[-1] != whole[50]


def test_texts_do_not_run_into_each_other():
    data = np.frombuffer(b"abAB9", np.uint8)
    w = Words(data, np.array([0, 0, 2, 4, 4]), Powers(64))
    assert w.text.tolist() == [1, 2, 4] and w.hashes[0] == w.hashes[1] and not w.whole(2).any()
