import random
import re

import numpy as np
import pandas as pd
import pytest
import xxhash

from ladle.llm.components import components
from ladle.llm.simhash import drop_near_duplicates, fingerprint, links, masks, near_duplicates


def plain_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + k]).encode(), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(values, radius=3):
    values = list(values)
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


def partition(labels):
    groups = {}
    for i, x in enumerate(labels):
        groups.setdefault(x, []).append(i)
    return sorted(groups.values())


def test_every_pair_within_the_radius_collides():
    rng = random.Random(3)
    assert len(masks()) == 15
    for _ in range(3000):
        diff = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(m & diff == 0 for m in masks())


def test_fingerprints(messy_rows):
    texts = [r[1] for r in messy_rows] + ["Éa B c", "ABC", "a\x0bb c  d\r\ne"]
    assert [fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]


@pytest.mark.parametrize("largest", [4, 1024])
def test_dense_clouds_keep_every_link(spark, largest):
    rng = random.Random(9)
    values = set()
    for _ in range(3):  # one dense cloud and sparse chains
        centre = rng.getrandbits(64)
        for _ in range(150):
            values.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
        for _ in range(6):
            centre ^= sum(1 << b for b in rng.sample(range(64), 3))
            values.add(centre)
    values |= {0, 1, 2**64 - 1, *(rng.getrandbits(64) for _ in range(100))}
    ordered = sorted(values)
    fps = np.array(ordered, np.uint64).view(np.int64)
    found = {r.node: r.component for r in components(links(
        spark.createDataFrame(pd.DataFrame({"fp": fps})), 3, largest)).collect()}
    assert partition([found.get(f, f) for f in fps.tolist()]) == partition(brute(ordered))


def test_messy_documents(messy, messy_rows):
    rows = near_duplicates(messy).collect()
    assert len(rows) == len(messy_rows)
    label = brute([plain_fingerprint(r[1]) for r in messy_rows])
    smallest = {}
    for r, x in zip(messy_rows, label):
        if r[0] is not None:
            smallest[x] = min(smallest.get(x, r[0]), r[0])
    want = sorted(str((r[0], plain_fingerprint(r[1]), smallest.get(x))) for r, x in zip(messy_rows, label))
    assert sorted(str((r.doc_id, r.fp % 2**64, r.component_id)) for r in rows) == want


def test_kept_documents(messy):
    kept = drop_near_duplicates(messy)
    assert kept.columns == messy.columns
    assert kept.where("doc_id between 70 and 79").count() < 10
    assert drop_near_duplicates(messy.limit(0)).collect() == [] == near_duplicates(messy.limit(0)).collect()


def test_components_of_a_long_chain(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)], "u long, v long")
    assert {r.component for r in components(edges).collect()} == {0}
    assert components(edges.limit(0)).collect() == []


def test_every_component_leaves_one_row(spark, messy, messy_rows):
    base = " ".join(f"w{i}" for i in range(400))
    near = next(t for i in range(400) if (t := base.replace(f"w{i} ", "changed ", 1)) != base
                and 0 < (plain_fingerprint(t) ^ plain_fingerprint(base)).bit_count() <= 3)
    rows = [*[(3, base)] * 5, (3, near), (8, near), (None, base),  # the representative's id repeats, also with another text
            *[(None, "no id of this text at all")] * 1000, *[(None, "another text without any id")] * 2, (None, ""), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    kept = drop_near_duplicates(docs).collect()
    label = brute([plain_fingerprint(t) for _, t in rows])
    assert len(kept) == len(set(label)) and [r.doc_id for r in kept if r.doc_id is not None] == [3]
    assert drop_near_duplicates(messy).count() == len(set(brute([plain_fingerprint(r[1]) for r in messy_rows])))
