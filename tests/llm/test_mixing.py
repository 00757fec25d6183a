import hashlib
import math
import re
from collections import defaultdict

import pytest

from ladle.llm.mixing import mix, mixed_documents

SPACE = r"[\x20\x09-\x0D]+"


def size(text):
    return len([w for w in re.split(SPACE, text or "") if w])


def brute(rows):
    """{(doc_id, size): taken} and {source: (size, target)}, by filling the targets round by round."""
    total, sources = defaultdict(int), sorted({r[3] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    for r in rows:
        total[r[3]] += size(r[1])
    weight = {s: i % 3 + 1 for i, s in enumerate(sources)}
    target, free = {}, set(sources)
    while free:
        left = sum(total.values()) - sum(target.values())
        shares = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        full = [s for s in free if shares[s] > 3 * total[s]]
        if not full:
            target |= shares
            break
        for s in full:
            target[s] = 3.0 * total[s]
            free.discard(s)
    return {s: (total[s], target[s]) for s in sources}


def test_targets_and_budgets(messy, messy_rows):
    rows = mix(messy, rows_per_range=5).collect()
    want, taken = brute(messy_rows), defaultdict(int)
    by_id = {r[0]: r[3] for r in messy_rows}
    assert len(rows) == len(messy_rows)
    for r in rows:
        source = by_id[r.doc_id]
        assert r.source_size == want[source][0]
        assert r.target == pytest.approx(want[source][1])
        assert 0 <= r.taken <= 3 * r.size
        taken[source] += r.taken
    for s, (_, t) in want.items():
        assert abs(taken[s] - math.floor(t + 1e-9)) <= 3  # repeated rows share their cut
    again = mix(messy.repartition(7), rows_per_range=50).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_order_is_the_md5_order(spark):
    docs = spark.createDataFrame([(i, "w " * 10, s) for s, n in (("a", 40), ("b", 40)) for i in range(n * (s == "b"), n + n * (s == "b"))],
                                 "doc_id long, text string, source string")
    rows = sorted((r for r in mix(docs, rows_per_range=7).collect() if r.doc_id < 40),
                  key=lambda r: hashlib.md5(f"mix:{r.doc_id}".encode()).hexdigest())
    want, left = [], int(800 / 3)
    for _ in rows:
        want.append(min(10, left))
        left -= want[-1]
    assert [r.taken for r in rows] == want


def test_documents_repeat_as_taken(messy, messy_rows):
    out = mixed_documents(messy, rows_per_range=5)
    assert out.columns == messy.columns
    got, words = defaultdict(list), defaultdict(int)
    for r in out.collect():
        got[r.doc_id].append(r)
        words[r.doc_id] += size(r.text)
        assert r.n_chars == len(r.text) or r.text in {x[1] for x in messy_rows}
    taken = defaultdict(int)
    for r in mix(messy, rows_per_range=5).collect():
        taken[r.doc_id] += r.taken
    assert {k: v for k, v in taken.items() if v} == dict(words)
    text = {r[0]: r[1] for r in messy_rows}
    for k, rows in got.items():
        assert all((text[k] or "").lstrip(" \t\n").startswith(r.text.lstrip(" \t\n")) for r in rows)


def test_empty_table(messy):
    assert mix(messy.limit(0)).collect() == [] == mixed_documents(messy.limit(0)).collect()
