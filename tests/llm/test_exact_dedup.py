import hashlib
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from ladle.llm.exact_dedup import drop_exact_copies, exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")].append(r)
    out = Counter()
    for content, members in groups.items():
        order = lambda r: (-len(r[1] or ""), float("inf") if r[0] is None else r[0])
        best = min(members, key=order)
        for r in members:
            out[(r[0], best[0], len(members), order(r) == order(best), hashlib.sha256(content.encode()).hexdigest())] += 1
    return out


def test_messy_rows_match_brute_force(messy, messy_rows):
    found = Counter(tuple(r) for r in exact_dedup(messy).collect())
    assert found == brute(messy_rows)


def test_colliding_digests_are_told_apart_by_content(messy, messy_rows):
    weak = lambda c: F.substring(F.sha2(c.cast("binary"), 256), 1, 1)
    found = Counter(tuple(r)[:4] for r in exact_dedup(messy, digest=weak).collect())
    want = Counter()
    for k, n in brute(messy_rows).items():
        want[k[:4]] += n
    assert found == want


def test_extreme_ids(spark):
    ids = [2**63 - 1, -2**63, 0, -1]
    docs = spark.createDataFrame([(i, "same") for i in ids], "doc_id long, text string")
    assert {r.keep_id for r in exact_dedup(docs).collect()} == {-2**63}


def test_kept_rows_keep_their_columns(messy):
    kept = drop_exact_copies(messy)
    assert kept.columns == messy.columns
    assert kept.where("text = 'x'").count() == 1
    assert drop_exact_copies(messy.limit(0)).collect() == [] == exact_dedup(messy.limit(0)).collect()


def test_every_group_leaves_one_row(spark, messy, messy_rows):
    content = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    weak = lambda c: F.substring(F.sha2(c.cast("binary"), 256), 1, 1)
    rows = [*[(None, "no id")] * 1000, *[(4, "loaded again")] * 3, (5, "a b"), (5, "a\tb"), (None, "a b"), (9, "alone"),
            *[(None, "")] * 2, (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    want = Counter({(None, "noid"): 1, (4, "loadedagain"): 1, (5, "ab"): 1, (9, "alone"): 1, (None, ""): 1})
    for options in ({}, {"digest": weak}):
        assert Counter((r.doc_id, content(r.text)) for r in drop_exact_copies(docs, **options).collect()) == want
        kept = Counter(content(r.text) for r in drop_exact_copies(messy, **options).collect())
        assert kept == Counter({content(r[1]) for r in messy_rows})
