"""The pipeline's stages one by one against plain versions, and its whole run."""

import re
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from ladle.llm.quality import quality
from ladle.llm.mixing import mix
from ladle.session import materialize
from tests.conftest import SMALL
from tests.llm.test_simhash import plain_fingerprint

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SMALL), f"test-{name}")
        out.append(docs)
    return out


def test_names_and_columns(stages):
    assert [s for s, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_copies", "near_copies", "mixed", "packed"]
    assert all(df.columns == COLUMNS for df in stages[:-1])


def test_each_stage_decides_on_what_was_left(spark, stages):
    rows = [[r.asDict() for r in df.collect()] for df in stages]
    source = pq.read_table(f"{SMALL}/documents.parquet").to_pylist()
    good = {r.doc_id for r in quality(spark.read.parquet(f"{SMALL}/documents.parquet")).where("kept").collect()}
    assert sorted(r["doc_id"] for r in rows[0]) == sorted(r["doc_id"] for r in source if r["doc_id"] in good)

    best = {}
    for r in rows[0]:
        key = re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "")
        best[key] = min(best.get(key, (1, 0)), (-len(r["text"] or ""), r["doc_id"]))
    assert sorted(r["doc_id"] for r in rows[1]) == sorted(d for _, d in best.values())

    marks = {r["doc_id"]: plain_fingerprint(r["text"]) for r in rows[1]}
    root = {d: d for d in marks}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d
    for a in marks:
        for b in marks:
            if a < b and (marks[a] ^ marks[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert sorted(r["doc_id"] for r in rows[2]) == sorted({find(d) for d in marks})

    count = lambda t: len([w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w])
    words = defaultdict(int)
    for r in rows[3]:
        words[r["doc_id"]] += count(r["text"])
    taken = {r.doc_id: r.taken for r in mix(stages[2]).collect() if r.taken}
    assert dict(words) == taken

    copies = Counter(r["doc_id"] for r in rows[3])
    assert Counter(r["doc_id"] for r in rows[4] if r["start"] == 0) == copies
    tokens = Counter()
    for r in rows[4]:
        tokens[r["doc_id"]] += r["length"]
    assert all(tokens[d] >= n for d, n in copies.items())


def test_run_gives_the_last_stage(spark, stages):
    found = corpus_pipeline.run(spark, SMALL)
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)
    assert sorted(map(key, found.collect())) == sorted(map(key, stages[-1].collect()))
