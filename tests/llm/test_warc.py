import gzip
import os
import random

import pytest

from ladle.llm import warc as W


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(3)
    html = ["<p>" + "x" * rng.randint(0, 4000) + f"é{i}\r\n\r\nWARC/1.1</p>" for i in range(60)]
    rows = [(i, f"http://h/{i}", html[i % 40]) for i in range(100)]
    rows += [(200, None, None), (201, "u", ""), (None, "v", ""), (202, "a\r\nb", "q" * 300_000), (203, "z", "only"), (203, "z", "only"),
             (None, None, "alone")]
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, file string").repartition(3), rows


def test_round_trip(pages, tmp_path):
    df, rows = pages
    index = W.write_archives(df, str(tmp_path / "warc")).cache()
    records = W.read_records(index).collect()
    first = {}
    for p, _, h in rows:
        h = h or ""
        first[h] = p if first.get(h) is None else first[h] if p is None else min(p, first[h])
    want = sorted(str((p, u and u.replace("\r", "%0D").replace("\n", "%0A"), *(("response", None, (h or "").encode()) if p == first[h or ""]
                  else ("revisit", first[h or ""], None)))) for p, u, h in rows)
    assert sorted(str((r.page_id, r.url, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)))
                  for r in records) == want
    for r in records:
        if r.payload is not None:
            assert W.payload_digest(bytes(r.payload)) == r.payload_digest


def test_archives_are_member_per_record(pages, tmp_path):
    df, rows = pages
    index = W.write_archives(df, str(tmp_path / "warc")).collect()
    assert len(index) == len(rows)
    for name in {r.file for r in index}:
        raw = open(name, "rb").read()
        own = sorted((r.offset, r.length) for r in index if r.file == name)
        assert own[0][0] == 0 and own[-1][0] + own[-1][1] == len(raw) == os.path.getsize(name)
        for offset, length in own:
            assert gzip.decompress(raw[offset:offset + length]).startswith(b"WARC/1.1\r\n")


def test_selected_records_only(pages, tmp_path):
    df, _ = pages
    index = W.write_archives(df, str(tmp_path / "warc"))
    some = W.read_records(index.where("url in ('http://h/7', 'http://h/31')"), max_gap=10).collect()
    assert sorted(r.page_id for r in some) == [7, 31]


def test_small_payloads_are_not_revisited(pages, tmp_path):
    df, _ = pages
    index = W.write_archives(df, str(tmp_path / "warc"), min_bytes=100)
    assert index.where("record_type = 'revisit' and page_id in (200, 201)").count() == 0


def test_requests_coalesce():
    assert W.coalesced([(0, 10), (10, 5), (40, 5), (500, 5)], 30, 100) == [(0, 45, [0, 1, 2]), (500, 5, [3])]
    assert W.coalesced([(0, 60), (60, 60)], 30, 100) == [(0, 60, [0]), (60, 60, [1])]
    assert W.coalesced([], 1, 1) == []


def test_damage_is_noticed(pages, tmp_path):
    df, _ = pages
    index = W.write_archives(df.where("page_id = 203"), str(tmp_path / "warc"))
    name = index.first().file
    bad = W.build_record(203, "z", b"oxly", W.payload_digest(b"only"), None, False)
    with open(name, "wb") as f:
        f.write(gzip.compress(bad, mtime=0))
    row = [(name, 0, os.path.getsize(name))]
    with pytest.raises(Exception, match="does not match its digest"):
        W.read_records(df.sparkSession.createDataFrame(row, "file string, offset long, length long")).collect()


def test_empty_table(pages, tmp_path):
    df, _ = pages
    index = W.write_archives(df.limit(0), str(tmp_path / "warc"))
    assert index.collect() == [] == W.read_records(index).collect()


def test_readers_follow_the_archive_bytes(spark):
    rng = random.Random(3)
    pages = spark.createDataFrame([(i, f"http://x/{i}", "".join(rng.choice("abcdefgh") for _ in range(2000))) for i in range(300)],
                                  "page_id long, url string, html string").repartition(2)
    index = W.write_archives(pages)
    total = sum(r.length for r in index.collect())
    read = W.read_records(index, task_bytes=total // 10)
    assert read.rdd.getNumPartitions() in (10, 11)
    assert sorted(r.page_id for r in read.collect()) == list(range(300))
    assert W.read_records(index.limit(0)).collect() == []
