import re
from collections import Counter

from pyspark.sql import functions as F

from ladle.llm import quality as Q

SPACE = r"[\x20\x09-\x0D]+"


def brute(text):
    text = text or ""
    words = [w for w in re.split(SPACE, text) if w]
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        if windows[w] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_counts_match_brute_force(messy, messy_rows, spark):
    odd = ["a a a a", "a b c a b c", "a b c x a b c a b", "l\nl\r\nl\n \nl", "a\x0bb\x1cc #|<", "a b c d " * 40]
    docs = messy.select("doc_id", "text", "lang", "source").unionByName(spark.createDataFrame(
        [(1000 + i, t, "en", "a") for i, t in enumerate(odd)], "doc_id long, text string, lang string, source string"))
    found = Counter((r.doc_id, *[r[c] for c in Q.COUNTS]) for r in Q.quality(docs).collect())
    want = Counter((k, *brute(t)) for k, t in [(r[0], r[1]) for r in messy_rows] + [(1000 + i, t) for i, t in enumerate(odd)])
    assert found == want


def test_sketch_buckets_are_close_and_ordered(spark):
    values = [*range(200), *[3 ** i for i in range(4, 30)], 2 ** 40, 2 ** 40 - 1]
    rows = (spark.createDataFrame([(v,) for v in values], "v long").withColumn("b", Q.bucket(F.col("v")))
            .withColumn("low", Q.lower_edge(F.col("b"))).withColumn("again", Q.bucket(F.col("low"))).collect())
    for r in rows:
        assert r.low <= r.v <= r.low * 33 / 32 + 1 and r.again == r.b
    ordered = sorted(rows, key=lambda r: r.v)
    assert [r.b for r in ordered] == sorted(r.b for r in rows)


def test_outliers_go_and_clean_documents_stay(spark):
    import random
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(500)]
    clean = [" ".join(rng.choice(words) for _ in range(120)) for _ in range(200)]
    junk = [" | ".join(rng.choice(words) for _ in range(120)), " ".join(w + "!!" for w in clean[0].split()).upper()]
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}") for i, t in enumerate(clean + junk)]
    found = {r.doc_id: r.kept for r in Q.quality(spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string")).collect()}
    assert [found[200], found[201]] == [False, False]
    assert all(found[i] for i in range(200))


def test_kept_rows_keep_their_columns(messy):
    kept = Q.keep_good(messy)
    assert kept.columns == messy.columns
    ids = Counter(r.doc_id for r in Q.quality(messy).where("kept").collect())
    assert Counter(r.doc_id for r in kept.collect()) == ids
    assert Q.keep_good(messy.limit(0)).collect() == [] == Q.quality(messy.limit(0)).collect()


def test_fences_move_smoothly_with_a_groups_size(spark):
    """No size at which a group is judged by itself all at once; a rare language is held against the others."""
    import random
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(300)]
    say = lambda marks: " ".join(rng.choice(words) + ("!" if rng.random() < marks else "") for _ in range(200))
    big = [(i, say(0.02), "en", "big") for i in range(400)]
    lows, loud = [], [say(0.3) for _ in range(51)]
    for n in (49, 50, 51):
        rows = big + [(1000 + i, loud[i], "en", "loud") for i in range(n)]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        fence = Q.thresholds(Q.sketches(Q.measured(df, "text", "doc_id", "lang", "source"))).where("t_source = 'loud'").first()
        lows.append(fence.mark_rate_high)
    assert max(lows) - min(lows) < 0.1 * min(lows)
    rare = big + [(2000, " ".join("LOUD!!" for _ in range(30)) + " " + say(0.9), "xx", "big")]
    kept = {r.doc_id: r.kept for r in Q.quality(spark.createDataFrame(rare, "doc_id long, text string, lang string, source string")).collect()}
    assert not kept[2000] and sum(kept[i] for i in range(400)) >= 398
