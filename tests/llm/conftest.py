import random

import pytest

# Columns named like the operators' own, beside those of documents.
CLASHING = ("row string, fp long, sha string, rank string, content string, kept string, size string, key string, "
            "words string, whole string, th string, source_size string, component string, bucket string")


def say(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="session")
def messy_rows():
    """Nulls in any column, empty and very long texts, ties, repeated rows."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeghiklmnorstuvé") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    long = say(rng, 60_000, words)
    rows = [(1, None, "en", "a", 3), (2, "", "en", "a", None), (3, "  \t\n", None, None, 4), (4, long, "en", "a", 1),
            (5, long + " ", "en", "b", 1), (None, "one two three", "en", None, 1), (None, "one two three", "en", None, 1),
            (6, "x", "", "", 1), (7, "x", "", "", 1), (7, "x", "", "", 1), (8, "a" * 50_000, "fr", "c", 0)]
    for i in range(10, 70):
        rows.append((i, say(rng, rng.randint(40, 160), words), rng.choice(["en", "fr"]), rng.choice("abc"), i))
    base = say(rng, 300, words)
    for i in range(70, 80):  # near copies
        parts = base.split(" ")
        parts[rng.randrange(300)] = "changed"
        rows.append((i, " ".join(parts), "en", "a", i))
    return rows


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    names = [c.split()[0] for c in CLASHING.split(", ")]
    rows = [(*r, *[9 if n == "fp" else "x" for n in names]) for r in messy_rows]
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
    return spark.createDataFrame(rows, schema).repartition(4)
