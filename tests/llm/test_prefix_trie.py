import hashlib
import random
import re
import zlib

import pytest

from ladle.llm.prefix_trie import COLUMNS, prefix_trie, rebuilt


def rebuild(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns, key=lambda t: (t[0], t[1]))] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(sequences):
    members = {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    rows = []
    for path, convs in members.items():
        below = [p for p in members if p[:len(path)] == path]
        children = lambda p: sum(len(q) == len(p) + 1 and q[:len(p)] == p for q in members)
        saved = sum((len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in below if p)
        ends = ",".join(str(c) for c in sorted(convs) if len(sequences[c]) == len(path))
        rows.append((min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), children(path),
                     sum(children(p) == 0 for p in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def run(spark, rows, **more):
    table = spark.createDataFrame([(*r, "x", b"y", 3) for r in rows],
                                  "conv_id long, turn long, role string, text string, id string, path binary, words int")
    return sorted([tuple(r) for r in prefix_trie(rebuilt(table.repartition(5)), **more).select(*COLUMNS).collect()], key=str)


def talk(seed=3, n=220):
    rng = random.Random(seed)
    texts = ["hi there", "a  b\tc", "", None, "é 한국 x", "one", "hi there "]
    rows = []
    for c in [*range(n), *range(-45, -30), 1000]:
        chain = rng.random() < 0.3  # a third say the same for long
        turns = [t for t in range(rng.randint(1, 9)) if rng.random() < 0.9]
        for t in turns:
            text = "the very same long start" if chain else rng.choice(texts)
            rows.append((c, None if t == 0 and rng.random() < 0.2 else t, rng.choice(["user", None]) if not chain else "user", text))
    rows += [(None, 0, "user", "lost"), (2000, 5, "system", "once " * 20_000)]
    rows += [(c, t, "user", f"copy {t}") for c in range(3000, 3100, 20) for t in range(7)]
    return rows


@pytest.mark.parametrize("container", [1, 5, 60, 1 << 14])
def test_against_brute_force(spark, container):
    rows = talk()
    want = brute(rebuild(rows))
    assert sum(r[4] > 1 for r in want) > 20 and max(r[1] for r in want) >= 7
    assert run(spark, rows, container=container) == want


def test_many_copies_fold_in_pieces(spark):
    rows = [(c, t, "user", f"copy {t}") for c in range(0, 20 * 300, 20) for t in range(3)]
    assert run(spark, rows, ids_in_piece=7) == brute(rebuild(rows))


def test_turnless_and_empty(spark):
    lone = [(c, 0, "user", "gone") for c in range(1, 20)]  # without a base, those with h > 0 have no turn left
    want = brute(rebuild(lone))
    assert want[0][1] == 0 or len(want) == 2
    assert run(spark, lone) == want
    assert run(spark, lone, container=1) == want
    assert run(spark, []) == []


def test_repeated_rows_are_turns(spark):
    rows = [(20, 1, "user", "a"), (20, 1, "user", "a"), (20, 2, None, None)]
    assert run(spark, rows) == brute(rebuild(rows))
    assert max(r[1] for r in run(spark, rows)) == 3
