import random
from collections import Counter

import public_tokenizers
import pytest

from ladle.llm.token_counts import END, Automaton, count_tokens, pieces

PATH = public_tokenizers.path("word_bpe_49k.json")


def greedy(vocabulary, word):
    symbols, n, at = (*word[:-1], word[-1] + END), 0, 0
    while at < len(symbols):
        size = next(k for k in range(len(symbols) - at, 0, -1) if symbols[at:at + k] in vocabulary)
        at, n = at + size, n + 1
    return n


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, encoding="utf-8") as f:
        return pieces(f.read())


def test_counts_equal_greedy_longest_match(vocabulary):
    automaton, known = Automaton(vocabulary), set(vocabulary)
    assert len(known) > 49_000 and all((b,) in known and (b + END,) in known for b in range(256))
    rng = random.Random(1)
    real = [bytes(s - END if s >= END else s for s in p) for p in rng.sample(vocabulary, 400)]
    words = real + [b"".join(rng.sample(real, 3)) for _ in range(400)]
    words += [bytes(rng.randrange(256) for _ in range(rng.randint(1, 12))) for _ in range(300)]
    words += ["unbelievably".encode(), "éééß漢字".encode(), b"a" * 500]
    for w in words:
        assert automaton.count(w) == greedy(known, w), w


def test_small_vocabularies():
    rng = random.Random(2)
    for _ in range(300):  # all single symbols, and some longer pieces
        base = [(b,) for b in (97, 98, 97 + END, 98 + END)]
        more = {tuple(rng.choice((97, 98)) for _ in range(rng.randint(1, 5))) for _ in range(6)}
        more = {(*p[:-1], p[-1] + END) if rng.random() < 0.4 else p for p in more}
        vocabulary = {*base, *more}
        automaton = Automaton(sorted(vocabulary))
        for _ in range(20):
            w = bytes(rng.choice((97, 98)) for _ in range(rng.randint(1, 12)))
            assert automaton.count(w) == greedy(vocabulary, w)


def test_messy_documents(messy, messy_rows, vocabulary):
    known = set(vocabulary)
    found = Counter(tuple(r) for r in count_tokens(messy, PATH).collect())
    cache = {}

    def total(text):
        words = (text or "").encode().lower().split()
        for w in words:
            if w not in cache:
                cache[w] = greedy(known, w)
        return len(words), sum(cache[w] for w in words)
    rows = [r for r in messy_rows if len(r[1] or "") != 50_000]  # the plain scan is slow on one very long word
    want = Counter((r[0], *total(r[1])) for r in rows)
    assert want == found - Counter(k for k in found if k[0] == 8)
    assert next(k for k in found if k[0] == 8)[1] == 1
    assert count_tokens(messy.limit(0), PATH).collect() == []
