"""Property tests: Spark operators against plain-Python brute force."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ladle.functions.columns import duration_minutes
from ladle.operators import sequence as SQ


def _py_minutes(text):
    if text is None:
        return 0
    h = re.search(r"(\d+)H", text)
    m = re.search(r"(\d+)M", text)
    to_int = lambda g: int(g.group(1)) if g and int(g.group(1)) < 2**31 else 0
    total = to_int(h) * 60 + to_int(m)
    return total if total < 2**31 else None


_part = st.one_of(st.just(""), st.integers(0, 999).map(str), st.integers(0, 10**11).map(str))
_dur = st.one_of(
    st.none(),
    st.builds(lambda d, h, m: f"P{d + 'D' if d else ''}T{h + 'H' if h else ''}{m + 'M' if m else ''}",
              _part, _part, _part),
    st.text(alphabet="PTHMS0123456789D", max_size=10))


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_dur, min_size=1, max_size=200))
def test_duration_minutes_matches_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.m for r in df.select("i", duration_minutes("t").alias("m")).collect()}
    assert got == {i: _py_minutes(t) for i, t in enumerate(texts)}


_row = st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 5), st.integers(0, 99))


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_row, min_size=1, max_size=60), st.integers(0, 8), st.integers(1, 6))
def test_leads_match_brute_force(spark, rows, hot, parts):
    data = [(a, d, f"r{i:03d}", v) for i, (a, d, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "authorid int, datesubmitted int, review_id string, recipeid int")
    got = {r.review_id: (r._lead1.v if r._lead1 else None, r._lead2.v if r._lead2 else None,
                         r._lead1 is not None, r._lead2 is not None)
           for r in SQ.leads(df, "authorid", ["datesubmitted", "review_id"], "recipeid",
                             partitions=parts, hot_key_rows=hot).collect()}
    expect = {}
    for a in {r[0] for r in data}:
        seq = sorted((r for r in data if r[0] == a), key=lambda r: (r[1], r[2]))
        for i, r in enumerate(seq):
            n1 = seq[i + 1] if i + 1 < len(seq) else None
            n2 = seq[i + 2] if i + 2 < len(seq) else None
            expect[r[2]] = (n1[3] if n1 else None, n2[3] if n2 else None, n1 is not None, n2 is not None)
    assert got == expect


def _round9(x):
    from decimal import ROUND_HALF_UP, Decimal
    return float(Decimal(repr(x)).quantize(Decimal("1e-9"), rounding=ROUND_HALF_UP))


_vec = st.lists(st.sampled_from([-1.0, -0.5, 0.0, 0.25, 0.5, 1.0]), min_size=3, max_size=3)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_vec, min_size=4, max_size=40), st.integers(1, 4), st.integers(1, 6))
def test_ranked_neighbours_match_brute_force(spark, vecs, n_q, k):
    import math

    from ladle.operators import neighbours as NB

    def unit(v):
        n = math.sqrt(sum(x * x for x in v))
        return [x / n for x in v] if n else [0.0, 0.0, 0.0]

    items = [(i, unit(v)) for i, v in enumerate(vecs)]   # many exact duplicates -> ties
    queries = items[:n_q]
    c = spark.createDataFrame(items, "cand_id int, c_vec array<double>")
    q = spark.createDataFrame([(f"q{i}", i, v) for i, v in queries], "review_id string, recipeid int, q_vec array<double>")
    got = {(r.review_id, r.rn): r.cand_id for r in NB.ranked_neighbours(q, c, 3, k=k).collect()}
    expect = {}
    for qi, qv in queries:
        scored = []
        for ci, cv in items:
            if ci == qi:
                continue
            s = qv[0] * cv[0] + qv[1] * cv[1] + qv[2] * cv[2]
            scored.append((-_round9(s), ci))
        for rank, (_, ci) in enumerate(sorted(scored)[:k], start=1):
            expect[(f"q{qi}", rank)] = ci
    assert got == expect
