"""Secret scanning with character Markov models, DataFrame operations only.

Fixed patterns give the base spans.  Beyond them, a run of token characters
(12 with a digit, 16 without), or a part of one between separators, is a secret
if it looks more like a random string than like an ordinary identifier: two
first-order character models, one trained on the strings that the patterns
label as secrets, one on words of labelled documents and on the paths, names
and dated labels joined from them, are compared by their log-likelihood ratio
per step.

All of it runs inside the row: matches and the text between them give spans by
prefix sums, and the ratio table is an array literal of fixed size.  Training
reads a bounded sample of labelled documents (``TRAIN_DOCS`` with and as many
without base spans, by md5 of the id); its result is one table of
``STATES`` squared counts per label.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.llm.registry import query, table
from ladle.session import materialize

# The base patterns and their least lengths, in the order of the kinds.
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"(AKIA[A-Z0-9]+)"
HEX = r"([0-9a-f]+)"
BASE = {"assign": (ASSIGN, 12), "access": (ACCESS, 18), "hex": (HEX, 16)}
KINDS = (*BASE, "random")

# A whole run, and the parts of one between separators: a secret may stand beside other text.
CANDIDATE = r"([A-Za-z0-9+/_=-]{12,})"
PART = r"([A-Za-z0-9+_]{12,})"
LEAST_LETTERS = 16           # a shorter candidate needs a digit
TRAIN_DOCS = 1000
WORD_SAMPLE = r"(?<![A-Za-z0-9+/=_-])([A-Za-z]{2,})(?![A-Za-z0-9+/=_-])"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789/=-_+"
STATES = len(ALPHABET) + 1   # the last state is any other character
UNIFORM = 0.5                # share of the uniform string in the random model
SMOOTH = 0.5
PRIOR = 5.0                  # weight of a character's overall frequency in a row of steps
MARGIN = 1.3                 # least mean log-likelihood ratio of a step
BLOCK = 256
WORDS_PER_DOC = 200          # of a training document


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _running(values: Column, start: Column) -> Column:
    """start, start + v1, start + v1 + v2, ..."""
    return F.aggregate(values, F.array(start), lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)))


def _greatest_before(values: Column) -> Column:
    """Of an array of longs: for each place the greatest earlier value (-1 at
    the first), in blocks as ``prefix_sums``."""
    low = F.lit(-1).cast("long")
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(values) / BLOCK).cast("int") - 1, F.lit(0))),
                         lambda b: F.slice(values, b * BLOCK + 1, F.lit(BLOCK)))
    top = lambda xs: F.coalesce(F.array_max(xs), low)
    upto = lambda vs, start: F.aggregate(vs, F.array(start), lambda acc, v: F.concat(
        acc, F.array(F.greatest(F.element_at(acc, -1), v))))

    def inside(bs: Column) -> Column:
        return _let(upto(F.transform(bs, top), low), lambda starts: F.flatten(F.transform(
            bs, lambda b, i: F.slice(upto(b, F.get(starts, i)), F.lit(1), F.size(b)))))

    return _let(blocks, inside)


def untouched(runs: Column, base: Column) -> Column:
    """The runs that overlap no base span: both are sorted into one list, and
    the greatest base end before a run and the least base start after its own
    are read off two sweeps, so many runs and many base spans stay cheap."""
    event = lambda of, is_run: F.transform(of, lambda s: F.struct(
        s["start"].alias("start"), F.lit(is_run).alias("run"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value")))

    def swept(e: Column) -> Column:
        ends = F.transform(e, lambda x: F.when(x["run"] == 0, x["end"]).otherwise(F.lit(-1)).cast("long"))
        # mirrored, so that the least start after becomes the greatest before
        starts = F.reverse(F.transform(e, lambda x: F.when(x["run"] == 0, -x["start"]).otherwise(F.lit(-(2 ** 62))).cast("long")))
        return _let(_greatest_before(ends), lambda before: _let(F.reverse(_mirrored(starts)), lambda after: F.transform(
            F.filter(F.transform(e, lambda x, i: F.struct(x.alias("x"), F.get(before, i).alias("b"), F.get(after, i).alias("a"))),
                     lambda t: (t["x"]["run"] == 1) & (t["b"] <= t["x"]["start"]) & (-t["a"] >= t["x"]["end"])),
            lambda t: F.struct(t["x"]["start"].alias("start"), t["x"]["kind"].alias("kind"), t["x"]["end"].alias("end"),
                               t["x"]["value"].alias("value")))))

    # A base span that starts with a run is told apart by sorting it first.
    merged = _let(F.array_sort(F.concat(event(base, 0), event(runs, 1))), swept)
    return F.when((F.size(base) == 0) | (F.size(runs) == 0), runs).otherwise(merged)


def _mirrored(starts: Column) -> Column:
    """``_greatest_before`` for values that may be below -1."""
    shift = 2 ** 62
    return F.transform(_greatest_before(F.transform(starts, lambda v: v + shift)), lambda v: F.when(
        v < 0, F.lit(-shift).cast("long")).otherwise(v - shift))


def prefix_sums(values: Column) -> Column:
    """Exclusive prefix sums of an array of longs, in blocks so that a text
    with very many matches stays cheap."""
    zero = F.lit(0).cast("long")
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(values) / BLOCK).cast("int") - 1, F.lit(0))),
                         lambda b: F.slice(values, b * BLOCK + 1, F.lit(BLOCK)))
    total = lambda xs: F.aggregate(xs, zero, lambda a, v: a + v)

    def inside(bs: Column) -> Column:
        return _let(_running(F.transform(bs, total), zero), lambda starts: F.flatten(F.transform(
            bs, lambda b, i: F.slice(_running(b, F.get(starts, i)), F.lit(1), F.size(b)))))

    return _let(blocks, inside)


def spans(text: Column, pattern: str, group: int, least: int, kind: int) -> Column:
    """array<struct<start, kind, end, value>> of a pattern's matches whose
    ``group`` has at least ``least`` characters; code points, end exclusive."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    def placed(pieces: Column, matches: Column, values: Column) -> Column:
        # the text before a match, then the match: its start is what both took before, and its own gap
        steps = F.transform(matches, lambda m, i: (F.length(F.get(pieces, i)) + F.length(m)).cast("long"))
        return _let(prefix_sums(steps), lambda before: F.filter(F.transform(matches, lambda m, i: _let(
            F.get(before, i) + F.length(F.get(pieces, i)), lambda s: F.struct(
                s.alias("start"), F.lit(kind).alias("kind"), (s + F.length(m)).alias("end"),
                F.get(values, i).alias("value")))), lambda x: F.length(x["value"]) >= least))

    found = _let(F.split(text, pattern, -1), lambda p: _let(whole, lambda m: _let(value, lambda v: placed(p, m, v))))
    nothing = F.array().cast("array<struct<start: bigint, kind: int, end: bigint, value: string>>")
    return F.when(text.rlike(pattern), found).otherwise(nothing)


def _narrow(pattern: str, least: int) -> str:
    """A run pattern that needs no filter: runs are maximal, so a shorter run holds no longer one."""
    return pattern.replace("[A-Z0-9]+", f"[A-Z0-9]{{{least - 4},}}").replace("[0-9a-f]+", f"[0-9a-f]{{{least},}}")


def found(docs: DataFrame, text: str, doc_id: str, train_docs: int) -> DataFrame:
    """(doc_id, base, runs, parts, words): the base spans, the token runs with
    a letter and the parts of runs that touch none of them, and for the
    documents of the training sample their words."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    key = F.md5(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("null")))
    # The sample's bound is a key: the TRAIN_DOCS-th smallest of all ids.
    last = docs.select(key.alias("key")).orderBy("key").limit(train_docs).agg(F.max("key")).first()[0] or ""
    flat = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), key.alias("key"), whole.alias("whole"))
    base = F.concat(*[spans(F.col("whole"), _narrow(p, n) if k else p, 1, n, k) for k, (p, n) in enumerate(BASE.values())])
    held = flat.select("doc_id", "key", "whole", base.alias("base"), _scored(CANDIDATE).alias("runs"), _scored(PART).alias("parts"))
    words = F.slice(F.regexp_extract_all("whole", F.lit(WORD_SAMPLE), F.lit(1)), 1, WORDS_PER_DOC)
    return held.select("doc_id", "base", untouched(F.col("runs"), F.col("base")).alias("runs"),
                       untouched(F.col("parts"), F.col("base")).alias("parts"),
                       F.when((F.col("key") <= last) & (F.size("base") == 0), words).alias("words"))


def _scored(pattern: str) -> Column:
    """The pattern's matches in ``whole`` that are long enough to be scored."""
    return F.filter(spans(F.col("whole"), pattern, 1, 12, len(BASE)), lambda r: r["value"].rlike("[A-Za-z]") & (
        (F.length(r["value"]) >= LEAST_LETTERS) | r["value"].rlike("[0-9]")))


def identifiers(words: Column) -> Column:
    """Ordinary identifiers made of a document's words: the words themselves,
    and each three in a row joined as people join them."""
    low = lambda i: F.lower(F.get(words, i))
    cap = lambda i: F.initcap(F.get(words, i))
    year = lambda i: (F.lit(1990) + F.pmod(F.hash(F.get(words, i)), F.lit(40))).cast("string")
    two = lambda i, n: F.lpad((F.pmod(F.hash(F.get(words, i), F.lit(n)), F.lit(28)) + 1).cast("string"), 2, "0")
    made = F.transform(F.sequence(F.lit(0), F.greatest(F.size(words) - 3, F.lit(0))), lambda i: F.array(
        F.concat_ws("/", low(i), low(i + 1), low(i + 2)), F.concat_ws("_", low(i), low(i + 1), year(i), two(i, 1), two(i, 2)),
        F.concat_ws("-", low(i), low(i + 1), year(i)), F.concat(low(i), cap(i + 1), cap(i + 2)), F.concat(cap(i), cap(i + 1), cap(i + 2)),
        F.concat_ws("_", F.upper(low(i)), F.upper(low(i + 1))), F.concat_ws("/", cap(i), low(i + 1), F.concat(cap(i + 2), two(i, 3))),
        F.concat_ws("-", low(i), F.lit("v"), two(i, 4)), F.concat_ws("=", low(i), low(i + 1)), F.concat_ws("+", low(i), low(i + 1)),
        F.repeat(F.element_at(F.array(*[F.lit(c) for c in "=-_+/"]), (i % 5 + 1).cast("int")), 12),
        F.concat(year(i), F.lit("-"), two(i, 5), F.lit("-"), two(i, 6)), F.concat_ws("_", low(i), two(i, 7))))
    return F.when(F.size(words) >= 3, F.concat(words, F.flatten(made))).otherwise(words)


def _codes(string: Column) -> Column:
    """States of a string's characters, 0-based."""
    return F.transform(F.split(string, ""), lambda c: F.pmod(
        F.call_function("locate", c, F.lit(ALPHABET)) - 1, F.lit(STATES)))


def _steps(strings: Column) -> Column:
    """All steps of the strings as state * STATES + next state."""
    return F.flatten(F.transform(strings, lambda s: _let(_codes(s), lambda c: F.transform(
        F.slice(c, F.lit(2), F.greatest(F.size(c) - 1, F.lit(0))), lambda b, i: F.get(c, i) * STATES + b))))


def train(rows: DataFrame, train_docs: int = TRAIN_DOCS) -> list[float]:
    """Log-likelihood ratio of every step, STATES * STATES values.

    Random strings are the base values of ``train_docs`` documents that have
    some (smallest md5 of the id); ordinary ones the words of the sampled
    documents that have none, alone and joined to identifiers."""
    labelled = (rows.where("size(base) > 0").select(F.md5(F.col("doc_id").cast("string")).alias("key"), "base")
                .orderBy("key", F.col("base")).limit(train_docs))
    counted = lambda df, strings: df.select(F.explode(_steps(strings)).alias("step")).groupBy("step").count()
    random = counted(labelled, F.transform("base", lambda b: b["value"]))
    plain = counted(rows.where("words is not null"), identifiers(F.col("words")))

    tables = []
    for steps in (random, plain):
        table_ = [[0.0] * STATES for _ in range(STATES)]
        for r in steps.collect():  # at most STATES * STATES rows
            table_[r["step"] // STATES][r["step"] % STATES] += r["count"]
        tables.append(table_)
    if not all(any(map(any, t)) for t in tables):
        return [0.0] * (STATES * STATES)
    drawn, plain_ = (_conditional(t) for t in tables)
    return [round(math.log((1 - UNIFORM) * x + UNIFORM / STATES) - math.log(y), 6)
            for a, b in zip(drawn, plain_) for x, y in zip(a, b)]


def _conditional(counts: list[list[float]]) -> list[list[float]]:
    """P(next | state) of a table of step counts, each row drawn towards the
    overall frequencies of the next characters."""
    total = [sum(column) + SMOOTH for column in zip(*counts)]
    overall = [t / sum(total) for t in total]
    return [[(x + PRIOR * p) / (sum(row) + PRIOR) for x, p in zip(row, overall)] for row in counts]


def mean_ratio(string: Column, ratio: list[float]) -> Column:
    """Mean log-likelihood ratio of a string's steps, random against ordinary."""
    lookup = F.array(*[F.lit(x) for x in ratio])
    total = lambda c: F.aggregate(F.sequence(F.lit(1), F.size(c) - 1), F.lit(0.0), lambda a, i: a + F.get(
        lookup, (F.get(c, i - 1) * STATES + F.get(c, i)).cast("int")))
    return F.when(F.length(string) < 2, F.lit(0.0)).otherwise(
        _let(_codes(string), total) / (F.length(string) - 1))


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", train_docs: int = TRAIN_DOCS,
         margin: float = MARGIN) -> DataFrame:
    """(doc_id, base, added) of every row: arrays of (start, kind, end,
    value), kinds numbered as in KINDS, sorted by start, then kind.

    * null or empty text: no spans; repeated rows are scanned each; a null
      doc_id stays null; empty table: no rows;
    * without a training sample of either kind every ratio is 0 and nothing
      is added.
    """
    rows = materialize(found(docs, text, doc_id, train_docs), "secret-spans")
    ratio = train(rows, train_docs)
    likely = lambda name: F.filter(name, lambda c: mean_ratio(c["value"], ratio) > margin)
    scored = rows.select("doc_id", F.array_sort("base").alias("base"), likely("runs").alias("runs"), likely("parts").alias("parts"))
    # A part counts where its whole run does not.
    added = F.array_sort(F.concat("runs", untouched(F.col("parts"), F.col("runs"))))
    return scored.select("doc_id", "base", added.alias("added"))


def listed(found_spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found_spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


@query("op6_secret_scan")
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(BASE)]
    return rows.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
                       listed(F.array_sort(F.concat("base", "added"))).alias("spans"))
