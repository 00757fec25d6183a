"""Quality rules with adaptive thresholds, DataFrame operations only.

Per text a handful of integer rates is computed inside the row.  Their
distribution per language and source goes into mergeable quantile sketches:
counts of integer buckets (exact below 64, then 32 buckets per power of two,
so a quantile is off by at most 1/32).  Counts add up in any order, so the
sketches merge map-side, across tasks and from sources to whole languages,
and every rerun gives the same thresholds.

A document is an outlier if a rate lies beyond the far fence (quartile plus
``REACH`` times the spread between the quartiles) of its language and
source.  A group's quartiles are drawn towards those of its language's merged
sketch, and a language's towards the whole corpus's, by weight n / (n +
``PRIOR_DOCS``), so a rare source or language is held against the wider ones.
The thresholds (one row per language and source, broadcast once its bytes are
measured) are joined to the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ladle.llm.registry import query, table
from ladle.operators.bounded import broadcast_if_small
from ladle.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
MIN_WORDS = 50
PRIOR_DOCS = 50   # documents that the wider sketch counts for in a group's quartiles
REACH = 4
# rate: (numerator, denominator, scale, least spread between the quartiles)
RATES = {
    "symbol_rate": ("n_symbols", "n_words", 1000, 15),
    "repeat_rate": ("n_repeat_words", "n_words", 1000, 100),
    "dup_line_rate": ("n_dup_lines", "n_lines", 1000, 125),
    "upper_rate": ("n_upper", "word_chars", 1000, 15),
    "mark_rate": ("n_marks", "n_words", 1000, 15),
    "word_length": ("word_chars", "n_words", 100, 50),
}
TWO_SIDED = ("word_length",)
_PLAIN = 64  # values below are buckets of their own
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times."""
    return F.transform(F.array(value), body)[0]


def repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur at least twice.

    Windows are compared by their 64-bit hash; only a text with a repeated
    window sorts its windows to find the places."""
    def places(hashes: Column) -> Column:
        ranked = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return _let(ranked, lambda r: F.array_sort(F.transform(
            F.filter(r, lambda x, k: (F.get(r, k - 1)["h"].eqNullSafe(x["h"])) | (F.get(r, k + 1)["h"].eqNullSafe(x["h"]))),
            lambda x: x["i"])))

    def covered(at: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(0), F.size(at) - 1), F.lit(0), lambda n, k: n + F.least(
            F.lit(3), F.coalesce(F.get(at, k + 1) - F.get(at, k), F.lit(3))))

    def count(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), _let(places(hashes), covered)).otherwise(F.lit(0))

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3),
                          lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(_let(windows, count))


def measured(docs: DataFrame, text: str, doc_id: str, lang: str, source: str, row: bool = False) -> DataFrame:
    """(doc_id, lang, source, counts, rates[, row]) of every row; null texts count as empty."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    carried = [F.struct("*").alias("row")] if row else []
    flat = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{lang}`").alias("lang"),
                       F.col(f"`{source}`").alias("source"), whole.alias("whole"), *carried)
    lines = F.filter(F.split("whole", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    words = F.regexp_extract_all("whole", F.lit(WORD), F.lit(0))
    both = flat.select("*", _let(words, lambda w: F.struct(F.size(w).alias("n"), repeat_words(w).alias("repeated"))).alias("w"),
                       _let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
                       .alias("l"))
    as_long = lambda c, name: c.cast("long").alias(name)
    counted = both.select(
        "doc_id", "lang", "source", *(["row"] if row else []), as_long(F.col("w.n"), "n_words"),
        as_long(F.length(F.regexp_replace("whole", SPACE, "")), "word_chars"),
        as_long(F.regexp_count("whole", F.lit(SYMBOL)), "n_symbols"), as_long(F.col("l.dup"), "n_dup_lines"),
        as_long(F.col("w.repeated"), "n_repeat_words"), as_long(F.col("l.n"), "n_lines"),
        as_long(F.regexp_count("whole", F.lit("[A-Z]")), "n_upper"),
        as_long(F.regexp_count("whole", F.lit("[!?]")), "n_marks"))
    rates = {r: F.expr(f"({a} * {scale}) div greatest({b}, 1L)") for r, (a, b, scale, _) in RATES.items()}
    return counted.withColumns(rates).withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def bucket(value: Column) -> Column:
    """Sketch bucket of a non-negative integer."""
    shift = F.length(F.bin(value)) - 6
    high = (shift - 1) * 32 + _PLAIN
    return F.when(value < _PLAIN, value).otherwise(high + F.call_function("shiftright", value, shift) - 32).cast("long")


def lower_edge(b: Column) -> Column:
    """Smallest value of a bucket."""
    shift = F.floor((b - _PLAIN) / 32).cast("int") + 1
    return F.when(b < _PLAIN, b).otherwise(F.call_function("shiftleft", F.pmod(b - _PLAIN, F.lit(32)) + 32, shift)).cast("long")


def sketches(rows: DataFrame) -> DataFrame:
    """(lang, source, rate, bucket, n): one sketch per language, source and rate, over the documents
    long enough to be measured."""
    pairs = F.array(*[F.struct(F.lit(r).alias("rate"), bucket(F.col(r)).alias("bucket")) for r in RATES])
    return (rows.where(f"n_words >= {MIN_WORDS}").select("lang", "source", F.explode(pairs).alias("p"))
            .groupBy("lang", "source", "p.rate", "p.bucket").agg(F.count(F.lit(1)).alias("n")))


def _quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, q1, q3) from sketches; a group is at most the buckets of one sketch."""
    group = Window.partitionBy(*keys)
    ranked = (sketch.withColumn("upto", F.sum("n").over(group.orderBy("bucket")))
              .withColumn("total", F.sum("n").over(group)))
    at = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("total") * q, lower_edge(F.col("bucket"))))
    return ranked.groupBy(*keys).agg(F.max("total").alias("total"), at(1).alias("q1"), at(3).alias("q3"))


def _drawn(own: Column, total: Column, wide: Column, prior: int) -> Column:
    """A group's quartile drawn towards the wider one, which counts for ``prior`` documents."""
    return F.call_function("div", total * own + prior * wide, total + prior)


def thresholds(sketch: DataFrame, prior: int = PRIOR_DOCS, reach: int = REACH) -> DataFrame:
    """(t_lang, t_source, low, high): the fences of each language and source, maps by rate.

    Quartiles move smoothly with a group's size: the language's are drawn
    towards the whole corpus's, the group's towards the language's."""
    own = _quartiles(sketch, ["lang", "source", "rate"])
    of_lang = _quartiles(sketch.groupBy("lang", "rate", "bucket").agg(F.sum("n").alias("n")), ["lang", "rate"])
    of_all = (_quartiles(sketch.groupBy("rate", "bucket").agg(F.sum("n").alias("n")), ["rate"])
              .select(F.col("rate").alias("g_rate"), F.col("q1").alias("g1"), F.col("q3").alias("g3")))
    wide = (of_lang.join(of_all, F.col("rate") == F.col("g_rate"))
            .select(F.col("lang").alias("m_lang"), F.col("rate").alias("m_rate"),
                    _drawn(F.col("q1"), F.col("total"), F.col("g1"), prior).alias("m1"),
                    _drawn(F.col("q3"), F.col("total"), F.col("g3"), prior).alias("m3")))
    both = own.join(wide, F.col("lang").eqNullSafe(F.col("m_lang")) & (F.col("rate") == F.col("m_rate")))
    least = F.element_at(F.create_map(*[x for r, v in RATES.items() for x in (F.lit(r), F.lit(v[3]))]), F.col("rate"))
    fenced = (both.withColumn("a", _drawn(F.col("q1"), F.col("total"), F.col("m1"), prior))
              .withColumn("b", _drawn(F.col("q3"), F.col("total"), F.col("m3"), prior))
              .withColumn("spread", F.greatest(F.col("b") - F.col("a"), least.cast("long"))))
    fence = lambda c, r: F.max(F.when(F.col("rate") == r, c))
    aggregates = [fence(F.col("b") + reach * F.col("spread"), r).alias(f"{r}_high") for r in RATES]
    aggregates += [fence(F.col("a") - reach * F.col("spread"), r).alias(f"{r}_low") for r in TWO_SIDED]
    return (fenced.groupBy(F.col("lang").alias("t_lang"), F.col("source").alias("t_source")).agg(*aggregates))


def judged(rows: DataFrame, prior: int = PRIOR_DOCS, reach: int = REACH) -> DataFrame:
    """``rows`` of ``measured`` (read twice, so written by the caller) with ``kept``."""
    fences = broadcast_if_small(thresholds(sketches(rows), prior, reach), pin=True)
    outlier = F.lit(False)
    for r in RATES:
        outlier = outlier | (F.col(r) > F.col(f"{r}_high"))
    for r in TWO_SIDED:
        outlier = outlier | (F.col(r) < F.col(f"{r}_low"))
    same = F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source"))
    return (rows.join(fences, same, "left")
            .withColumn("kept", ~(F.col("base_failed") | F.coalesce(outlier, F.lit(False)))))


def quality(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang",
            source: str = "source", prior: int = PRIOR_DOCS, reach: int = REACH) -> DataFrame:
    """(doc_id, counts, rates, base_failed, kept) of every row.

    * null or empty text: no words, base_failed, not kept;
    * null lang or source: a language or source of its own;
    * repeated rows are judged each; a null doc_id stays null;
    * empty table: no rows.
    """
    rows = materialize(measured(docs, text, doc_id, lang, source), "quality-measured")
    return judged(rows, prior, reach).select("doc_id", *COUNTS, *RATES, "base_failed", "kept")


def keep_good(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang",
              source: str = "source", prior: int = PRIOR_DOCS, reach: int = REACH) -> DataFrame:
    """The rows of ``docs``, all columns, that ``quality`` keeps."""
    rows = materialize(measured(docs, text, doc_id, lang, source, row=True), "quality-rows")
    return judged(rows, prior, reach).where("kept").select("row.*")


def _oracle() -> str:
    word = r"[^\x20\x09-\x0D]"
    rates = ",\n".join(f"({a} * {scale}) // greatest({b}, 1) AS {r}" for r, (a, b, scale, _) in RATES.items())
    pairs = "\nUNION ALL ".join(
        f"SELECT lang, source, '{r}' AS rate, {r} AS v, {least} AS least FROM m WHERE n_words >= {MIN_WORDS}"
        for r, (_, _, _, least) in RATES.items())
    edge = ("CASE WHEN v < 64 THEN v ELSE (v >> (length(bin(v)) - 6)::INT) << (length(bin(v)) - 6)::INT END")
    high = ", ".join(f"max(CASE WHEN rate = '{r}' THEN b + {REACH} * spread END) AS {r}_high" for r in RATES)
    low = ", ".join(f"max(CASE WHEN rate = '{r}' THEN a - {REACH} * spread END) AS {r}_low" for r in TWO_SIDED)
    outlier = " OR ".join([f"{r} > {r}_high" for r in RATES] + [f"{r} < {r}_low" for r in TWO_SIDED])
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{word}+') AS w FROM documents),
g AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram
      FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
p AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS c FROM g) WHERE c > 1),
c AS (SELECT rid, count(DISTINCT i + k) AS n FROM p, (VALUES (0), (1), (2)) AS x(k) GROUP BY rid),
l AS (SELECT rid, count(*) AS n, count(*) - count(DISTINCT line) AS dup
      FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '{word}') GROUP BY rid),
q AS (SELECT d.doc_id, d.lang, d.source, len(w)::BIGINT AS n_words,
             length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             len(regexp_extract_all(t, '{SYMBOL}'))::BIGINT AS n_symbols,
             coalesce(l.dup, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
             coalesce(l.n, 0)::BIGINT AS n_lines,
             len(regexp_extract_all(t, '[A-Z]'))::BIGINT AS n_upper,
             len(regexp_extract_all(t, '[!?]'))::BIGINT AS n_marks
      FROM d LEFT JOIN c USING (rid) LEFT JOIN l USING (rid)),
m AS (SELECT *, {rates},
             n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM q),
v AS ({pairs}),
e AS (SELECT lang, source, rate, least, {edge} AS v FROM v),
o AS (SELECT lang, source, rate, least, count(*) AS total, quantile_disc(v, 0.25) AS q1, quantile_disc(v, 0.75) AS q3
      FROM e GROUP BY ALL),
w AS (SELECT rate, quantile_disc(v, 0.25) AS g1, quantile_disc(v, 0.75) AS g3 FROM e GROUP BY ALL),
k AS (SELECT lang, rate, count(*) AS total, quantile_disc(v, 0.25) AS q1, quantile_disc(v, 0.75) AS q3 FROM e GROUP BY ALL),
n AS (SELECT lang, rate, (total * q1 + {PRIOR_DOCS} * g1) // (total + {PRIOR_DOCS}) AS m1,
             (total * q3 + {PRIOR_DOCS} * g3) // (total + {PRIOR_DOCS}) AS m3 FROM k JOIN w USING (rate)),
f AS (SELECT o.lang, o.source, o.rate, least, (total * q1 + {PRIOR_DOCS} * m1) // (total + {PRIOR_DOCS}) AS a,
             (total * q3 + {PRIOR_DOCS} * m3) // (total + {PRIOR_DOCS}) AS b
      FROM o JOIN n ON o.lang IS NOT DISTINCT FROM n.lang AND o.rate = n.rate),
s AS (SELECT *, greatest(b - a, least) AS spread FROM f),
t AS (SELECT lang, source, {high}, {low} FROM s GROUP BY ALL)
SELECT m.doc_id, {', '.join('m.' + x for x in (*COUNTS, *RATES))}, m.base_failed,
       NOT (m.base_failed OR coalesce({outlier}, false)) AS kept
FROM m LEFT JOIN t ON m.lang IS NOT DISTINCT FROM t.lang AND m.source IS NOT DISTINCT FROM t.source
"""


ORACLE = _oracle()


@query("op7_quality_rules", ORACLE)
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))
