"""Quality rules whose cutoffs are chosen under a proven limit on false rejection.

Each rule scores a text and rejects it above a cutoff. Cutoffs come from a fixed grid per rule, ordered from lax to
strict, and are tested on labelled holdouts (rows that pass the base rules and are labelled good) in every stratum: with
``k`` of ``n`` good rows rejected, the exact binomial tail ``P(Bin(n, a) <= k)`` is the p-value of "the rate of false
rejection is above ``a``". A rule's share of the limit is ``a = max_false_rejection / rules``, so that the rules together
keep ``max_false_rejection``; the error ``delta`` is divided by rules times strata (Bonferroni), and along a grid the
tests run in their fixed order and stop at the first that fails, which needs no further correction. All certified cutoffs
hold together with probability ``1 - delta``, so any of them may be taken: the one with the best difference between the
share of rejected bad rows and ``price`` times the share of rejected good rows; none where no cutoff gains.
A stratum with too few labels certifies nothing and loses nothing beyond the base rules.

Everything is DataFrame functions. A text is measured once, inside its row; only numbers are shuffled.

Defined results: a null text has no words and fails the base rules; a null stratum value is a stratum of its own; several
labels of one id count as good if any is good; labels with a null id or a null label are not used; a repeated row is
judged as often as it occurs; empty labels certify nothing; further columns pass through :func:`judge` untouched, whatever they are called
(but for ``kept``, which it sets). The labels that choose among the cutoffs also certify them; that is sound because all are certified together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyloom.llm.names import unused
from tallyloom.operators.staging import stage

SPACE = "[\\x20\\x09-\\x0D]"
SYMBOLS = "#*$%&|<>"
BROADCAST_STRATA = 10_000
#: Rule name: SQL expression over the base measures, cutoffs from lax to strict.
RULES = {
    "symbols": ("n_symbols / n_words", (4.0, 3.0, 2.0, 1.5, 1.0, 0.75, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1)),
    "long_words": ("word_chars / n_words", (12.0, 11.0, 10.0, 9.0, 8.5, 8.0, 7.5, 7.25, 7.0, 6.75, 6.5, 6.25, 6.0)),
    "short_words": ("-(word_chars / n_words)", (-1.5, -2.0, -2.5, -3.0, -3.25, -3.5, -3.75, -4.0)),
    "repeated_lines": ("100 * n_dup_lines / n_words", (20.0, 10.0, 5.0, 4.0, 3.0, 2.0, 1.5)),
    "repeated_words": ("n_repeat_words / n_words", (0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2)),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Risk:
    """Limits: share of good rows that may be rejected per stratum, chance that any limit is broken, weight of a good row."""

    max_false_rejection: float = 0.02
    delta: float = 0.05
    price: float = 10.0


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the base measures and ``base_failed``; one pass, no shuffle. A column of one of these names would be lost, so it raises
    ``ValueError``: rename it, or give only the columns that are needed."""
    lost = {c.lower() for c in docs.columns} & {*MEASURES, "base_failed"}
    if lost:
        raise ValueError(f"columns with the names of measures: {sorted(lost)}")
    held, = unused(docs, "of_words")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\n\x0b\x0c\r"))) > 0)
    words = F.array_remove(F.split(text, SPACE + "+"), "")
    out = docs.withColumns({
        held: _let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), F.char_length(F.array_join(w, "")).cast("long").alias("chars"),
                                                    _repeated(w).alias("repeated"))),
        "n_symbols": F.char_length(text).cast("long") - F.char_length(F.regexp_replace(text, f"[{SYMBOLS}]+", "")),
        "n_dup_lines": _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))})
    return (out.withColumns({"n_words": F.col(f"{held}.n"), "word_chars": F.col(f"{held}.chars"), "n_repeat_words": F.col(f"{held}.repeated")})
            .drop(held).withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the optimizer copies the expression."""
    return F.transform(F.array(value), body)[0]


def _repeated(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more: windows are sorted by hash, equal neighbours are repeats."""
    grams = F.transform(F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))),
                        lambda x, i: F.xxhash64(x, words[i + 1], words[i + 2]))

    def covered(s: Column) -> Column:
        at = F.sort_array(F.transform(F.filter(s, lambda e, k: (e.h == F.get(s, k - 1).h) | (e.h == F.get(s, k + 1).h)), lambda e: e.i))
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(at, start, lambda a, i: F.struct((a.n + F.least(F.lit(3), i - a.last)).alias("n"), i.alias("last")), lambda a: a.n)

    return _let(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long")).otherwise(
        _let(F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), covered)))


def _score(rule: str) -> Column:
    return F.expr(f"CASE WHEN n_words > 0 THEN CAST({RULES[rule][0]} AS DOUBLE) END")


def calibrate(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", stratum_col: str = "lang", label_col: str = "quality",
              risk: Risk = Risk()) -> DataFrame:
    """One row per stratum with labels: ``stratum`` and one cutoff per rule (null: none certified that gains)."""
    label = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(
        F.max(F.col(label_col).cast("int")).alias("good"))
    exceeded = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), sum(
        (_score(r) > F.lit(c)).cast("int") for c in RULES[r][1]).alias("passed")) for r in RULES]))
    held = (measured.where("NOT base_failed").select(F.col(id_col).alias("_id"), F.col(stratum_col).cast("string").alias("stratum"), *MEASURES)
            .join(label, "_id").select("stratum", "good", exceeded.alias("e"))
            .groupBy("stratum", "good", "e.rule", "e.passed").agg(F.count(F.lit(1)).alias("n")))
    grid = measured.sparkSession.createDataFrame(
        [(r, i + 1, len(cuts) - i, c) for r, (_, cuts) in RULES.items() for i, c in enumerate(cuts)],
        "rule string, step int, least int, cutoff double")  # a row above the cutoff of a step is above all stricter ones
    at = stage(held.join(F.broadcast(grid), "rule").groupBy("stratum", "rule", "step", "cutoff").agg(*[
        F.sum(F.expr(f"CASE WHEN good {sign} 0 {cut} THEN n ELSE 0 END")).alias(name) for name, sign, cut in (
            ("good_all", ">", ""), ("good_out", ">", "AND passed >= least"), ("bad_all", "<=", ""), ("bad_out", "<=", "AND passed >= least"))]), "cutoff-counts")
    strata = at.select("stratum").distinct().count()
    share = risk.max_false_rejection / len(RULES)
    tail = F.expr(f"""CASE WHEN good_all = 0 OR good_out >= good_all * {share!r} THEN 1D ELSE aggregate(sequence(0L, good_out),
        named_struct('t', 0D, 's', 0D), (a, j) -> named_struct(
          't', CASE WHEN j = 0 THEN good_all * ln(1D - {share!r}) ELSE a.t + ln((good_all - j + 1D) / j) + ln({share!r} / (1D - {share!r})) END,
          's', a.s + exp(CASE WHEN j = 0 THEN good_all * ln(1D - {share!r}) ELSE a.t + ln((good_all - j + 1D) / j) + ln({share!r} / (1D - {share!r})) END)),
        a -> a.s) END""")
    so_far = W.partitionBy("stratum", "rule").orderBy("step")
    tested = (at.withColumn("p", tail)
              .withColumn("certified", F.max("p").over(so_far) <= F.lit(risk.delta / len(RULES) / max(strata, 1)))
              .withColumn("gain", F.expr(f"CASE WHEN bad_all > 0 THEN bad_out / bad_all ELSE 0D END - {risk.price!r} * good_out / good_all")))
    best = tested.where("certified AND gain > 0").groupBy("stratum", "rule").agg(
        F.max(F.struct("gain", (-F.col("step")).alias("lax"), "cutoff")).alias("b"))
    return best.groupBy("stratum").pivot("rule", list(RULES)).agg(F.first("b.cutoff"))


def judge(measured: DataFrame, cutoffs: DataFrame, stratum_col: str = "lang") -> DataFrame:
    """``measured`` with ``kept``: false for a base failure or where any cutoff of the row's stratum is exceeded."""
    cutoffs = stage(cutoffs, "cutoffs")
    if cutoffs.count() <= BROADCAST_STRATA:
        cutoffs = F.broadcast(cutoffs)
    stratum, *cuts = unused(measured, "stratum", *[f"cut_{r}" for r in RULES])
    cutoffs = cutoffs.select(F.col("stratum").alias(stratum), *[F.col(r).alias(c) for r, c in zip(RULES, cuts)])
    joined = measured.join(cutoffs, F.col(stratum_col).cast("string").eqNullSafe(F.col(stratum)), "left")
    out = F.lit(False)
    for r, cut in zip(RULES, cuts):
        out = out | F.coalesce(_score(r) > F.col(cut), F.lit(False))
    return joined.withColumn("kept", ~F.col("base_failed") & ~out).drop(stratum, *cuts)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: base measures and verdict of every document, strata by language."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    measured = stage(measure(docs).drop("text"), "measures")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge(measured, calibrate(measured, labels)).select("doc_id", *MEASURES, "base_failed", "kept")


def sql(risk: Risk = Risk()) -> str:
    """The query in SQL: windows as rows, tails from log-gammas, cutoffs by the same order of tests."""
    share, word = risk.max_false_rejection / len(RULES), "[^\\x20\\x09-\\x0D]"
    grid = ", ".join(f"('{r}', {i}, {c!r})" for r, (_, cuts) in RULES.items() for i, c in enumerate(cuts))
    scores = " UNION ALL ".join(f"SELECT k, '{r}' AS rule, CAST({e} AS DOUBLE) AS score FROM m WHERE n_words > 0" for r, (e, _) in RULES.items())
    return f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{word}+') AS words, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{word}')) AS lines FROM d),
p AS (SELECT k, unnest(words) AS word, unnest(range(len(words))) AS i FROM w),
g AS (SELECT k, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o AS gram FROM p WINDOW o AS (PARTITION BY k ORDER BY i)),
r AS (SELECT k, unnest([i, i + 1, i + 2]) AS i FROM g WHERE gram IS NOT NULL QUALIFY count(*) OVER (PARTITION BY k, gram) > 1),
repeated AS (SELECT k, count(DISTINCT i) AS n FROM r GROUP BY k),
m AS MATERIALIZED (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
    FROM (SELECT k, doc_id, lang, CAST(len(words) AS BIGINT) AS n_words, length(array_to_string(words, '')) AS word_chars,
        length(t) - length(regexp_replace(t, '[{SYMBOLS}]', '', 'g')) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words FROM w LEFT JOIN repeated USING (k))),
s AS MATERIALIZED ({scores}),
l AS (SELECT doc_id, max(quality) > 0 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
grid(rule, step, cutoff) AS (VALUES {grid}),
held AS (SELECT lang, rule, step, cutoff, count(*) FILTER (good) AS good_all, count(*) FILTER (good AND score > cutoff) AS good_out,
        count(*) FILTER (NOT good) AS bad_all, count(*) FILTER (NOT good AND score > cutoff) AS bad_out
    FROM m JOIN l USING (doc_id) JOIN s USING (k) JOIN grid USING (rule) WHERE NOT base_failed GROUP BY ALL),
tested AS (SELECT *, CASE WHEN bad_all > 0 THEN bad_out / bad_all ELSE 0 END - {risk.price!r} * good_out / good_all AS gain,
        max(CASE WHEN good_all = 0 OR good_out >= good_all * {share!r} THEN 1.0 ELSE list_sum(list_transform(range(good_out + 1), lambda j:
            exp(lgamma(good_all + 1) - lgamma(j + 1) - lgamma(good_all - j + 1) + j * ln({share!r}) + (good_all - j) * ln(1 - {share!r})))) END)
            OVER (PARTITION BY lang, rule ORDER BY step) AS worst FROM held),
best AS (SELECT lang, rule, cutoff FROM tested
    WHERE worst <= {risk.delta / len(RULES)!r} / (SELECT count(*) FROM (SELECT DISTINCT lang FROM held)) AND gain > 0
    QUALIFY row_number() OVER (PARTITION BY lang, rule ORDER BY gain DESC, step) = 1),
rejected AS (SELECT DISTINCT m.k FROM m JOIN s USING (k) JOIN best b ON b.rule = s.rule AND b.lang IS NOT DISTINCT FROM m.lang WHERE score > cutoff)
SELECT doc_id, {', '.join(MEASURES)}, base_failed, NOT base_failed AND k NOT IN (SELECT k FROM rejected) AS kept FROM m
"""


SQL = sql()
