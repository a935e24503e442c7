import collections
import math
import re

import duckdb
from pyspark.sql import functions as F

from tallyloom.llm import op2_quality as op
from tests.llm.tables import awkward_documents, empty_documents

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    grams = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def tail(n, k, a):
    log_choose = lambda j: math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1)
    return math.fsum(math.exp(log_choose(j) + j * math.log(a) + (n - j) * math.log1p(-a)) for j in range(k + 1))


def brute_cutoffs(rows, risk):
    """rows: (stratum, measures, good) of labelled rows that pass the base rules."""
    strata = {s for s, _, _ in rows}
    share, level, out = risk.max_false_rejection / len(op.RULES), risk.delta / len(op.RULES) / len(strata), {}
    for s in strata:
        for rule, (_, cuts) in op.RULES.items():
            score = {"symbols": lambda m: m[2] / m[0], "long_words": lambda m: m[1] / m[0], "short_words": lambda m: -(m[1] / m[0]),
                     "repeated_lines": lambda m: 100 * m[3] / m[0], "repeated_words": lambda m: m[4] / m[0]}[rule]
            good = [score(m) for t, m, g in rows if t == s and g]
            bad = [score(m) for t, m, g in rows if t == s and not g]
            best = None
            for i, c in enumerate(cuts):
                out_good, out_bad = sum(x > c for x in good), sum(x > c for x in bad)
                if not good or tail(len(good), out_good, share) > level:
                    break
                gain = (out_bad / len(bad) if bad else 0) - risk.price * out_good / len(good)
                if gain > 0 and (best is None or gain > best[0]):
                    best = gain, i, c
            if best:
                out.setdefault(s, {})[rule] = best[2]
    return out


def test_measures(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").union(
        awkward_documents(spark).select("doc_id", "text", "lang", "source", "n_chars"))
    for r in op.measure(docs).collect():
        want = brute(r.text)
        assert tuple(r[m] for m in op.MEASURES) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_cutoffs_are_those_of_exact_tails(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("lang", F.when(F.col("lang") != "es", F.col("lang")))
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    risk = op.Risk(max_false_rejection=0.1, delta=0.2, price=1.0)
    measured = op.measure(docs).drop("text").cache()
    got = {r.stratum: {k: v for k, v in r.asDict().items() if k != "stratum" and v is not None}
           for r in op.calibrate(measured, labels, risk=risk).collect()}
    rows = [(r.lang, tuple(r[m] for m in op.MEASURES), r.quality) for r in
            measured.join(labels, "doc_id").where("NOT base_failed").collect()]
    assert got == brute_cutoffs(rows, risk) and any("symbols" in c for c in got.values())
    kept = {(r.doc_id, r.kept) for r in op.judge(measured, op.calibrate(measured, labels, risk=risk)).collect()}
    want = set()
    for r in measured.collect():
        cuts = got.get(r.lang, {})
        n = r.n_words or 1
        scores = {"symbols": r.n_symbols / n, "long_words": r.word_chars / n, "short_words": -r.word_chars / n,
                  "repeated_lines": 100 * r.n_dup_lines / n, "repeated_words": r.n_repeat_words / n}
        want.add((r.doc_id, not r.base_failed and not any(scores[k] > c for k, c in cuts.items())))
    assert kept == want and any(not k for _, k in kept)


def test_awkward_and_empty(spark):
    docs = awkward_documents(spark).withColumnRenamed("kept", "other")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], "doc_id bigint, quality int")
    measured = op.measure(docs)
    for found in (labels, labels.limit(0)):
        out = op.judge(measured, op.calibrate(measured, found))
        assert out.count() == docs.count() and set(docs.columns) <= set(out.columns)
        assert {r.kept for r in out.where("doc_id IN (1, 2, 3, 4) OR doc_id IS NULL").collect()} == {False}
    assert op.judge(op.measure(empty_documents(spark)), op.calibrate(op.measure(empty_documents(spark)), labels)).count() == 0


def test_query(spark, sf_dir):
    assert op.query(spark, sf_dir).columns[:8] == ["doc_id", *op.MEASURES, "base_failed", "kept"]


def test_sql_certifies_the_same_cutoffs(spark):
    sf, risk = "/root/testdata/sf0.1", op.Risk(max_false_rejection=0.1, delta=0.2, price=1.0)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text")
    measured = op.measure(docs).drop("text").cache()
    judged = op.judge(measured, op.calibrate(measured, spark.read.parquet(f"{sf}/labels.parquet"), risk=risk))
    got = {tuple(r) for r in judged.select("doc_id", *op.MEASURES, "base_failed", "kept").collect()}
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    want = con.execute(op.sql(risk)).fetchall()
    assert got == set(want) and len(want) == docs.count()
    assert any(not base and not kept for *_, base, kept in want)  # a cutoff acts, not the base rules alone
