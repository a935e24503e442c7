import re

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tallyloom.llm import op1_secrets, op2_quality
from tests.llm import test_op2_quality as quality
from tests.llm import test_op7_simhash as simhash
from tests.llm.tables import awkward_documents, empty_documents, write

SF = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out, columns = docs, docs.columns
    kept = pipeline.quality(spark, docs, SF).collect()
    rows = {r.doc_id: r for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    measures = {k: quality.brute(r.text) for k, r in rows.items()}
    passed = {k for k, m in measures.items() if m[0] >= 50 and 100 * m[4] <= 50 * m[0]}
    cuts = quality.brute_cutoffs([(rows[k].lang, measures[k], labels[k]) for k in passed if k in labels], op2_quality.Risk())
    assert not cuts and {r.doc_id for r in kept} == passed  # too few labels at this size to certify anything

    out = spark.createDataFrame(kept, docs.schema)
    ids = sorted(passed)
    roots = simhash.brute_components([simhash.brute_fingerprint(rows[i].text) for i in ids])
    want = {ids[r] for r in roots}
    out = pipeline.near_duplicates(spark, out, SF)
    assert out.columns == columns and {r.doc_id for r in out.collect()} == want

    clean = pipeline.secrets(spark, out, SF)
    assert clean.columns == columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert set(texts) == want
    for k, text in texts.items():
        old = rows[k].text
        assert not re.search(r'token = "[0-9a-f]{40}"', text)
        assert (text == old) == (not re.search(r'(?i)(token|password)\s*=\s*"?[0-9a-z]{16,}|AKIA[0-9A-Z]{16}', old)), k

    pieces = pipeline.packing(spark, clean, SF)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == want
    assert pipeline.run(spark, SF).groupBy("doc_id").sum("length").count() == len(want)


def test_rows_that_share_an_id_and_clashing_columns(spark):
    """Texts are judged by row: a text is not lost because its id is another's, and columns pass through whatever they are called."""
    text = " ".join(f"word{i}" for i in range(80))
    rows = [(1, text, "en"), (1, text[::-1], "en"), (2, text, "en"), (None, text, "en"), (None, "alone " + text[::-1][:300], "en")]
    names = ("row_number", "_row_number", "uid", "_uid", "n_words", "kept", "row", "id", "fp", "component_id", "first")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumns({n: F.lit(111) for n in (*names, "source")})
    out = pipeline.near_duplicates(spark, docs, SF)
    assert out.columns == docs.columns and all(r[n] == 111 for r in out.collect() for n in names)
    assert sorted((str(r.doc_id), r.text) for r in out.collect()) == sorted((str(i), t) for i, t, _ in (rows[0], rows[1], rows[4]))
    judged = pipeline.quality(spark, docs, SF)
    assert judged.columns == docs.columns and judged.count() == 4 and all(r[n] == 111 for r in judged.collect() for n in names)
    assert pipeline.secrets(spark, docs, SF).columns == docs.columns


def test_cutoffs_act_in_every_stratum(spark, tmp_path):
    """With 1,600 good labels in each of four languages every one certifies cutoffs, and the stage rejects by them."""
    good = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(59)), lambda i: F.concat(F.lit("word"), (F.col("id") * 61 + i * 7).cast("string"))), " ")
    bad = F.concat(good, F.repeat(F.lit(" $$$ ###"), 20))
    rows = spark.range(6880).select(F.col("id").alias("doc_id"), F.element_at(F.array(*map(F.lit, ("en", "de", "fr", "es"))), (F.col("id") % 4 + 1).cast("int")).alias("lang"),
                                    (F.col("id") % 43 != 0).cast("int").alias("quality"), F.when(F.col("id") % 43 == 0, bad).otherwise(good).alias("text"))
    docs = rows.select("doc_id", "text", "lang", F.lit("s").alias("source"), F.char_length("text").cast("long").alias("n_chars"))
    write(rows.select("doc_id", "quality", F.lit(0).alias("toxic")), tmp_path, "labels")
    kept = {r.doc_id for r in pipeline.quality(spark, docs, str(tmp_path)).collect()}
    assert kept == {i for i in range(6880) if i % 43}
    measured = op2_quality.measure(docs)
    cuts = op2_quality.calibrate(measured, spark.read.parquet(f"{tmp_path}/labels.parquet")).collect()
    listed = [(r.lang, quality.brute(r.text), r.quality) for r in rows.collect()]
    want = quality.brute_cutoffs(listed, op2_quality.Risk())
    assert set(want) == {"en", "de", "fr", "es"} and {r.stratum: {k: r[k] for k in op2_quality.RULES if r[k] is not None} for r in cuts} == want


def test_awkward_and_empty(spark, tmp_path):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    for name, docs in (("a", awkward_documents(spark)), ("e", empty_documents(spark))):
        folder = tmp_path / name
        write(labels, folder, "labels")
        sf = write(docs, folder)
        assert pipeline.run(spark, sf).count() >= 0
        deduplicated = pipeline.near_duplicates(spark, docs, sf).collect()
        if name == "a":
            assert sorted(str(r.doc_id) for r in deduplicated) == ["1", "2", "5", "9", "None"]
    assert [n for n, _ in pipeline.STAGES] == ["quality rules", "near-duplicates", "secret scan", "packing"] and op1_secrets.TREES
