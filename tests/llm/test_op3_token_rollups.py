import collections

import public_tokenizers
from tokenizers import Tokenizer

from tallyloom.llm import op3_token_rollups as op
from tallyloom.sources import files
from tests.llm.tables import awkward_documents, empty_documents, write


def brute(docs):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    out, seen = collections.Counter(), {}
    for r in docs:
        if r.doc_id is not None:
            seen[r.text or ""] = min(seen.get(r.text or "", r.doc_id), r.doc_id)
    for r in docs:
        text = "\n".join(dict.fromkeys((r.text or "").split("\n")))
        if r.doc_id is None or r.doc_id == seen[r.text or ""]:
            out[r.source, r.lang, "documents"] += 1
            out[r.source, r.lang, "tokens"] += len(t.encode(text, add_special_tokens=False).ids)
    return out


def test_query(spark, sf_dir, tmp_path):
    for folder in (sf_dir, write(awkward_documents(spark), tmp_path)):
        rows = op.query(spark, folder).where("tokenizer = 'byte_bpe_50k.tiktoken'").collect()
        got = collections.Counter()
        for r in rows:
            got[r.source, r.lang, "documents"], got[r.source, r.lang, "tokens"] = r.documents, r.tokens
        assert got == brute(spark.read.parquet(f"{folder}/documents.parquet").collect())


def test_commits_are_idempotent(spark, tmp_path):
    rollup = op.Rollup(spark, str(tmp_path / "store"), dead_seconds=0)
    assert rollup.totals().count() == 0
    row = lambda sign, tokens: spark.createDataFrame([("a", "en", "v1", sign, tokens)], "source string, lang string, tokenizer string, sign int, tokens long")
    assert rollup.commit("b1", row(1, 10)) and not rollup.commit("b1", row(1, 99))
    assert rollup.commit("b2", row(-1, 10).union(row(1, 7)))
    row(1, 1000).selectExpr("source", "lang", "tokenizer", "1L AS documents", "1000L AS tokens").write.parquet(f"{rollup.root}/sums/lost")  # never marked
    files.mark(spark, f"{rollup.root}/marks/b3")  # its driver died before it could name the sums
    assert not rollup.committed("b3")
    assert [tuple(r) for r in rollup.totals().collect()] == [("a", "en", "v1", 1, 7)]
    assert rollup.commit("b3", row(-1, 7)) and rollup.totals().count() == 0
    assert rollup.commit("b4", row(1, 1).limit(0)) and rollup.totals().count() == 0


def test_compaction(spark, tmp_path):
    """Totals stay, batches stay committed, and what is read does not grow with the batches."""
    rollup = op.Rollup(spark, str(tmp_path / "store"))
    row = lambda n: spark.createDataFrame([("a", "en", "v1", 1, n)], "source string, lang string, tokenizer string, sign int, tokens long")
    assert not rollup.compact()
    for i in range(6):
        assert rollup.commit(f"b{i}", row(i))
        reader = rollup.totals()
        if i in (2, 3, 5):
            assert rollup.compact() and not rollup.compact()
            assert len(rollup.totals().inputFiles()) == 1
        want = [("a", "en", "v1", i + 1, i * (i + 1) // 2)]
        assert [tuple(r) for r in rollup.totals().collect()] == [tuple(r) for r in reader.collect()] == want
    assert not any(rollup.commit(f"b{i}", row(99)) for i in range(6))
    assert len(files.names(spark, f"{rollup.root}/sums")) <= 4


def test_two_drivers_commit_one_batch(spark, tmp_path):
    """The second one finds the mark made while it was writing: its sums go."""
    row = spark.createDataFrame([("a", "en", "v1", 1, 5)], "source string, lang string, tokenizer string, sign int, tokens long")
    one, two = op.Rollup(spark, str(tmp_path / "store")), op.Rollup(spark, str(tmp_path / "store"))
    two.committed = lambda batch: False  # it looked before the other was done
    assert one.commit("b", row) and not op.Rollup.commit(two, "b", row)
    assert [r.tokens for r in one.totals().collect()] == [5] and len(files.names(spark, f"{one.root}/sums")) == 1


def test_empty(spark, tmp_path):
    assert op.query(spark, write(empty_documents(spark), tmp_path)).count() == 0
