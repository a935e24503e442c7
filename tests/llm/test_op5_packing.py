import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyloom.llm import op5_packing as op
from tallyloom.llm import tokens
from tests.llm.tables import awkward_documents, empty_documents, write


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_ids_equal_the_library(library):
    rng = random.Random(3)
    signs = list("ab 'sé\n\t\r  \x0b\x0c\x1c\x85\xa0  　漢😀1٣.,") + ["<|endoftext|>", "  ", " ", " \n", "'ll"]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 30))) for _ in range(5000)]
    special = tokens.special_ids("byte_bpe_50k.json")
    for text, want in zip(texts, library(texts)):
        assert np.frombuffer(tokens.ids(text, "byte_bpe_50k.tiktoken", special), "<u4").tolist() == want
    assert special == {"<|endoftext|>": 50256} and library(["hi <|endoftext|> there"])[0].count(50256) == 1


def check(rows, texts, library):
    """Every id of every document in exactly one piece; sequences gapless, within the limits, with little padding."""
    want = {}
    for key, ids in zip(texts, library([t or "" for t in texts.values()])):
        want[key] = ids + [0]
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(want)
    for key, ids in want.items():
        end = 0
        for r in sorted(by_doc[key], key=lambda r: r.start):
            assert r.start == end and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
            end += r.length
        assert end == len(ids)
    for pieces in by_sequence.values():
        end = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert len(pieces) <= 128 and end <= 1024 and end & (end - 1) == 0  # no padding at all


def test_documents(spark, sf_dir, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    check(op.query(spark, sf_dir).collect(), texts, library)


def test_awkward_and_empty(spark, tmp_path, library):
    docs = awkward_documents(spark).where("doc_id > 1")
    check(op.query(spark, write(docs, tmp_path)).collect(), {r.doc_id: r.text for r in docs.collect()}, library)
    every = op.pack_documents(awkward_documents(spark), "byte_bpe_50k.tiktoken", op.specials("byte_bpe_50k.json"))
    assert every.where("doc_id = 1 AND start = 0").count() == 2 and every.where("doc_id IS NULL AND start = 0").count() == 2
    assert op.pack_documents(empty_documents(spark), "byte_bpe_50k.tiktoken").count() == 0


def test_many_very_short_texts(spark, tmp_path, library):
    """The limit on segments binds first; what it leaves open is no padding."""
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    rows = op.query(spark, write(docs, tmp_path)).collect()
    check(rows, {i: "a b" for i in range(20_000)}, library)
    assert len({r.sequence_id for r in rows}) <= 2 * 20_000 / 128 + 8 * 11


def test_instruction_data(spark):
    """Prompts bear no loss, and the limit on loss-bearing tokens holds in every sequence made on Spark."""
    talks = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").where("text IS NOT NULL")
    rows = talks.groupBy("conv_id").agg(F.concat_ws("\n", F.collect_list(F.when(F.col("role") != "assistant", F.col("text")))).alias("prompt"),
                                        F.concat_ws("\n", F.collect_list(F.when(F.col("role") == "assistant", F.col("text")))).alias("answer"))
    limits = op.Limits(tokens=512, segments=5, loss=150)
    pieces = op.pack_documents(rows, "byte_bpe_50k.tiktoken", id_col="conv_id", text_col="answer", prompt_col="prompt", limits=limits).collect()
    size = lambda t: len(tokens.ids(t, "byte_bpe_50k.tiktoken")) // 4
    given = {r.conv_id: (size(r.prompt), size(r.answer) + 1) for r in rows.collect()}
    total, sequences = {}, {}
    for p in pieces:
        silent, _ = given[p.conv_id]
        assert p.loss == max(0, p.start + p.length - max(p.start, silent)) and len(p.ids) == 4 * p.length
        total.setdefault(p.conv_id, []).append((p.start, p.length, p.loss))
        sequences.setdefault(p.sequence_id, []).append(p)
    assert {k: (sum(n - x for _, n, x in v), sum(x for _, _, x in v)) for k, v in total.items()} == given
    loads = [(sum(p.length for p in s), len(s), sum(p.loss for p in s)) for s in sequences.values()]
    assert all(n <= 512 and k <= 5 and x <= 150 for n, k, x in loads) and max(x for _, _, x in loads) == 150
    assert all(n & (n - 1) == 0 for n, _, _ in loads)


@pytest.mark.parametrize("cut", [True, False])
def test_all_limits_hold(cut):
    rng, limits = random.Random(5), op.Limits(tokens=100, segments=7, loss=40)
    items = {i: (n, rng.randint(0, min(n, 40 if not cut else n))) for i in range(2000) for n in [rng.randint(1, 100 if not cut else 300)]}
    packer, sequences = op.Packer(limits, cut, pool=64), []
    for key, (n, loss) in items.items():
        sequences += packer.add(key, n, loss)
    sequences += packer.drain()
    seen = {}
    for s in sequences:
        loss = sum(max(0, start + length - max(start, items[k][0] - items[k][1])) for k, start, length in s)
        assert sum(length for _, _, length in s) <= 100 and len(s) <= 7 and loss <= 40
        for k, start, length in s:
            assert start == seen.get(k, 0)
            seen[k] = start + length
    assert seen == {k: n for k, (n, _) in items.items()}
    if not cut:
        least = max(sum(n for n, _ in items.values()) / 100, sum(x for _, x in items.values()) / 40)
        assert len(sequences) <= 1.25 * least
        with pytest.raises(ValueError):
            list(packer.add("long", 101, 0))
